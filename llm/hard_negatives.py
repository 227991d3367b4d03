"""Hard-negative mining: exact integer scores by a residue number system, then a window of scores below each positive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.columns import staged

#: A component x counts as floor(SCALE * x).
SCALE = 256
#: Residues are kept within +-HALF, so that sums over SLICE products are exact in float32: SLICE * HALF ** 2 < 2 ** 24.
HALF, SLICE = 510, 64
#: Scores are held in a long: size * component ** 2 stays below this.
MOST_SCORE = 1 << 62
#: About the most components of anchors, and of rows, that meet in one task at once, and of how many anchors the scores are held.
BLOCK_ANCHORS, BLOCK_ROWS, STRIP = 1 << 18, 1_280_000, 64
#: Fixed values of the task: positives of an anchor, negatives of a positive, and the window in percent of the positive's score.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90


def moduli(bound: int) -> list[int]:
    """Primes up to 2 * HALF + 1, largest first, whose product tells integers of up to `bound` in size apart."""
    found, product, p = [], 1, 2 * HALF + 1
    while product <= 2 * bound:
        if all(p % q for q in range(2, int(p**0.5) + 1)):
            found.append(p)
            product *= p
        p -= 1
    return found


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """x mod p within +-p / 2, as float32."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def products(a: np.ndarray, b: np.ndarray, primes: list[int]) -> np.ndarray:
    """a @ b.T of integers, exact: one float32 product for each prime and slice of the components, put together by mixed radix."""
    out, base = np.zeros((len(a), len(b)), np.int64), 1
    for n, p in enumerate(primes):
        left, right = residues(a, p), residues(b, p)
        total = np.zeros(out.shape, np.int64)
        for at in range(0, a.shape[1], SLICE):
            total += (left[:, at : at + SLICE] @ right[:, at : at + SLICE].T).astype(np.int64)
        # the digit that makes the sum so far right modulo p as well; signed digits give signed sums
        inverse = pow(base % p, -1, p) if n else 1
        digit = np.mod((total - out % p) * inverse, p)
        out += np.where(digit > p // 2, digit - p, digit) * base
        base *= p
    return out


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), size)


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k by score, largest first, then id. What ties with the k-th is looked at whole."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def scaled(vectors: DataFrame) -> DataFrame:
    """row (a number of its own), vec_id, label, size, vec (integers) of each row that takes part.

    Rows with a null vec_id, label or vector, with null or non-finite components, or with components whose products no long can
    hold (sizes of 2 ** 28 and more for 64 components) take no part."""
    most = F.floor(F.sqrt(F.lit(float(MOST_SCORE)) / F.greatest(F.size("embedding"), F.lit(1))))
    whole = F.expr("forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(whole)
    largest = F.coalesce(F.expr(f"array_max(transform(embedding, x -> abs(x) * {SCALE}))"), F.lit(0.0))
    rows = rows.where(largest + 1 <= most)
    vec = F.expr(f"transform(embedding, x -> CAST(floor({SCALE} * x) AS BIGINT))")
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", F.size("embedding").alias("size"), vec.alias("vec"))


def _met(rows: DataFrame, anchors: DataFrame, sizes: dict[int, tuple[int, int]]) -> tuple[DataFrame, DataFrame]:
    """Both sides by `place`: blocks of anchors and blocks of rows, of one vector size; every anchor meets every row once."""

    def blocks(side: int, block: int, size: str) -> Column:
        return F.create_map(*[F.lit(x) for s, n in sizes.items() for x in (s, max(1, -(-n[side] * max(s, 1) // block)))])[F.col(size)]

    # the sides come from one table: names of their own keep their columns apart
    anchors = anchors.toDF(*[f"a_{c}" for c in anchors.columns])
    own, other = F.pmod(F.xxhash64("row"), blocks(0, BLOCK_ROWS, "size")), F.pmod(F.xxhash64("a_row", F.lit("anchor")), blocks(1, BLOCK_ANCHORS, "a_size"))
    left = rows.select("*", own.cast("int").alias("block"), F.explode(F.sequence(F.lit(0), blocks(1, BLOCK_ANCHORS, "size") - 1)).alias("other"))
    right = anchors.select("*", other.cast("int").alias("a_other"), F.explode(F.sequence(F.lit(0), blocks(0, BLOCK_ROWS, "a_size") - 1)).alias("a_block"))
    return left.groupBy("size", "block", "other"), right.groupBy("a_size", "a_block", "a_other")


def _columns(table: pa.Table, size: int, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    vec = matrix(table[f"{prefix}vec"].combine_chunks(), size)
    return (*(table[prefix + x].to_numpy() for x in ("row", "vec_id", "label")), vec)


def _strips(left: pa.Table, right: pa.Table) -> Iterator[tuple[int, np.ndarray, tuple]]:
    """For each anchor (right) its number and its scores against all rows (left), STRIP anchors at a time."""
    size = int(left["size"][0].as_py())
    rows, anchors = _columns(left, size), _columns(right, size, "a_")
    most = max((int(np.abs(x[3]).max()) for x in (rows, anchors) if x[3].size), default=0)
    primes = moduli(max(1, size * most * most))
    for at in range(0, len(anchors[0]), STRIP):
        scores = products(anchors[3][at : at + STRIP], rows[3], primes)
        for i, own in enumerate(scores, at):
            yield i, own, (rows, anchors)


def mine(vectors: DataFrame, is_anchor: str, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each of its `positives` best
    other rows of the same label, the best `negatives` rows of another label whose score is from `low` to `high` percent of the
    positive's. Scores are integer inner products of the scaled vectors; equal ones go by vec_id.

    Which rows take part: see `scaled`. Vectors meet those of their own size. Rows that share a vec_id are rows of their own: an
    anchor leaves out itself only. Empty tables and anchors without positives give no rows; further columns play no part.
    Anchors meet rows in blocks, whatever their labels, so no label is a group of its own; each block gives its best few.
    A positive's window needs its score, so the blocks meet twice: scores are made anew and never written."""
    rows = staged(scaled(vectors))
    picked = rows.where(is_anchor)
    counts = rows.groupBy("size").agg(F.count("*").alias("n"), F.count(F.when(F.expr(is_anchor), 1)).alias("a")).collect()  # a row for each vector size
    sizes = {r["size"]: (r["n"], r["a"]) for r in counts if r["a"]}
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not sizes:
        return vectors.sparkSession.createDataFrame([], result)
    kept = rows.where(F.col("size").isin(list(sizes)))

    def best_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            for i, scores, ((row, ids, label, _), (a_row, a_ids, a_label, _)) in _strips(left, right):
                same = np.flatnonzero((label == a_label[i]) & (row != a_row[i]))
                top = same[_top(scores[same], ids[same], positives)]
                out += zip([int(a_row[i])] * len(top), [int(a_ids[i])] * len(top), row[top].tolist(), ids[top].tolist(), scores[top].tolist(), strict=True)
        return pa.table([pa.array(x, pa.int64()) for x in (zip(*out, strict=True) if out else [[]] * 5)], names=["row", "anchor_id", "positive_row", "positive_id", "positive_score"])

    a, b = _met(kept, picked, sizes)
    found = a.cogroup(b).applyInArrow(best_positives, "row long, anchor_id long, positive_row long, positive_id long, positive_score long")
    order = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    found = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives)
    with_best = staged(found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("n", "positive_id", "positive_score"))).alias("best")))
    asked = picked.join(with_best, "row")

    def best_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            best = right["a_best"].combine_chunks().to_pylist()
            for i, scores, ((_, ids, label, _), (a_row, a_ids, a_label, _)) in _strips(left, right):
                other = np.flatnonzero(label != a_label[i])
                for p in best[i]:
                    # low * p <= 100 * n <= high * p
                    least, most = -(-low * p["positive_score"] // 100), high * p["positive_score"] // 100
                    own = other[(scores[other] >= least) & (scores[other] <= most)]
                    top = own[_top(scores[own], ids[own], negatives)]
                    head = (int(a_row[i]), int(a_ids[i]), p["n"], p["positive_id"], p["positive_score"])
                    out += [(*head, n, s) for n, s in zip(ids[top].tolist(), scores[top].tolist(), strict=True)]
        return pa.table([pa.array(x, pa.int64()) for x in (zip(*out, strict=True) if out else [[]] * 7)], names=["row", "anchor_id", "n", "positive_id", "positive_score", "negative_id", "negative_score"])

    a, b = _met(kept, asked, sizes)
    pairs = a.cogroup(b).applyInArrow(best_negatives, "row long, anchor_id long, n long, positive_id long, positive_score long, negative_id long, negative_score long")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("row", "n").orderBy(F.desc("negative_score"), "negative_id")))
    return ranked.where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine_embeddings(vectors: DataFrame) -> DataFrame:
    """`mine` with every hundredth vec_id an anchor, and the labels of every seventh moved on by one, modulo ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.select("vec_id", "embedding", moved.alias("label")), "vec_id % 100 = 0")
