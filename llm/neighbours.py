"""Approximate nearest neighbours by learned partitions: parts of a neighbour graph, and a classifier that routes to them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The partition is learned from at most about so many vectors.
SAMPLE = 6000
#: Parts: about one for each PART_ROWS rows, within these bounds.
PART_ROWS = 4096
LEAST_PARTS, MOST_PARTS = 8, 64
#: Neighbours of a vector in the graph, and how much a part may exceed its even share.
GRAPH = 10
SLACK = 1.05
#: The classifier's hidden layer, steps and batch.
HIDDEN, STEPS, BATCH, RATE = 64, 500, 512, 0.005
#: So many parts are searched that this share of the sample's neighbours is found.
RECALL = 0.96
TRIED = 1000
#: Most candidates and most queries that meet in one task at once.
BLOCK_ROWS, BLOCK_QUERIES = 20_000, 4000
#: Scores closer than this are computed anew, pair by pair, before they are ranked.
CLOSE = 1e-9


@dataclass
class Router:
    """Two layers that give each part's log-odds for a vector; `probes` parts are searched."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def odds(self, unit: np.ndarray) -> np.ndarray:
        return np.maximum(unit @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def parts(self, unit: np.ndarray, n: int) -> np.ndarray:
        """The n likeliest parts, likeliest first."""
        return np.argsort(-self.odds(unit), axis=1, kind="stable")[:, :n]


def units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def nearest(queries: np.ndarray, rows: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """The k rows with the largest dot product, in blocks; `own` is each query's own row, which is left out."""
    found = []
    for at in range(0, len(queries), 1024):
        scores = queries[at : at + 1024] @ rows.T
        if own is not None:
            scores[np.arange(len(scores)), own[at : at + 1024]] = -np.inf
        found.append(np.argpartition(-scores, min(k, scores.shape[1]) - 1, axis=1)[:, :k])
    return np.concatenate(found)


def balanced_parts(unit: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator, sweeps: int = 12) -> np.ndarray:
    """Parts of nearly even size with few graph edges between them.

    Starts from balanced clusters round random vectors; then vectors move to the part of most of their neighbours, on
    either side of an edge, while that part has room."""
    n = len(unit)
    room = int(np.ceil(SLACK * n / parts))
    centres = unit[rng.choice(n, parts, replace=False)]
    for _ in range(5):
        likeness = unit @ centres.T
        wishes = np.argsort(-likeness, axis=1).tolist()
        given, size = [0] * n, [0] * parts
        for v in np.argsort(-likeness.max(1)).tolist():
            given[v] = p = next(x for x in wishes[v] if size[x] < room)
            size[p] += 1
        part = np.array(given)
        centres = np.stack([unit[part == p].mean(0) if size[p] else centres[p] for p in range(parts)])
    for _ in range(sweeps):
        sides = np.r_[np.repeat(np.arange(n), graph.shape[1]) * parts + part[graph].ravel(), graph.ravel() * parts + np.repeat(part, graph.shape[1])]
        votes = np.bincount(sides, minlength=n * parts).reshape(n, parts)
        gain, goal = votes.max(1) - votes[np.arange(n), part], votes.argmax(1)
        moved = 0
        for v in np.argsort(-gain, kind="stable")[: int((gain > 0).sum())]:
            to = int(goal[v])
            if size[to] < room:
                size[part[v]] -= 1
                size[to] += 1
                part[v] = to
                moved += 1
        if not moved:
            break
    return part


def fit(unit: np.ndarray, parts: int, seed: int = 7) -> Router:
    """Learned from unit vectors. With fewer than two vectors for each part there is one part."""
    rng = np.random.default_rng(seed)
    n, d = unit.shape
    if n < 2 * parts or n <= GRAPH + 1:
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    graph = nearest(unit, unit, GRAPH, np.arange(n))
    part = balanced_parts(unit, graph, parts, rng)
    wanted = np.zeros((n, parts))
    wanted[np.arange(n), part] = GRAPH / 2
    wanted += np.bincount(np.repeat(np.arange(n), GRAPH) * parts + part[graph].ravel(), minlength=n * parts).reshape(n, parts)
    wanted /= wanted.sum(1, keepdims=True)
    weights = [rng.normal(size=(d, HIDDEN)) * np.sqrt(2 / d), np.zeros(HIDDEN), rng.normal(size=(HIDDEN, parts)) / np.sqrt(HIDDEN), np.zeros(parts)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for t in range(1, STEPS + 1):
        pick = rng.integers(0, n, BATCH)
        x = unit[pick]
        hidden = np.maximum(x @ weights[0] + weights[1], 0)
        z = hidden @ weights[2] + weights[3]
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        out = (p - wanted[pick]) / BATCH
        into = (out @ weights[2].T) * (hidden > 0)
        for i, g in enumerate((x.T @ into, into.sum(0), hidden.T @ out, out.sum(0))):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            weights[i] = weights[i] - RATE * np.sqrt(1 - 0.999**t) / (1 - 0.9**t) * first[i] / (np.sqrt(second[i]) + 1e-8)
    router = Router(*weights, parts)
    tried = rng.choice(n, min(TRIED, n), replace=False)
    filed = router.parts(unit, 1)[:, 0]
    ranked = router.parts(unit[tried], parts)
    wanted_parts = filed[nearest(unit[tried], unit, 5, tried)]
    place = (ranked[:, None, :] == wanted_parts[:, :, None]).argmax(2)
    share = np.cumsum(np.bincount(place.ravel(), minlength=parts)) / place.size
    router.probes = int(np.searchsorted(share, RECALL)) + 1
    return router


def matrix(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of the rows that take part: of `size` finite components, not all zero."""
    column = batch.column("embedding")
    whole = pc.fill_null(pc.equal(pc.list_value_length(column), size), False)
    batch = batch.filter(whole)
    column = batch.column("embedding")
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), size)
    ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        squares = (x * x).sum(1)
    fit_in = np.isfinite(squares) & (squares > 0)
    return ids[fit_in], x[fit_in]


def lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))


def best_pairs(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the k rows of largest cosine, ties to smaller ids; rows that share the query's id are left out.

    Rows of one id and score count once, so as many more are looked at as ids repeat."""
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    most = k + int((ids[1:] == ids[:-1]).sum())
    lengths, unit = np.sqrt((rows * rows).sum(1)), units(rows)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(queries), 256):
        q, q_ids = queries[at : at + 256], query_ids[at : at + 256]
        q_length = np.sqrt((q * q).sum(1))
        scores = (q / q_length[:, None]) @ unit.T
        scores[q_ids[:, None] == ids[None, :]] = -np.inf
        last = np.partition(scores, len(ids) - most, axis=1)[:, len(ids) - most] if len(ids) > most else np.full(len(q), -2.0)
        for i in range(len(q)):
            near = np.flatnonzero(scores[i] >= max(last[i] - CLOSE, -2.0))
            exact = (rows[near] * q[i]).sum(1) / (lengths[near] * q_length[i])
            top = np.lexsort((ids[near], -exact))
            if most > k:
                a, b = ids[near][top], exact[top]
                top = top[np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(top)]]
            top = top[:k]
            out.append((np.full(len(top), q_ids[i]), ids[near][top], exact[top]))
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (empty, empty, np.zeros(0))


def search(vectors: DataFrame, is_query: str, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows, by cosine, found for each row of vec_id, embedding that `is_query` selects.

    Vectors that are null, zero, of another length than most, or with null or non-finite components take no part. Rows
    with the query's vec_id are no candidates; equal scores rank by vec_id. Every row is filed under its likeliest part,
    and a query is compared with all rows of `Router.probes` parts, and of further ones while they hold fewer than k ids
    besides its own. Parts are cut into blocks of rows, so a part of any
    size is searched in bounded tasks."""
    spark = vectors.sparkSession
    columns = vectors.select("vec_id", "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    lengths = columns.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    result = "query_id long, rank int, vec_id long, score double"
    if lengths is None or not lengths["size"]:
        return spark.createDataFrame([], result)
    size, n = lengths["size"], lengths["n"]
    draw = F.pmod(F.xxhash64("vec_id", F.lit("neighbours")), F.lit(1 << 20)) / float(1 << 20)
    sample = columns.where(draw < min(1.0, SAMPLE / n)).toArrow().sort_by("vec_id")
    read = [matrix(x, size) for x in sample.to_batches()]
    parts = int(min(MOST_PARTS, max(LEAST_PARTS, n // PART_ROWS)))
    router = fit(units(np.concatenate([np.zeros((0, size)), *(x for _, x in read)])), parts)

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = matrix(batch, size)
            part = router.parts(units(x), 1)[:, 0]
            yield pa.RecordBatch.from_arrays([pa.array(ids), lists(x), pa.array(part.astype(np.int32))], names=["vec_id", "vec", "part"])

    rows = columns.mapInArrow(filed, "vec_id long, vec array<double>, part int")
    held = np.zeros(len(router.b2), np.int64)  # ids of each part; one that is in several counts in one
    for r in rows.groupBy("vec_id").agg(F.min("part").alias("part")).groupBy("part").count().collect():
        held[r["part"]] = r["count"]

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = matrix(batch, size)
            ranked = router.parts(units(x), len(held))
            before = np.cumsum(held[ranked], 1) - held[ranked]
            taken = (np.arange(len(held)) < router.probes) | (before < k + 1)
            times = taken.sum(1)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, times)), lists(np.repeat(x, times, axis=0)), pa.array(ranked[taken].astype(np.int32))], names=["query_id", "vec", "part"])

    asked = columns.where(is_query).mapInArrow(routed, "query_id long, vec array<double>, part int")
    count = {r["part"]: (r["rows"], r["asked"]) for r in rows.select("part", F.lit(1).alias("r"), F.lit(0).alias("a")).union(asked.select("part", F.lit(0), F.lit(1))).groupBy("part").agg(F.sum("r").alias("rows"), F.sum("a").alias("asked")).collect()}
    if not count:
        return spark.createDataFrame([], result)
    blocks = F.create_map(*[F.lit(x) for p, (r, _) in count.items() for x in (p, -(-r // BLOCK_ROWS) or 1)])[F.col("part")]
    query_blocks = F.create_map(*[F.lit(x) for p, (_, a) in count.items() for x in (p, -(-a // BLOCK_QUERIES) or 1)])[F.col("part")]
    rows = rows.select("vec_id", "vec", "part", F.pmod(F.xxhash64("vec_id"), blocks).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), query_blocks - 1)).alias("query_block"))
    asked = asked.select("query_id", "vec", "part", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.pmod(F.xxhash64("query_id"), query_blocks).cast("int").alias("query_block"))
    place = ["part", "block", "query_block"]

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        pairs = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if left.num_rows and right.num_rows:
            a, b = (t["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size) for t in (left, right))
            pairs = best_pairs(right["query_id"].to_numpy(), b, left["vec_id"].to_numpy(), a, k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), pairs, strict=True)))

    found = rows.groupBy(*place).cogroup(asked.groupBy(*place)).applyInArrow(compare, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
