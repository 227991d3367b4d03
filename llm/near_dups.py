"""Near-duplicate documents: MinHash with tensored banding, links confirmed on whole shingle sets, one document kept of each group."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.columns import flat, over_chunks, staged
from llm.components import connected_components
from llm.exact_dups import groups
from llm.hashing import byte_values, mixed, prefix, stretches, word_bounds

#: Words of a shingle, and the link rule: 100 * intersection >= percent * union, where the caller names no other percent.
SHINGLE = 5
PERCENT = 85
#: MinHashes of a small collection. Every pair of collections makes a table; its key joins the two.
ROWS = 2
#: Most probability that two sets of just the percent share no key, and most collections.
MISSED = 1e-5
MOST_COLLECTIONS = 64
#: Texts, and shingles, of a family that are compared in one task; larger families are cut into blocks.
BLOCK_TEXTS = 1000
BLOCK_SHINGLES = 400_000
#: Bytes of texts that a task turns into sets at once; some fifty times as many are held meanwhile.
TEXT_BYTES = 1 << 20

_SEEDS = np.random.default_rng(85).integers(1, 1 << 63, (MOST_COLLECTIONS * ROWS, 2), dtype=np.uint64) | np.uint64(1)


def missed(percent: int, n: int) -> float:
    """The probability that sets of similarity percent / 100 agree in fewer than two of n collections, and so share no key."""
    q = (percent / 100) ** ROWS
    return (1 - q) ** n + n * q * (1 - q) ** (n - 1)


def collections(percent: int) -> int:
    """The fewest collections that miss a link with probability MISSED at most: 12 (7e-6) for 85 percent, 15 (6e-6) for 80."""
    found = next((n for n in range(2, MOST_COLLECTIONS + 1) if missed(percent, n) <= MISSED), None)
    if found is None:
        raise ValueError(f"{percent} percent takes more than {MOST_COLLECTIONS} collections")
    return found


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its shingles; with fewer words than a shingle, that of the whole sequence.

    TEXT_BYTES of text at a time, or one text that is longer: what is held beside the sets does not grow with the texts."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(size // TEXT_BYTES)) + 1).tolist(), len(texts)]
    return [x for a, b in zip(cuts, cuts[1:], strict=False) if b > a for x in _sets_of(texts.slice(a, b - a))]


def _sets_of(texts: pa.Array) -> list[np.ndarray]:
    data, offsets = flat(texts)
    small = np.arange(256, dtype=np.uint8)
    small[65:91] += 32
    data = small[data]
    starts, ends, bounds = word_bounds(data, offsets)
    sums = prefix(stretches(prefix(byte_values(data)), starts, ends))
    count = np.diff(bounds)
    number = np.where(count > 0, np.maximum(count - SHINGLE + 1, 1), 0)
    owner = np.repeat(np.arange(len(count)), number)
    begin = bounds[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
    hashes = stretches(sums, begin, np.minimum(begin + SHINGLE, bounds[owner + 1]))
    cut = np.cumsum(np.r_[0, number]).tolist()
    return [np.unique(hashes[a:b]) for a, b in zip(cut, cut[1:], strict=False)]


def signatures(docs: DataFrame, n_bands: int) -> DataFrame:
    """doc_id, n_shingles, set_a and set_b (hashes of the whole set), bands (one number for each of n_bands collections) of every row."""

    def work(chunk: pa.RecordBatch) -> dict[str, object]:
        sets = shingle_sets(chunk.column("text"))
        size = np.array([len(x) for x in sets], np.int64)
        full = np.flatnonzero(size)
        n = len(sets)
        bands = np.zeros((n, n_bands), np.int64)
        a, b = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if len(full):
            all_hashes = np.concatenate([sets[i] for i in full])
            starts = (np.cumsum(size[full]) - size[full]).astype(np.int64)
            a[full] = np.add.reduceat(mixed(all_hashes ^ np.uint64(0x5851F42D4C957F2D)), starts).view(np.int64)
            b[full] = np.bitwise_xor.reduceat(mixed(all_hashes + np.uint64(0x14057B7EF767814F)), starts).view(np.int64)
            least = [np.minimum.reduceat(mixed((all_hashes ^ x) * y), starts) for x, y in _SEEDS[: n_bands * ROWS]]
            for i in range(n_bands):
                joined = least[i * ROWS]
                for other in least[i * ROWS + 1 : (i + 1) * ROWS]:
                    joined = mixed(joined * np.uint64(0x9E3779B97F4A7C15) + other)
                bands[full, i] = joined.view(np.int64)
        lists = pa.ListArray.from_arrays(np.arange(0, n * n_bands + 1, n_bands, dtype=np.int32), pa.array(bands.ravel()))
        return {"doc_id": chunk.column("doc_id"), "n_shingles": size, "set_a": a, "set_b": b, "bands": lists}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return over_chunks(docs, ["doc_id", "text"], work, f"doc_id {kind}, n_shingles long, set_a long, set_b long, bands array<long>", TEXT_BYTES)


def table_keys(sets: DataFrame, n_bands: int) -> DataFrame:
    """node, key: one key for each pair of the n_bands collections."""
    pairs = [F.xxhash64(F.lit(i * n_bands + j), F.col("bands")[i], F.col("bands")[j]) for i in range(n_bands) for j in range(i)]
    return sets.select("node", F.explode(F.array(*pairs)).alias("key"))


@dataclass
class _Forest:
    """Components of the rows of one family so far."""

    parent: list[int]

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def join(self, i: int, j: int) -> None:
        self.parent[self.find(i)] = self.find(j)


def family_links(sets: list[np.ndarray], side: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that join the same rows as all links between rows of different sides, or of side 0, do.

    Rows come by size; a row meets those before it that share one of its rarest shingles, enough of them that no link
    can be missed, most shared first, and of each component only until a link with it is found."""
    if len(sets) == 2:
        a, b = sets
        shared = len(np.intersect1d(a, b, assume_unique=True)) if percent * max(len(a), len(b)) <= 100 * min(len(a), len(b)) else 0
        linked = (side[0] != side[1] or side[0] == 0) and 100 * shared >= percent * (len(a) + len(b) - shared)
        return [(0, 1)] if linked and shared else []
    tokens, inverse, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rarity = np.empty(len(tokens), np.int64)
    rarity[np.argsort(times, kind="stable")] = np.arange(len(tokens))
    ranks = np.split(rarity[inverse.ravel()], np.cumsum([len(x) for x in sets])[:-1])
    ranks = [np.sort(x) for x in ranks]
    size = np.array([len(x) for x in sets])
    forest, links = _Forest(list(range(len(sets)))), []
    index: dict[int, list[int]] = {}
    for i in np.argsort(size, kind="stable").tolist():
        own, n = ranks[i], int(size[i])
        head = own[: n - -(-percent * n // 100) + 1].tolist()
        met: dict[int, int] = {}
        for token in head:
            for j in index.get(token, ()):
                met[j] = met.get(j, 0) + 1
        for j in sorted(met, key=met.get, reverse=True):
            if 100 * size[j] < percent * n or (side[i] == side[j] != 0) or forest.find(i) == forest.find(j):
                continue
            shared = len(np.intersect1d(own, ranks[j], assume_unique=True))
            if 100 * shared >= percent * (n + int(size[j]) - shared):
                forest.join(i, j)
                links.append((j, i))
        for token in head:
            index.setdefault(token, []).append(i)
    return links


def _compare(rows: DataFrame, kind: str, percent: int) -> DataFrame:
    """a, b of links within each `family` (a number) of rows node, text, side."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, TEXT_BYTES, "family", "text"):
            family, node, side = (table[x].to_numpy() for x in ("family", "node", "side"))
            sets = shingle_sets(table["text"].combine_chunks())
            cut = np.flatnonzero(np.r_[True, family[1:] != family[:-1], True]).tolist()
            left, right = [], []
            for a, b in zip(cut, cut[1:], strict=False):
                for i, j in family_links(sets[a:b], side[a:b], percent):
                    left.append(a + i)
                    right.append(a + j)
            take = table["node"].combine_chunks()
            yield pa.RecordBatch.from_arrays([take.take(pa.array(left, pa.int64())), take.take(pa.array(right, pa.int64()))], names=["a", "b"])
        pa.default_memory_pool().release_unused()

    return rows.select("family", "node", "side", "text").repartition("family").sortWithinPartitions("family").mapInArrow(decide, f"a {kind}, b {kind}")


def links(docs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """a, b: links between representatives that join the same texts as all links do.

    `sets`: node, n_shingles, bands of one row for each distinct set; node is the doc_id of one row that has it. All
    nodes that share a table's key make a family with the smallest of them, its leader. Two linked texts share a key but
    for the probability MISSED, so they meet in a family. Families are compared on whole sets; a family of more than
    BLOCK_TEXTS texts or BLOCK_SHINGLES shingles is cut into blocks, and each pair of blocks meets in a task of its own."""
    kind = sets.schema["node"].dataType.simpleString()
    keys = table_keys(sets, collections(percent))
    leaders = keys.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1").select("key", "leader")
    members = keys.join(leaders, "key").select("leader", "node").distinct().join(sets.select("node", "n_shingles"), "node")
    members = staged(members)
    # a size that no other in the family comes near to cannot be linked there; linked sizes are of the same band or of neighbouring ones
    steps = members.withColumn("band", F.floor(F.log("n_shingles") / float(1.0001 * np.log(100 / percent))).cast("int"))
    crowd = steps.groupBy("leader", "band").agg(F.count("*").alias("n"))
    near = crowd.select("leader", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"), "n").groupBy("leader", "band").agg(F.sum("n").alias("near"))
    kept = steps.join(near.where("near > 1"), ["leader", "band"]).select("leader", "node", "n_shingles")
    sizes = kept.groupBy("leader").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    placed = kept.join(sizes.select("leader", blocks.alias("blocks")), "leader").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # in a task of one block all pairs count, in one of two blocks those between them
    met = met.select("node", F.xxhash64("leader", F.least("block", "other"), F.greatest("block", "other")).alias("family"), F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side"))
    texts = docs.select(F.col("doc_id").alias("node"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # a merge join at every size: the members may be any share of all texts
    return _compare(met.hint("merge").join(texts, "node"), kind, percent)


def grouped(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Null, empty and wordless texts have no shingles and stand alone. Texts of equal sets are copies and link at once. Rows
    that share a doc_id count as one document, which has the links of all its texts. Rows without a doc_id link with nothing:
    their component is null, and they are kept."""
    found = staged(signatures(docs, collections(percent)))
    some = found.where("n_shingles > 0 AND doc_id IS NOT NULL")
    copies = some.groupBy("set_a", "set_b").agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("one"))
    copies = staged(copies.select("set_a", "set_b", F.col("one.doc_id").alias("node"), F.col("one.n_shingles").alias("n_shingles"), F.col("one.bands").alias("bands")))
    # the texts of one doc_id are joined by links to its first set
    shared_ids = some.groupBy("doc_id").agg(F.min("set_a").alias("low"), F.max("set_a").alias("high")).where("low <> high").select("doc_id")
    own = some.join(shared_ids, "doc_id").join(copies.select("set_a", "set_b", "node"), ["set_a", "set_b"]).select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    joined = connected_components(links(docs, copies, percent).union(own))
    of_set = copies.select("set_a", "set_b", "node").join(joined, "node", "left").select("set_a", "set_b", F.coalesce("component", "node").alias("__component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.col("__component"), F.col("doc_id")))
    return found.join(of_set, ["set_a", "set_b"], "left").select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs`, all columns, whose document is kept; rows with a null doc_id stay. Of repeated rows all stay or go together."""
    kept = grouped(docs.where("doc_id IS NOT NULL"), percent).where("NOT kept").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_anti").select(*docs.columns)
