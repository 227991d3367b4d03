"""Removal of byte strings that occur twice: anchors bring equal windows together, a suffix array decides."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.anchors import cover, owned_runs, runs
from llm.columns import flat, over_chunks, staged
from llm.hashing import byte_values, prefix, stretches
from llm.suffixes import repeated_starts

#: Bytes of a window, and of the grams among which its anchor is chosen.
WINDOW = 200
GRAM = 32
#: Segments of one anchor that a task compares. Beyond, they are cut into single windows, each a key of its own.
MOST_SEGMENTS = 20_000
#: Bytes of text whose anchors are found at once: some hundred times as many are held meanwhile.
ANCHOR_BYTES = 1 << 20
#: Bytes of segments that are sorted at once.
SORTED_BYTES = 1 << 20


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), its length in bytes, and a key of the row; equal rows share it, and their results."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n"), F.xxhash64("doc_id", text).alias("key"))


def groups(batches: Iterator[pa.RecordBatch], least: int, key: str = "hash", text: str = "segment_text") -> Iterator[pa.Table]:
    """Rows sorted by the number `key` in tables of `least` bytes of `text` or more, cut between keys."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= least:
            table = pa.Table.from_batches(held)
            hashes = table[key].to_numpy()
            end = int(np.searchsorted(hashes, hashes[-1], "left"))
            ends = np.cumsum(pc.binary_length(table[text]).to_numpy())
            at = 0
            while at < end:
                cut = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + least, "left")) + 1
                cut = min(end, int(np.searchsorted(hashes, hashes[min(cut, len(hashes)) - 1], "right")))
                yield table.slice(at, cut - at)
                at = cut
            held = table.slice(end).to_batches()
            size = sum(x.column(text).nbytes for x in held)
    if held:
        yield pa.Table.from_batches(held)


def repeated_bytes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, most_segments: int = MOST_SEGMENTS) -> DataFrame:
    """key, n, lo, size: stretches of the texts of `keyed` rows, made of windows that also start elsewhere in any text."""
    texts = keyed(docs)

    def anchors(chunk: pa.RecordBatch) -> dict[str, object]:
        data, offsets = flat(chunk.column("text"))
        found = owned_runs(prefix(byte_values(data)), offsets, window, gram)
        row = pa.array(found["text"])
        return {"key": chunk.column("key").take(row), "n": chunk.column("n").take(row), "lo": found["lo"].astype(np.int32), "size": found["size"].astype(np.int32), "hash": found["hash"], "segment": found["segment"]}

    all_runs = over_chunks(texts.where(F.col("n") >= window), ["key", "n", "text"], anchors, "key long, n long, lo int, size int, hash long, segment long", ANCHOR_BYTES)
    twice = staged(all_runs.groupBy("hash").agg(F.count("*").alias("times"), F.min("segment").alias("a"), F.max("segment").alias("b")).where("times > 1").select("hash", (F.col("a") == F.col("b")).alias("alike")))
    shared = staged(all_runs.join(twice, "hash"))

    # segments of one anchor that are all alike repeat as a whole; others are compared, one of each kind
    alike = shared.where("alike").select("key", "n", "lo", "size")
    others = shared.where("NOT alike")
    kinds = others.groupBy("hash", "segment").agg(F.count("*").alias("times"), F.min(F.struct("key", "n", "lo", "size")).alias("at"))
    crowded = kinds.groupBy("hash").agg((F.count("*") > most_segments).alias("crowded"))
    wanted = kinds.join(crowded, "hash").groupBy("at.key", "at.n").agg(F.collect_list(F.struct("hash", "segment", "times", "at.lo", "at.size", "crowded")).alias("wanted"))
    cut = staged(_segments(texts.join(wanted, ["key", "n"]), window))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, SORTED_BYTES):
            again = repeated_starts(table["segment_text"].to_pylist(), window)
            starts, sizes = [], []
            for times, size, own in zip(table["times"].to_pylist(), table["size"].to_pylist(), again, strict=True):
                mask = np.zeros(size - window + 1, bool)
                mask[own] = True
                a, b = runs(mask | (times > 1))
                starts.append(a.astype(np.int32))
                sizes.append((b - a + window - 1).astype(np.int32))
            yield pa.RecordBatch.from_arrays([table["hash"].combine_chunks(), table["segment"].combine_chunks(), pa.array(starts, pa.list_(pa.int32())), pa.array(sizes, pa.list_(pa.int32()))], names=["hash", "segment", "starts", "sizes"])

    compared = cut.where("segment_text IS NOT NULL").dropDuplicates(["hash", "segment"]).select("hash", "segment", "times", "size", "segment_text")
    decided = compared.repartition("hash").sortWithinPartitions("hash").mapInArrow(decide, "hash long, segment long, starts array<int>, sizes array<int>")
    single = cut.where("segment_text IS NULL").dropDuplicates(["hash", "segment", "start"])
    counted = single.groupBy("window_hash").agg(F.sum("times").alias("times")).where("times > 1").select("window_hash")
    single = single.join(counted, "window_hash").groupBy("hash", "segment").agg(F.collect_list("start").alias("starts")).withColumn("sizes", F.expr(f"transform(starts, x -> {window})"))
    decided = decided.unionByName(single).where("size(starts) > 0")
    parts = others.join(decided, ["hash", "segment"]).select("key", "n", "lo", F.explode(F.arrays_zip("starts", "sizes")).alias("part"))
    return alike.union(parts.select("key", "n", F.col("lo") + F.col("part.starts"), F.col("part.sizes")))


def _segments(texts: DataFrame, window: int) -> DataFrame:
    """The bytes of the wanted segments; of those of a crowded anchor, the hash of each window instead."""

    def read(chunk: pa.RecordBatch) -> dict[str, object]:
        data, offsets = flat(chunk.column("text"))
        lists = chunk.column("wanted")
        row = np.repeat(np.arange(chunk.num_rows), np.diff(lists.offsets.to_numpy()))
        fields = {x.name: lists.flatten().field(x.name).to_numpy(zero_copy_only=False) for x in lists.type.value_type}
        begin = offsets[row] + fields["lo"]
        whole = np.flatnonzero(~fields["crowded"])
        raw = data.tobytes()
        bytes_of = [raw[a : a + n] for a, n in zip(begin[whole].tolist(), fields["size"][whole].tolist(), strict=True)]
        many = np.flatnonzero(fields["crowded"])
        number = fields["size"][many] - window + 1
        owner = np.repeat(many, number)
        start = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        if len(owner):
            at = begin[owner] + start
            hashes = stretches(prefix(byte_values(data)), at, at + window).view(np.int64)
        else:
            hashes = np.zeros(0, np.int64)
        both = np.r_[whole, owner]
        nothing = [None] * len(owner)
        return {
            "hash": fields["hash"][both], "segment": fields["segment"][both], "times": fields["times"][both], "size": fields["size"][both], "segment_text": bytes_of + nothing,
            "start": np.r_[np.zeros(len(whole), np.int32), start.astype(np.int32)], "window_hash": np.r_[np.zeros(len(whole), np.int64), hashes],
        }

    return over_chunks(texts, ["text", "wanted"], read, "hash long, segment long, times long, size int, segment_text binary, start int, window_hash long")


def with_removals(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """doc_id, text, n and the marks of each row (starts and sizes), or null where it has none."""
    per_row = marks.groupBy("key", "n").agg(F.collect_set(F.struct("lo", "size")).alias("marks"))
    return keyed(docs).join(per_row, ["key", "n"], "left")


def removal_digests(docs: DataFrame, window: int = WINDOW, **options: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row.

    Each byte goes that a string of `window` bytes covers which also starts at any other place, in the same text too.
    Null counts as empty; shorter texts lose nothing; of repeated rows each is a copy of the others, so both go."""

    def work(chunk: pa.RecordBatch) -> dict[str, object]:
        data, offsets = flat(chunk.column("text"))
        raw, lists = data.tobytes(), chunk.column("marks")
        bounds = lists.offsets.to_numpy()
        lo, size = (lists.values.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("lo", "size"))
        removed, spans, digests = [], [], []
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            own = slice(bounds[i], bounds[i + 1])
            if bounds[i] == bounds[i + 1]:
                starts = ends = np.zeros(0, np.int64)
            else:
                starts, ends = runs(cover(b - a, lo[own], size[own]))
            kept = hashlib.sha256()
            at = a
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                kept.update(raw[at : a + s])
                at = a + e
            kept.update(raw[at:b])
            removed.append(int((ends - starts).sum()))
            spans.append(len(starts))
            digests.append(kept.hexdigest())
        return {"doc_id": chunk.column("doc_id"), "n_bytes": np.diff(offsets), "n_removed": removed, "n_spans": spans, "kept_sha256": digests}

    kind = docs.schema["doc_id"].dataType.simpleString()
    marked = with_removals(docs, repeated_bytes(docs, window, **options))
    return over_chunks(marked, ["doc_id", "text", "marks"], work, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
