"""Removal of passages that recur across documents: Aho-Corasick automata of confirmed phrases, sharded by anchor."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.anchors import cover, owned_runs, runs
from llm.columns import flat, free_names, over_chunks, staged
from llm.exact_dups import ANCHOR_BYTES, groups, keyed
from llm.hashing import byte_values, prefix, stretches, word_bounds

#: Words of a phrase, and of the grams among which its anchor is chosen.
WINDOW = 50
GRAM = 8
#: Segments of one anchor that a task compares. Beyond, they are cut into single phrases, each a key of its own.
MOST_SEGMENTS = 10_000
#: Bytes of segments whose phrases are compiled together, and most phrases of one automaton.
SHARD_BYTES = 1 << 20
MOST_PHRASES = 20_000


def _words(chunk: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, word starts and ends, the texts' offsets among the words, and prefix sums over the words' hashes."""
    data, offsets = flat(chunk.column("text"))
    starts, ends, bounds = word_bounds(data, offsets)
    return data, starts, ends, bounds, prefix(stretches(prefix(byte_values(data)), starts, ends))


def _letters(segments: list[list[bytes]]) -> list[str]:
    """Each segment as a string with one character for each word."""
    known: dict[bytes, str] = {}
    for words in segments:
        for w in words:
            if w not in known:
                i = len(known) + 1
                known[w] = chr(i if i < 0xD800 else i + 0x800)
    return ["".join([known[w] for w in words]) for words in segments]


def located(segments: list[str], window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Every place of every phrase of `window` characters that stands in the segments twice: segment, start, and the phrase's number.

    Hashes say which phrases may recur; automata of those, of at most MOST_PHRASES each, find all their places."""
    sizes = np.array([len(x) for x in segments], np.int64)
    flat_text = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.cumsum(np.r_[0, sizes])
    number = np.maximum(sizes - window + 1, 0)
    owner = np.repeat(np.arange(len(segments)), number)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
    if not len(owner):
        return
    at = offsets[owner] + start
    sums = prefix((flat_text.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    _, first, kind, times = np.unique(stretches(sums, at, at + window), return_index=True, return_inverse=True, return_counts=True)
    recurring = np.flatnonzero(times > 1)
    shard_of = np.full(len(times), -1)
    shard_of[recurring] = np.arange(len(recurring)) // MOST_PHRASES
    for shard in range(-(-len(recurring) // MOST_PHRASES)):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k in recurring[shard * MOST_PHRASES : (shard + 1) * MOST_PHRASES].tolist():
            i, a = int(owner[first[k]]), int(start[first[k]])
            automaton.add_word(segments[i][a : a + window], k)
        automaton.make_automaton()
        for i in np.unique(owner[shard_of[kind.ravel()] == shard]).tolist():
            hits = np.array(list(automaton.iter(segments[i])), np.int64).reshape(-1, 2)
            yield np.full(len(hits), i), hits[:, 0] - window + 1, hits[:, 1]


def recurring_words(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, most_segments: int = MOST_SEGMENTS) -> DataFrame:
    """key, n, lo, size (in words): stretches of the texts of `keyed` rows, made of phrases that start in a text of smaller doc_id."""
    texts = keyed(docs)

    def anchors(chunk: pa.RecordBatch) -> dict[str, object]:
        _, _, _, bounds, sums = _words(chunk)
        found = owned_runs(sums, bounds, window, gram)
        row = pa.array(found["text"])
        return {"doc_id": chunk.column("doc_id").take(row), "key": chunk.column("key").take(row), "n": chunk.column("n").take(row), "lo": found["lo"].astype(np.int32), "size": found["size"].astype(np.int32), "hash": found["hash"], "segment": found["segment"]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    all_runs = over_chunks(texts.where((F.col("n") >= 2 * window - 1) & F.col("doc_id").isNotNull()), ["doc_id", "key", "n", "text"], anchors, f"doc_id {kind}, key long, n long, lo int, size int, hash long, segment long", ANCHOR_BYTES)
    across = staged(all_runs.groupBy("hash").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.min("segment").alias("a"), F.max("segment").alias("b")).where("first_doc < last_doc"))
    shared = staged(all_runs.join(across.select("hash", "first_doc", (F.col("a") == F.col("b")).alias("alike")), "hash"))

    # where an anchor's segments are all alike, all but the first document's go; others are compared, one of each kind
    alike = shared.where("alike AND doc_id > first_doc").select("key", "n", "lo", "size")
    others = shared.where("NOT alike").drop("first_doc")
    kinds = others.groupBy("hash", "segment").agg(F.min("doc_id").alias("first_doc"), F.min(F.struct("key", "n", "lo", "size")).alias("at"))
    crowded = kinds.groupBy("hash").agg((F.count("*") > most_segments).alias("crowded"))
    wanted = kinds.join(crowded, "hash").groupBy("at.key", "at.n").agg(F.collect_list(F.struct("hash", "segment", "first_doc", "at.lo", "at.size", "crowded")).alias("wanted"))
    cut = staged(_segments(texts.join(wanted, ["key", "n"]), window, kind))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, SHARD_BYTES):
            split = [x.split() for x in table["segment_text"].to_pylist()]
            own_first = table["first_doc"].to_numpy()
            number = np.array([max(len(x) - window + 1, 0) for x in split], np.int64)
            begin = np.cumsum(number) - number
            first = np.repeat(own_first, number)  # of each phrase of each segment, the smallest document that has it
            places, phrases = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for segment, start, phrase in located(_letters(split), window):
                places.append(begin[segment] + start)
                phrases.append(phrase)
            place, phrase = np.concatenate(places), np.concatenate(phrases)
            if len(place):
                order = np.lexsort((first[place], phrase))
                place, phrase = place[order], phrase[order]
                head = np.r_[True, phrase[1:] != phrase[:-1]]
                first[place] = first[place][head][np.cumsum(head) - 1]
            owner = np.repeat(np.arange(len(split)), number)
            fresh = np.flatnonzero(np.r_[True, (np.diff(owner) != 0) | (first[1:] != first[:-1])][: len(owner)])
            last = np.r_[fresh[1:], len(owner)] - 1 if len(fresh) else fresh
            row = pa.array(owner[fresh])
            yield pa.RecordBatch.from_arrays(
                [table["hash"].combine_chunks().take(row), table["segment"].combine_chunks().take(row), pa.array((fresh - begin[owner[fresh]]).astype(np.int32)), pa.array((last - fresh + window).astype(np.int32)), pa.array(first[fresh], table.schema.field("first_doc").type)],
                names=["hash", "segment", "start", "length", "first_doc"],
            )

    compared = cut.where("segment_text IS NOT NULL").dropDuplicates(["hash", "segment"]).select("hash", "segment", "first_doc", "segment_text")
    decided = compared.repartition("hash").sortWithinPartitions("hash").mapInArrow(decide, f"hash long, segment long, start int, length int, first_doc {kind}")
    single = cut.where("segment_text IS NULL").dropDuplicates(["hash", "segment", "start"])
    firsts = single.groupBy("window_hash").agg(F.min("first_doc").alias("least_doc"))
    single = single.join(firsts, "window_hash").select("hash", "segment", "start", F.lit(window).alias("length"), F.col("least_doc").alias("first_doc"))
    parts = others.join(decided.unionByName(single), ["hash", "segment"]).where("doc_id > first_doc")
    return alike.union(parts.select("key", "n", F.col("lo") + F.col("start"), "length"))


def _segments(texts: DataFrame, window: int, kind: str) -> DataFrame:
    """The text of the wanted segments; of those of a crowded anchor, the hash of each phrase instead."""

    def read(chunk: pa.RecordBatch) -> dict[str, object]:
        data, starts, ends, bounds, sums = _words(chunk)
        lists = chunk.column("wanted")
        row = np.repeat(np.arange(chunk.num_rows), np.diff(lists.offsets.to_numpy()))
        values = lists.flatten()
        lo, size, crowded = (values.field(x).to_numpy(zero_copy_only=False) for x in ("lo", "size", "crowded"))
        begin = bounds[row] + lo
        raw = data.tobytes()
        whole, many = np.flatnonzero(~crowded), np.flatnonzero(crowded)
        text = [raw[a:b] for a, b in zip(starts[begin[whole]].tolist(), ends[begin[whole] + size[whole] - 1].tolist(), strict=True)]
        number = size[many] - window + 1
        owner = np.repeat(many, number)
        start = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        at = begin[owner] + start
        hashes = stretches(sums, at, at + window).view(np.int64) if len(owner) else np.zeros(0, np.int64)
        both = pa.array(np.r_[whole, owner])
        return {
            "hash": values.field("hash").take(both), "segment": values.field("segment").take(both), "first_doc": values.field("first_doc").take(both), "segment_text": text + [None] * len(owner),
            "start": np.r_[np.zeros(len(whole), np.int32), start.astype(np.int32)], "window_hash": np.r_[np.zeros(len(whole), np.int64), hashes],
        }

    return over_chunks(texts, ["text", "wanted"], read, f"hash long, segment long, first_doc {kind}, segment_text binary, start int, window_hash long", ANCHOR_BYTES)


def _marks(stretches_: DataFrame) -> DataFrame:
    """key, n, marks: the stretches of each row; equal rows share theirs, so each counts once."""
    return stretches_.groupBy("key", "n").agg(F.collect_set(F.struct("lo", "size")).alias("marks"))


def _removed(chunk: pa.RecordBatch, column: str = "marks") -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each row: its bytes, its words' starts and ends in them, and the starts and ends of the runs of words that go."""
    data, offsets = flat(chunk.column("text"))
    starts, ends, bounds = word_bounds(data, offsets)
    raw, lists = data.tobytes(), chunk.column(column)
    at = lists.offsets.to_numpy()
    lo, size = (lists.values.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("lo", "size"))
    none = np.zeros(0, np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        own = slice(bounds[i], bounds[i + 1])
        marks = slice(at[i], at[i + 1])
        gone = runs(cover(int(bounds[i + 1] - bounds[i]), lo[marks], size[marks])) if at[i] < at[i + 1] else (none, none)
        yield raw[a:b], starts[own] - a, ends[own] - a, *gone


def removal_digests(docs: DataFrame, window: int = WINDOW, **options: int) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words, joined by single spaces) for every row.

    A word goes if a phrase of `window` words covers it that also starts in a text of smaller doc_id. Null counts as
    empty; shorter texts lose nothing; rows that share a doc_id take nothing from each other, and rows without one take and
    lose nothing."""

    def work(chunk: pa.RecordBatch) -> dict[str, object]:
        total, removed, digests = [], [], []
        for raw, starts, _, gone, until in _removed(chunk):
            words = raw.split()
            kept, at = [], 0
            for a, b in zip(gone.tolist(), until.tolist(), strict=True):
                kept += words[at:a]
                at = b
            kept += words[at:]
            total.append(len(words))
            removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        return {"doc_id": chunk.column("doc_id"), "n_words": total, "n_removed": removed, "kept_sha256": digests}

    marks = _marks(recurring_words(docs, window, **options))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return over_chunks(keyed(docs).join(marks, ["key", "n"], "left"), ["doc_id", "text", "marks"], work, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def without_recurring(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The same rows and columns; recurring words go from `text`, with the white space behind them. Other texts stay as they are, null too."""
    names = docs.columns
    key, n, own = free_names(docs, "key", "n", "marks")

    def work(chunk: pa.RecordBatch) -> dict[str, object]:
        texts = chunk.column("text")
        if chunk.column(own).null_count < chunk.num_rows:
            new = texts.to_pylist()
            for i, (raw, starts, _, gone, until) in enumerate(_removed(chunk, own)):
                if len(gone):
                    parts, at = [], 0
                    for a, b in zip(gone.tolist(), until.tolist(), strict=True):
                        parts.append(raw[at : starts[a]])
                        at = int(starts[b]) if b < len(starts) else len(raw)
                    new[i] = b"".join([*parts, raw[at:]]).decode()
            texts = pa.array(new, texts.type)
        return {x: texts if x == "text" else chunk.column(x) for x in names}

    text = F.coalesce(F.col("text"), F.lit(""))
    marks = _marks(recurring_words(docs, window)).toDF(key, n, own)
    rows = docs.withColumns({key: F.xxhash64("doc_id", text), n: F.octet_length(text).cast("long")}).join(marks, [key, n], "left")
    return over_chunks(rows, [*names, own], work, T.StructType(docs.schema.fields))
