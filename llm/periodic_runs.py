"""Periodic runs of words: Lyndon roots extended both ways by longest common extensions of suffix trees."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.anchors import runs as stretches_of
from llm.columns import flat, over_chunks, spread
from llm.hashing import mixed, word_bounds
from llm.suffix_tree import Extensions, next_smaller

#: A run has at least so many words, and two whole periods.
LEAST_WORDS = 12
#: Words of the grams that tell where a run can be: half the words of the shortest run.
GRAM = LEAST_WORDS // 2
#: Stretches are joined into one tree up to so many words; a longer one has a tree of its own.
TREE_WORDS = 1 << 16
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers of the words data[start:end]; equal words have equal numbers, by their bytes and not by a hash."""
    lengths = ends - starts
    offsets = np.cumsum(np.r_[0, lengths])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(spread(data, starts, lengths))])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def may_repeat(numbers: np.ndarray, owner: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Which of the words `inside` stand in a gram that its owner (words of an owner stand together) holds twice or more.

    Of a run of L words and period q every gram but those across its middle has an equal one q words on or back; the
    others are fewer than GRAM in a row and not at an end as L >= GRAM + q, so every word of a run is in a gram that counts.
    Grams are compared by hashes: a collision only lets a stretch through that has no run."""
    n = len(numbers) - GRAM + 1
    kept = np.zeros(len(numbers), bool)
    if n < 1:
        return kept
    value, key = mixed(numbers.astype(np.uint64) + np.uint64(1)), np.zeros(n, np.uint64)
    for k in range(GRAM):
        key = key * np.uint64(0x9E3779B97F4A7C15) + value[k : k + n]
    key = mixed(key ^ mixed(owner[:n].astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)))
    whole = np.cumsum(np.r_[0, inside])
    at = np.flatnonzero((whole[GRAM:] - whole[:-GRAM] == GRAM) & (owner[:n] == owner[GRAM - 1 :]))
    key = key[at]
    in_order = np.sort(key)
    again = np.unique(in_order[1:][in_order[1:] == in_order[:-1]])
    if len(again):
        place = np.minimum(np.searchsorted(again, key), len(again) - 1)
        for k in range(GRAM):
            kept[at[again[place] == key] + k] = True
    return kept


def tree_runs(words: list[np.ndarray], least: int = LEAST_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of the sequences: which one, start, length, period. One pair of trees serves all; a value of its own ends each."""
    sizes = np.array([len(x) for x in words])
    distinct, number = np.unique(np.concatenate(words), return_inverse=True)
    ends = np.cumsum(sizes + 1) - 1
    s = np.empty(ends[-1] + 1, np.int64)
    is_end = np.zeros(len(s), bool)
    is_end[ends] = True
    s[is_end] = np.arange(len(ends))
    s[~is_end] = number.ravel() + len(ends)
    sigma, n = len(distinct) + len(ends), len(s)
    ahead = Extensions(s.tolist(), sigma)
    back = Extensions(s[-2::-1].tolist() + [int(s[-1])], sigma)  # the last end stays last
    # the longest Lyndon words from each place, in the order of the values and in the opposite one
    roots = [np.array(next_smaller(x)) for x in (ahead.rank.tolist(), (-ahead.rank).tolist())]
    begin = np.tile(np.arange(n), 2)
    period = np.concatenate(roots) - begin
    end_of = ends[np.searchsorted(ends, begin)]
    own = np.flatnonzero((begin < end_of) & (begin + period <= end_of))
    begin, period = begin[own], period[own]
    right = ahead.common(begin, begin + period)
    left = np.zeros(len(begin), np.int64)
    inner = np.flatnonzero(begin > 0)
    left[inner] = back.common(n - 1 - begin[inner], n - 1 - begin[inner] - period[inner])
    length = left + period + right
    found = np.flatnonzero((length >= 2 * period) & (length >= least))
    key = np.unique((begin - left)[found] * (n + 1) + period[found], return_index=True)[1]
    found = found[key]
    start = (begin - left)[found]
    which = np.searchsorted(ends, start)
    return which, start - (ends - sizes)[which], length[found], period[found]


def find_runs(numbers: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, start (a word of the text), length, period of all runs of texts numbers[bounds[i]:bounds[i + 1]], in this order."""
    owner, inside = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), np.ones(len(numbers), bool)
    for _ in range(2):
        inside = may_repeat(numbers, owner, inside)
        # stretches of words that may be in runs take the place of the texts
        fresh = inside & ~np.r_[False, inside[:-1] & (owner[1:] == owner[:-1])][: len(inside)]
        owner = np.where(inside, np.cumsum(fresh), 0) if len(inside) else owner
    edge = np.diff(np.r_[0, owner, 0]) != 0
    cuts = np.flatnonzero(edge)
    spans = [(a, b) for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False) if b - a >= LEAST_WORDS and inside[a]]
    out: list[tuple[np.ndarray, ...]] = []
    some: list[tuple[int, int]] = []
    held = 0
    for i, (a, b) in enumerate(spans):
        some.append((a, b))
        held += b - a
        if held >= TREE_WORDS or i == len(spans) - 1:
            which, start, length, period = tree_runs([numbers[x:y] for x, y in some])
            out.append((np.array([x for x, _ in some], np.int64)[which] + start, length, period))
            some, held = [], 0
    start, length, period = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3
    text = np.searchsorted(bounds, start, "right") - 1
    order = np.lexsort((period, start))
    return text[order], (start - bounds[text])[order], length[order], period[order]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period, by start, then period), collapsed of every row.

    A run is a stretch of words whose smallest period is `period`, of LEAST_WORDS words and two periods at least, which no
    neighbouring word extends. `collapsed` has all words, joined by one space, but those that stand in a run after its first
    period. Null, empty and wordless texts have no runs and collapse to nothing; doc_id may be null; repeated rows come
    out once each; further columns of `docs` play no part. A text is read whole, whatever its length, in one task; no text
    meets another, so a hot key is nothing to this operator."""

    def work(chunk: pa.RecordBatch) -> dict[str, object]:
        data, offsets = flat(chunk.column("text"))
        starts, ends, bounds = word_bounds(data, offsets)
        text, start, length, period = find_runs(word_numbers(data, starts, ends), bounds)
        lists = np.searchsorted(text, np.arange(len(bounds))).astype(np.int32)
        listed = pa.ListArray.from_arrays(lists, pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], names=["start", "length", "period"]))
        gone = np.zeros(len(starts) + 1, np.int64)
        np.add.at(gone, bounds[text] + start + period, 1)
        np.add.at(gone, bounds[text] + start + length, -1)
        kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
        owner = np.searchsorted(bounds, kept, "right") - 1
        space = np.r_[owner[1:] == owner[:-1], False][: len(owner)].astype(np.int64)
        sizes = (ends - starts)[kept] + space
        joined = spread(np.r_[data, np.uint8(32)], starts[kept], sizes)
        at = np.cumsum(sizes)
        joined[at[space > 0] - 1] = 32
        edges = np.r_[0, at][np.searchsorted(owner, np.arange(len(bounds)))].astype(np.int32)
        collapsed = pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer(edges), pa.py_buffer(joined)])
        return {"doc_id": chunk.column("doc_id"), "n_words": np.diff(bounds), "runs": listed, "collapsed": collapsed}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return over_chunks(docs, ["doc_id", "text"], work, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id, text, where the end of every tenth text (by the crc32 of its doc_id) repeats from a word of its own on.

    With h = crc32(doc_id), g = floor(h / 10) and n words, those from word a = g % n on become the p words from there, over
    and over, p = 1 + floor((n - a) / (3 + g % 8)). Rows without a doc_id, or without words, stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    parts = docs.select("doc_id", "text", F.when(h % 10 == 0, F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")).alias("__words"), F.floor(h / 10).alias("__g"))
    parts = parts.withColumn("__n", F.size("__words")).withColumn("__a", F.expr("CASE WHEN __n > 0 THEN CAST(__g % __n AS INT) END"))
    parts = parts.withColumn("__p", F.expr("CAST(1 + floor((__n - __a) / (3 + __g % 8)) AS INT)"))
    tail = F.expr("slice(flatten(array_repeat(slice(__words, __a + 1, __p), CAST((__n - __a - 1) DIV __p + 1 AS INT))), 1, __n - __a)")
    made = F.array_join(F.concat(F.expr("slice(__words, 1, __a)"), tail), " ")
    return parts.select("doc_id", F.when(F.col("__a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """Of each row the number of runs of its text `with_periods`, the longest run (ties: smallest start, then period; nulls
    without a run) and digests of all runs and of the collapsed text."""
    found = periodic_runs(with_periods(docs))
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    listed = F.expr(r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("__best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("__best.start")).alias("start"),
        F.col("__best.length").alias("length"),
        (-F.col("__best.period")).alias("period"),
        F.expr("1000 * __best.length DIV -__best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
