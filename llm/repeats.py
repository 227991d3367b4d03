"""Quality rules: base counts of a text, and repetition found in a suffix array of its words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from llm.columns import flat, over_chunks

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
LEAST_WORDS = 50
MOST_REPEAT_PERCENT = 50

#: Repeated substrings of fewer words are part of ordinary prose.
LEAST_REPEAT = 10
#: A text fails if repeated substrings cover more than this share of its words, or if one of them is longer.
MOST_COVERED = 0.3
MOST_LONGEST = 200


def suffix_order(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of numbered words, and the common prefix of each suffix with the one before it.

    `ends[i]` is where the text of position i ends; no comparison goes beyond, and a shorter suffix sorts first. `ids`
    have to differ between texts, so that a text's suffixes stand together. Ranks by 1, 2, 4 ... words, sorting again only what ties."""
    n = len(ids)
    order = np.argsort(ids)
    here, rank = np.arange(n), np.empty(n, np.int64)
    fresh = np.r_[True, np.diff(ids[order]) != 0][:n]
    rank[order] = np.maximum.accumulate(np.where(fresh, here, 0)) + 1
    levels, width = [rank], 1
    while True:
        sorted_rank = rank[order]
        same = np.r_[False, sorted_rank[1:] == sorted_rank[:-1]]
        tied = np.flatnonzero(same | np.r_[same[1:], False])
        if not len(tied):
            break
        where = order[tied]
        ahead = where + width
        inside = ahead < ends[where]
        second = np.where(inside, rank[np.where(inside, ahead, 0)], 0)
        first = sorted_rank[tied]
        resort = np.argsort(first * (n + 1) + second)
        where, first, second = where[resort], first[resort], second[resort]
        order[tied] = where
        # a tied suffix gets the place of the first one equal to it; places of others stay apart from those
        fresh = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        place = np.maximum.accumulate(np.where(fresh, tied, 0))
        finer = np.empty(n, np.int64)
        finer[order] = here + 1
        finer[where] = place + 1
        rank, width = finer, width * 2
        levels.append(rank)
    common = np.zeros(n, np.int64)
    if n > 1:
        left, right = order[:-1].copy(), order[1:].copy()
        length = np.zeros(n - 1, np.int64)
        for k in range(len(levels) - 1, -1, -1):
            step = 1 << k
            inside = (left + step <= ends[order[:-1]]) & (right + step <= ends[order[1:]])
            at = np.flatnonzero(inside)
            at = at[levels[k][left[at]] == levels[k][right[at]]]
            length[at] += step
            left[at] += step
            right[at] += step
        common[1:] = length
    return order, common


def longest_repeats(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position the longest substring from there that also starts elsewhere in its text."""
    order, common = suffix_order(ids, ends)
    longest = np.empty(len(ids), np.int64)
    longest[order] = np.maximum(common, np.r_[common[1:], 0])
    return longest


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in some [start, start + length)."""
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(values)][bounds])


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = flat(texts)
    is_space, is_symbol = np.zeros(256, bool), np.zeros(256, bool)
    is_space[list(SPACES)] = True
    is_symbol[list(SYMBOLS)] = True
    chars = per_text(((data & 0xC0) != 0x80) & ~is_space[data], offsets)
    symbols = per_text(is_symbol[data], offsets)

    raw, known = data.tobytes(), {}
    numbers: list[int] = []
    counts, same_lines = [], []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        text = raw[a:b]
        words = text.split()  # bytes split at exactly the six ASCII spaces
        numbers += [known.setdefault(w, len(known)) for w in words]
        counts.append(len(words))
        lines = [x for x in text.split(b"\n") if x and not x.isspace()]
        same_lines.append(len(lines) - len(set(lines)))
    n_words = np.array(counts, np.int64)
    bounds = np.cumsum(np.r_[0, n_words])
    n = int(bounds[-1])
    text_of = np.repeat(np.arange(len(counts)), n_words)
    longest = longest_repeats(text_of * (len(known) + 1) + np.array(numbers, np.int64), bounds[1:][text_of])

    triple = np.flatnonzero(longest >= 3)
    repeat_words = per_text(covered(triple, np.full(len(triple), 3), n), bounds)
    # a maximal repeat starts where the repeat from one word before does not already take it in
    before = np.r_[0, longest[:-1]]
    before[bounds[:-1][n_words > 0]] = 0
    start = np.flatnonzero((longest >= LEAST_REPEAT) & (before != longest + 1))
    in_repeats = per_text(covered(start, longest[start], n), bounds)
    most = np.zeros(len(counts), np.int64)
    np.maximum.at(most, text_of[start], longest[start])

    failed = (n_words < LEAST_WORDS) | (100 * repeat_words > MOST_REPEAT_PERCENT * n_words)
    share = in_repeats / np.maximum(n_words, 1)
    kept = ~failed & (share <= MOST_COVERED) & (most <= MOST_LONGEST)
    return {
        "n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": np.array(same_lines, np.int64), "n_repeat_words": repeat_words,
        "base_failed": failed, "kept": kept, "repeat_share": share, "longest_repeat": most,
    }


def quality_counts(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed and kept, then repeat_share (of words in repeats of 10 words and more) and longest_repeat.

    Null and empty texts have no words and fail. Texts of any length are read whole; repeated rows come out once each."""

    def work(chunk: pa.RecordBatch) -> dict[str, object]:
        return {"doc_id": chunk.column("doc_id")} | text_counts(chunk.column("text"))

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    return over_chunks(docs, ["doc_id", "text"], work, f"doc_id {kind}, {counts}, base_failed boolean, kept boolean, repeat_share double, longest_repeat long")
