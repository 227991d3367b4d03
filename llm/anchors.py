"""Anchors: which windows of a text can stand elsewhere as well, from hashes of short grams, without comparing windows.

A window's anchor is its gram of smallest hash, the leftmost of equal ones. Equal windows have equal anchors in the same
place, so only windows whose anchor's hash occurs twice need to be compared, and only with those of the same hash."""

from __future__ import annotations

import numpy as np

from llm.hashing import Sums, mixed, stretches


def sliding_minimum(a: np.ndarray, width: int) -> np.ndarray:
    """min(a[i : i + width]) for each i where that is whole."""
    n = len(a)
    if n < width:
        return a[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(a.dtype).max, a.dtype)
    padded[:n] = a
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(ahead[: n - width + 1], behind[width - 1 : n])


def owned_runs(sums: Sums, offsets: np.ndarray, window: int, gram: int) -> dict[str, np.ndarray]:
    """Runs of windows, one unit apart, that share an anchor: text, lo (first window's start in the text), size (from lo to the
    last window's end), hash (the anchor's) and segment (a hash of all units from lo on and of the anchor's place in them).

    sums: of `hashing.prefix` over the units (bytes or words) of all texts; offsets: of the texts in them."""
    n = len(sums) - 1
    empty = np.zeros(0, np.int64)
    if n < window:
        return dict.fromkeys(("text", "lo", "size"), empty) | dict.fromkeys(("hash", "segment"), empty)
    starts = np.arange(n - gram + 1)
    grams = stretches(sums, starts, starts + gram)
    keyed = (grams & np.uint64(0xFFFFFFFF00000000)) | starts.astype(np.uint64)
    anchor = (sliding_minimum(keyed, window - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    sizes = np.diff(offsets)
    whole = np.zeros(n + 1, np.int64)  # 1 from a text's start, to where its last window starts
    long = sizes >= window
    np.add.at(whole, offsets[:-1][long], 1)
    np.add.at(whole, offsets[1:][long] - window + 1, -1)
    at = np.flatnonzero(np.cumsum(whole)[: len(anchor)] > 0)
    if not len(at):
        return dict.fromkeys(("text", "lo", "size"), empty) | dict.fromkeys(("hash", "segment"), empty)
    text = np.searchsorted(offsets, at, "right") - 1
    fresh = np.r_[True, (np.diff(anchor[at]) != 0) | (np.diff(text) != 0)]
    first = np.flatnonzero(fresh)
    last = np.r_[first[1:], len(at)] - 1
    lo, hi, own = at[first], at[last] + window, anchor[at[first]]
    segment = mixed(stretches(sums, lo, hi) + (own - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return {"text": text[first], "lo": lo - offsets[text[first]], "size": hi - lo, "hash": grams[own].view(np.int64), "segment": segment.view(np.int64)}


def cover(n: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which of n units lie in some [start, start + length)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:n]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.r_[0, mask.view(np.int8) if mask.dtype == bool else mask, 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
