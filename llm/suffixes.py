"""Suffix arrays by two-stage sorting, and the strings of a given length that occur twice."""

from __future__ import annotations

import numpy as np

_PACK = 7  # symbols of 9 bits in a key


def ascending(symbols: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successors. The last symbol has to be 0."""
    n = len(symbols)
    less = np.zeros(n, bool)
    less[:-1] = symbols[:-1] < symbols[1:]
    differs = np.ones(n, bool)
    differs[:-1] = symbols[:-1] != symbols[1:]
    following = np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1]
    return less[following]


def _keys(symbols: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The next _PACK symbols of each place as a number; 0 from the segment's end on."""
    n = len(symbols)
    wide = np.r_[symbols.astype(np.uint64), np.zeros(_PACK, np.uint64)]
    key = np.zeros(n, np.uint64)
    for j in range(_PACK):
        key = (key << np.uint64(9)) | wide[j : j + n]
    drop = np.maximum(_PACK - rest, 0).astype(np.uint64) * np.uint64(9)
    return (key >> drop) << drop


def sorted_directly(symbols: np.ndarray, rest: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes `at` by their first `depth` symbols, none beyond the segment's end."""
    if not len(at):
        return at
    key = _keys(symbols, rest)
    order = at[np.argsort(key[at], kind="stable")]
    sorted_key = key[order]
    same = np.r_[False, sorted_key[1:] == sorted_key[:-1]]
    tied = np.flatnonzero(same | np.r_[same[1:], False])
    if not len(tied):
        return order
    where = order[tied]
    group = np.cumsum(~same[tied])
    width = depth - _PACK
    padded = np.r_[symbols, np.zeros(depth + _PACK, symbols.dtype)]
    view = np.lib.stride_tricks.sliding_window_view(padded, width)
    out = np.empty_like(where)
    step = 1 << 17  # so many at once, cut between groups: a row takes depth bytes
    cuts = [0]
    bounds = np.flatnonzero(np.r_[True, np.diff(group) != 0, True])
    while cuts[-1] < len(where):
        later = bounds[bounds > cuts[-1]]
        cuts.append(int(later[max(np.searchsorted(later, cuts[-1] + step, "right") - 1, 0)]))
    for a, b in zip(cuts, cuts[1:], strict=False):
        own = where[a:b]
        rows = np.zeros((b - a, width + 4), np.uint8)
        rows[:, :4] = (group[a:b] - group[a] + 1).astype(">u4").view(np.uint8).reshape(-1, 4)
        rows[:, 4:] = view[own + _PACK]
        short = np.flatnonzero(rest[own] < depth)
        if len(short):
            rows[short, 4:] *= np.arange(width)[None, :] < (rest[own[short]] - _PACK)[:, None]
        out[a:b] = own[np.argsort(rows.view(f"S{width + 4}").ravel(), kind="stable")]
    order[tied] = out
    return order


def suffix_array(symbols: np.ndarray, rest: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes by their first `depth` symbols, in two stages.

    The suffixes that are smaller than their successors are sorted directly. A scan through the buckets of first symbols,
    from the smallest on, then puts each other suffix behind those of its bucket when its successor comes by."""
    n = len(symbols)
    up = ascending(symbols)
    sizes = np.bincount(symbols, minlength=257)
    begin = np.r_[0, np.cumsum(sizes)]
    array = np.empty(n, np.int64)
    separators = np.flatnonzero(symbols == 0)
    array[: len(separators)] = separators
    direct = sorted_directly(symbols, rest, np.flatnonzero(up & (symbols > 0)), depth)
    first = symbols[direct]
    in_bucket = np.r_[0, np.cumsum(np.bincount(first, minlength=257))]
    for c in range(1, 257):
        own = direct[in_bucket[c] : in_bucket[c + 1]]
        array[begin[c + 1] - len(own) : begin[c + 1]] = own
    head = begin[:-1].copy()
    down = ~up
    for c in range(256):
        if not sizes[c]:
            continue
        if c:
            fresh = array[begin[c] : head[c]]
            while len(fresh):  # runs of one symbol induce within their own bucket
                before = fresh[fresh > 0] - 1
                fresh = before[(symbols[before] == c) & down[before]]
                array[head[c] : head[c] + len(fresh)] = fresh
                head[c] += len(fresh)
        items = array[begin[c] : begin[c + 1]]
        before = items[items > 0] - 1
        before = before[(symbols[before] > c) & down[before]]
        if not len(before):
            continue
        to = symbols[before]
        order = np.argsort(to, kind="stable")
        before, to = before[order], to[order]
        cut = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(to)], strict=True):
            x = int(to[a])
            array[head[x] : head[x] + b - a] = before[a:b]
            head[x] += b - a
    return array


def common_at_least(data: np.ndarray, left: np.ndarray, right: np.ndarray, length: int) -> np.ndarray:
    """Which pairs of places start `length` equal bytes: compared eight at a time, while they are equal."""
    padded = np.r_[data, np.zeros(8, np.uint8)]
    words = np.lib.stride_tricks.as_strided(padded, (len(data), 8), (1, 1))
    same = np.arange(len(left))
    for at in range(0, length, 8):
        at = min(at, length - 8) if length >= 8 else at
        a = np.ascontiguousarray(words[left[same] + at]).view(np.uint64).ravel()
        b = np.ascontiguousarray(words[right[same] + at]).view(np.uint64).ravel()
        same = same[a == b]
    found = np.zeros(len(left), bool)
    found[same] = True
    return found


def repeated_starts(segments: list[bytes], length: int) -> list[np.ndarray]:
    """For each segment, at which starts a string of `length` bytes stands that also starts elsewhere in the segments. UTF-8 only."""
    sizes = np.array([len(x) for x in segments], np.int64)
    data = np.frombuffer(b"\xff".join([*segments, b""]), np.uint8)
    symbols = data + np.uint8(1)  # the byte 0xFF is in no text; as 0 it ends each segment
    ends = np.cumsum(sizes + 1) - 1
    rest = np.repeat(ends, sizes + 1) - np.arange(len(data))
    array = suffix_array(symbols, rest, length)
    array = array[rest[array] >= length]
    again = np.zeros(len(data), bool)
    if len(array) > 1:
        same = common_at_least(data, array[:-1], array[1:], length)
        again[array[:-1][same]] = True
        again[array[1:][same]] = True
    begins = ends - sizes
    return [np.flatnonzero(again[a : a + n]) for a, n in zip(begins.tolist(), sizes.tolist(), strict=True)]
