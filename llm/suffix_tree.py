"""Suffix trees by Ukkonen's algorithm, and longest common extensions in constant time from a tour of the tree."""

from __future__ import annotations

import numpy as np


def ukkonen(s: list[int], sigma: int) -> tuple[dict[int, int], list[int], list[int]]:
    """The suffix tree of s, whose last value occurs nowhere else: edges (node * sigma + first value -> child), and where each
    node's edge starts and ends in s. Node 0 is the root; leaves come in the order of their suffixes."""
    n = len(s)
    edge: dict[int, int] = {}
    first, last, link = [0], [0], [0]
    node = at = length = rest = 0
    for i, c in enumerate(s):
        rest += 1
        hook = 0  # the node made last in this phase, whose suffix link is still open
        while rest:
            if not length:
                at = i
            key = node * sigma + s[at]
            child = edge.get(key)
            if child is None:
                edge[key] = len(first)
                first.append(i)
                last.append(n)
                link.append(0)
                if hook:
                    link[hook] = node
                    hook = 0
            else:
                begin = first[child]
                span = last[child] - begin
                if length >= span:
                    at += span
                    length -= span
                    node = child
                    continue
                if s[begin + length] == c:
                    length += 1
                    if hook:
                        link[hook] = node
                    break
                middle = len(first)
                edge[key] = middle
                edge[middle * sigma + c] = middle + 1
                edge[middle * sigma + s[begin + length]] = child
                first += (begin, i)
                last += (begin + length, n)
                link += (0, 0)
                first[child] = begin + length
                if hook:
                    link[hook] = middle
                hook = middle
            rest -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                at = i - rest + 1
    return edge, first, last


def tour(s: list[int], sigma: int) -> tuple[np.ndarray, np.ndarray]:
    """The tree's leaves as an Euler tour meets them (by the suffix each stands for; children by value), and before each the
    depth, in values, of the node at which the tour turns: the lowest common ancestor of that leaf and the one before."""
    edge, first, last = ukkonen(s, sigma)
    nodes, n = len(first), len(s)
    keys = np.fromiter(edge.keys(), np.int64, len(edge))
    order = np.argsort(keys)
    children = np.fromiter(edge.values(), np.int64, len(edge))[order].tolist()
    cut = np.searchsorted(keys[order] // sigma, np.arange(nodes + 1)).tolist()
    del edge, keys, order
    depth, back = [0] * nodes, [-1] * nodes  # back: the parent's depth for all children but the first
    leaves, turns, turn, stack = [], [], 0, [0]
    while stack:
        v = stack.pop()
        if back[v] >= 0:
            turn = back[v]
        a, b = cut[v], cut[v + 1]
        if a == b:
            leaves.append(n - depth[v])
            turns.append(turn)
            continue
        above = depth[v]
        for child in children[a:b]:
            depth[child] = above + last[child] - first[child]
            back[child] = above
        back[children[a]] = -1
        stack += children[a:b][::-1]
    return np.array(leaves, np.int64), np.array(turns, np.int32)


class Extensions:
    """Ranks of the suffixes of s, and the longest common prefix of any two of them, each in constant time."""

    def __init__(self, s: list[int], sigma: int) -> None:
        leaves, turns = tour(s, sigma)
        self.rank = np.empty(len(s), np.int64)
        self.rank[leaves] = np.arange(len(s))
        self.least, width = [turns], 1
        while 2 * width <= len(turns):  # least turn of 1, 2, 4 ... neighbours
            row = self.least[-1]
            self.least.append(np.minimum(row[:-width], row[width:]))
            width *= 2

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of each pair i <> j the length of the longest common prefix of s[i:] and s[j:]."""
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.log2(np.maximum(high - low + 1, 1)).astype(np.int64)
        out = np.empty(len(low), np.int64)
        for k in np.unique(level).tolist():
            own = level == k
            row = self.least[k]
            out[own] = np.minimum(row[low[own]], row[high[own] - (1 << k) + 1])
        return out


def next_smaller(values: list[int]) -> list[int]:
    """For each place the next one to its right that holds less; the length where there is none."""
    out, open_places = [len(values)] * len(values), []
    for i in range(len(values) - 1, -1, -1):
        v = values[i]
        while open_places and values[open_places[-1]] > v:
            open_places.pop()
        if open_places:
            out[i] = open_places[-1]
        open_places.append(i)
    return out
