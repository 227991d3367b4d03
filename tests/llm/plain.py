"""Plain versions of the operators, row by row in Python, to hold the Spark ones against."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SECRETS = {
    "assign": re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}
LEAST = {"assign": 6, "access": 20, "hex": 24}


def secrets(text):
    found = []
    for i, (kind, rule) in enumerate(SECRETS.items()):
        for m in rule.finditer(text or ""):
            if len(m[1] if kind == "assign" else m[0]) >= LEAST[kind]:
                found.append((m.start(), i, m.end(), kind))
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def repeated_bytes(rows, window):
    texts = [(d, (t or "").encode()) for d, t in rows]
    times = collections.Counter(b[i : i + window] for _, b in texts for i in range(len(b) - window + 1))
    out = []
    for d, b in texts:
        gone = [False] * len(b)
        for i in range(len(b) - window + 1):
            if times[b[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        spans = sum(x and not y for x, y in zip(gone, [False, *gone], strict=False))
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def recurring_words(rows, window):
    texts = [(d, WORD.findall(t or "")) for d, t in rows]
    first = {}
    for d, w in texts:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(d, first.get(k, d))
    out = []
    for d, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        kept = [x for x, y in zip(w, gone, strict=True) if not y]
        out.append((d, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out)


def near_duplicates(rows, percent=85):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= percent * len(a | sets[j]):
                x, y = find(rows[i][0]), find(rows[j][0])
                parent[max(x, y)] = min(x, y)
    return sorted((d, len(s), find(d), find(d) == d) for (d, _), s in zip(rows, sets, strict=True))


def quality(text):
    text = text or ""
    w = WORD.findall(text)

    def covered(n):
        times = collections.Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
        hit = [False] * len(w)
        for i in range(len(w) - n + 1):
            if times[tuple(w[i : i + n])] > 1:
                hit[i : i + n] = [True] * n
        return sum(hit)

    lines = [x for x in text.split("\n") if WORD.search(x)]
    longest = next((n - 1 for n in range(1, len(w) + 2) if not covered(n)), 0)
    return len(w), sum(map(len, w)), sum(text.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), covered(3), covered(10), longest
