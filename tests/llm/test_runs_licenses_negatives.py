"""Periodic runs, license scans and hard negatives against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from llm import hard_negatives, licenses, periodic_runs, suffix_tree
from tests.llm.plain import WORD

DOCS = "doc_id long, text string, runs string, key int, words int, n int"  # with names that the operators use themselves


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 0, 1, 2) for i, t in rows], DOCS)


def plain_runs(w, least=12):
    """Stretches that agree with themselves moved by p, for every p; of equal stretches the smallest p."""
    found = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            a = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i > a and i - a + p >= max(least, 2 * p):
                found.setdefault((a, i - a + p), p)
            i += i == a
    return sorted((a, n, p) for (a, n), p in found.items())


def collapsed(w, runs):
    gone = {i for a, n, p in runs for i in range(a + p, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def run_rows(rng, n):
    rows = []
    for i in range(n):
        k = rng.choice([1, 2, 3, 5, 20])
        w = [f"é{rng.randrange(k)}" for _ in range(rng.randint(0, 60))]
        b = [f"é{rng.randrange(k)}" for _ in range(rng.randint(1, 15))]
        w += rng.choice([[], (b * 10)[: rng.randint(1, 60)] + w[:10]])
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(w)))
    return rows


def test_extensions():
    rng = random.Random(3)
    for k in (1, 2, 4):
        s = [rng.randrange(k) + 1 for _ in range(80)] + [0]
        found = suffix_tree.Extensions(s, k + 1)
        assert sorted(range(len(s)), key=lambda i: s[i:]) == np.argsort(found.rank).tolist()
        pairs = [(i, j) for i in range(len(s)) for j in range(i)]
        for (i, j), n in zip(pairs, found.common(*map(np.array, zip(*pairs, strict=True))).tolist(), strict=True):
            assert s[i : i + n] == s[j : j + n] and s[i + n : i + n + 1] != s[j + n : j + n + 1]


@pytest.mark.parametrize("tree", [1 << 16, 20])
def test_runs(spark, monkeypatch, tree):
    monkeypatch.setattr(periodic_runs, "TREE_WORDS", tree)
    rng = random.Random(11)
    rows = run_rows(rng, 300) + [(1000, None), (1001, ""), (1002, " \n"), (None, "a b " * 9), (None, "a b " * 9), (5, "z"), (5, "z " * 12), (1003, "ab " * 30_000), (1004, "x\x1cy " * 11)]
    found = periodic_runs.periodic_runs(frame(spark, rows)).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found)
    wanted = []
    for i, t in rows:
        w = WORD.findall(t or "")
        runs = plain_runs(w) if len(w) < 1000 else [(0, len(w), 1)]
        wanted.append((str(i), len(w), runs, collapsed(w, runs)))
    assert got == sorted(wanted)
    assert periodic_runs.periodic_runs(frame(spark, [])).count() == 0


def test_run_digests(spark):
    rows = run_rows(random.Random(12), 300) + [(1000, None), (1001, ""), (None, "a b " * 9), (1002, "a")]
    found = {r["doc_id"]: r for r in periodic_runs.run_digests(frame(spark, rows)).collect()}
    planted = 0
    for i, t in rows:
        w = WORD.findall(t or "")
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and w:
            planted += 1
            n, g = len(w), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[x if x < a else a + (x - a) % p] for x in range(n)]
        runs = plain_runs(w)
        r = found[i]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{a},{n},{p}\n" for a, n, p in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert planted > 20


def license_words(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c in "0123456789abcdefghijklmnopqrstuvwxyz" or c > "\x7f" else " " for c in folded).split(" ")


def plain_licenses(text, templates):
    w = [x for x in license_words(text) if x]
    places = sorted((i, label) for phrase, label in licenses.PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split())
    found, best = set(), 0.0
    for t in templates:
        for at in range(0, len(w), t.width):
            held = set(w[at : at + 2 * t.width]) & set(t.tokens)
            if 100 * len(held) >= licenses.PERCENT * len(t.tokens):
                found.add(t.label)
                best = max(best, len(held) / len(t.tokens))
    base = {label for _, label in places}
    first, last = (places[0][0], places[-1][0]) if places else (None, None)
    return len(w), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(base | found)), 1.0 if places else best


def test_licenses(spark):
    rng = random.Random(5)
    templates = [*licenses.TEMPLATES, licenses.Template("own", "alpha beta gamma delta the of license", 8)]
    pieces = [*(t.words for t in templates), "MIT License", "Apache\nLICENSE", "general-public license", "mit", "license", "the of and", "É K ſ", "alpha beta gamma delta"]
    texts = []
    for _ in range(400):
        w = " ".join(rng.choice(pieces) if rng.random() < 0.5 else rng.choice(["red", "the", "of", "a1"]) for _ in range(rng.randint(0, 12))).split()
        texts.append(rng.choice([" ", "\n", ". "]).join(x for x in w if rng.random() < rng.choice([1, 0.95, 0.8])))
    rows = [*enumerate(texts), (1000, None), (1001, ""), (1002, "!!"), (None, "the MIT license"), (None, None), (7, "Licensed under CC BY-NC 4.0."), (7, "Licensed under CC BY-NC 4.0."), (1003, "word " * 40_000 + "Apache License")]
    found = licenses.license_scan(frame(spark, rows), templates=templates)
    assert found.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = sorted(tuple(map(str, r)) for r in found.collect())
    assert got == sorted(tuple(map(str, (i, *plain_licenses(t, templates)))) for i, t in rows)
    assert licenses.license_scan(frame(spark, [])).count() == 0
    lines = licenses.license_lines(frame(spark, [(1, "x " * 20 + "Licensed under CC BY-NC 4.0."), (None, None)])).collect()
    assert {(r["doc_id"], r["label"]) for r in lines} == {(1, "cc-by-nc")} and {r["at"] for r in lines} == {0, 16}


def test_license_scan_is_native(spark):
    plan = licenses.license_scan(frame(spark, [(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_products_are_exact():
    rng = np.random.default_rng(4)
    for size, most in ((64, 150), (3, 1 << 28), (300, 40_000), (1, 2), (64, 1 << 27)):
        a, b = (rng.integers(-most, most + 1, (n, size)) for n in (7, 9))
        a[0], b[0] = most, -most
        wanted = a.astype(object) @ b.astype(object).T
        assert (hard_negatives.products(a, b, hard_negatives.moduli(size * most * most)) == wanted).all()
    assert hard_negatives.HALF**2 * hard_negatives.SLICE < 1 << 24


def plain_negatives(rows):
    rows = [(v, (y + 1) % 10 if v % 7 == 0 else y, [int(np.floor(256 * float(x))) for x in e]) for v, y, e in rows if v is not None and y is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for k, (a, own, vec) in enumerate(rows):
        if a % 100:
            continue
        scores = [(-sum(x * y for x, y in zip(vec, w, strict=True)), v, y) for j, (v, y, w) in enumerate(rows) if j != k and len(w) == len(vec)]
        for s, p, y in sorted(x for x in scores if x[2] == own)[:5]:
            window = sorted(x for x in scores if x[2] != own and 30 * -s <= 100 * -x[0] <= 90 * -s)
            out += [(a, p, rank, n, -s, -m) for rank, (m, n, _) in enumerate(window[:10], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [1 << 18, 40])
def test_hard_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", block)
    rng = np.random.default_rng(6)
    nan, inf = float("nan"), float("inf")
    rows = [(i, int(rng.integers(0, 3)), rng.normal(size=4).astype(np.float32).tolist()) for i in range(260)]
    rows += [(300, 1, [1.0, 0.5, 0.25, 0.0])] * 3 + [(300 + i, i % 2, [1.0, 0.5, 0.25, 0.0]) for i in range(5)]  # ties, repeated rows
    rows += [(400, None, [1.0] * 4), (None, 1, [1.0] * 4), (401, 1, None), (402, 1, [None, 1.0, 1.0, 1.0]), (403, 1, [nan] * 4), (404, 1, [inf] * 4), (500, 1, []), (501, 1, []), (600, 2, [1.0]), (601, 2, [2.0]), (602, 1, [1.5]), (700, 9, [0.0] * 4), (800, 1, [-3.0] * 4)]
    vectors = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<float>, size int, row string")
    assert sorted(map(tuple, hard_negatives.mine_embeddings(vectors).collect())) == plain_negatives(rows)
    assert hard_negatives.mine_embeddings(vectors.limit(0)).count() == 0
    assert hard_negatives.mine_embeddings(vectors.where("vec_id = 600")).count() == 0


def test_components_no_long_can_hold(spark):
    vectors = spark.createDataFrame([(100, 1, [1.0, 2.0]), (1, 1, [1.0, 1.0]), (2, 2, [1.0, 0.5]), (3, 1, [1e300, 1.0]), (4, 2, [1e30, 1.0])], "vec_id long, label int, embedding array<double>")
    assert [tuple(r) for r in hard_negatives.mine_embeddings(vectors).collect()] == [(100, 1, 1, 2, 3 * 65536, 2 * 65536)]
