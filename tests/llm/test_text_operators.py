"""Operators that look at one text at a time: secrets, quality rules, BPE, language, toxicity."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from llm import bpe, langid, repeats, secrets, toxicity
from llm.automaton import Scanner
from tests.llm import plain

DOCS = "doc_id long, text string, kept string, key int"  # with names that the operators use themselves


def frame(spark, texts):
    return spark.createDataFrame([(i, t, None, 0) for i, t in enumerate(texts)], DOCS)


def mixed(pieces, n, seed, longest=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, longest))) for _ in range(n)]


PIECES = ["password", "PASSwd", "secret", "token", "api_key", "apikey", "AKIA", "ABCDEFGH12345678", "deadbeef0123456789abcdef", ":", "=", " ", '"', "'", "é", "x", "\n", "-", "A", "0", "ſ", "K"]
EDGES = [None, "", " ", "a" * 3000 + "AKIA" + "A1" * 4000, "0123456789abcdef" * 2]


def test_secret_spans(spark):
    texts = mixed(PIECES, 3000, 1) + EDGES + EDGES
    found = {r["doc_id"]: r for r in secrets.secret_digests(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        base = plain.secrets(t)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert found[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), t
        assert [found[i][f"n_{k}"] for k in plain.SECRETS] == [sum(x[0] == k for x in base) for k in plain.SECRETS]
        assert [x for x in found[i]["spans"].split(",") if x.split(":")[0] in plain.SECRETS] == [x for x in listed.split(",") if x]


def test_more_secret_rules():
    text = "see gh" + "p_" + "a1B2" * 9 + " and xox" + "b-" + "12345-" * 4 + " or eyJ" + "x.Y_" * 20
    kinds = [secrets.RULES[i].name for _, i, _ in secrets._spans(pa.array([text]), secrets.scanner(secrets.RULES))[0]]
    assert kinds == ["host_token", "chat_token", "web_token"]


def test_automaton_is_minimal():
    step, inside = Scanner(list(secrets.BASE)).step, Scanner(list(secrets.BASE)).inside
    block = inside.astype(int)
    for _ in range(len(step)):
        block = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)[1].ravel()
    assert len(set(block.tolist())) == len(step)


def test_redaction_keeps_the_rest(spark):
    docs = frame(spark, ["nothing here", None, "", 'password = "hunter22!" é', "AKIA" + "Z" * 20])
    rows = {r["doc_id"]: r["text"] for r in secrets.redact_secrets(docs).collect()}
    assert rows == {0: "nothing here", 1: None, 2: "", 3: '<assign>!" é', 4: "<access>"}
    assert secrets.redact_secrets(docs).schema == docs.schema
    assert secrets.redact_secrets(docs.limit(0)).count() == 0


def test_quality_counts(spark):
    texts = mixed(["a", "b", "c", "dé", "#x", "\n", "\n", "  ", "\x1c", " z", "\t", " "], 300, 3, 120) + [None, "", "   ", "a " * 300, "x", "x"]
    found = {r["doc_id"]: r for r in repeats.quality_counts(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        n, chars, symbols, lines, three, ten, longest = plain.quality(t)
        r = found[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, three), t
        assert r["base_failed"] == (n < 50 or 100 * three > 50 * n)
        assert round(r["repeat_share"] * max(n, 1)) == ten
        assert r["longest_repeat"] == (longest if longest >= repeats.LEAST_REPEAT else 0)
        assert r["kept"] == (not r["base_failed"] and ten <= 0.3 * n and r["longest_repeat"] <= repeats.MOST_LONGEST)
    assert repeats.quality_counts(frame(spark, [])).count() == 0


def test_bpe_is_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    pieces = ["hello", " ", "  ", "\n", "é", "世界", "🙂", "123", "'s", "'ll", "aaaa", "<|endoftext|>", "!!", "\t", "ab", "the", " of", "\x1c", "٣", "é"]
    texts = mixed(pieces, 400, 5) + [None, "", "a" * 5000, "".join(random.Random(1).choice("abcdefghij") for _ in range(20_000)), "same", "same"]
    found = {r["doc_id"]: r for r in bpe.round_trip_digests(frame(spark, texts), path).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = bpe.decode(bpe.encode(frame(spark, texts), path), path)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert bpe.round_trip_digests(frame(spark, []), path).count() == 0


def test_bpe_forgets_words(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 3)
    table = bpe.Merges(path)
    library = Tokenizer.from_file(path)
    for t in ("one two three four five", "five six one", "seven"):
        assert table.encode_texts([t])[0].tolist() == library.encode(t, add_special_tokens=False).ids


def best_value(scores, switch):
    d = scores[0].copy()
    for s in scores[1:]:
        d = np.maximum(d, d.max() - switch) + s
    return d.max()


def test_viterbi(monkeypatch):
    monkeypatch.setattr(langid, "BLOCK", 7)
    rng = np.random.default_rng(0)
    sizes = np.array([0, 1, 5, 7, 8, 30, 100, 0, 14])
    scores = (rng.normal(size=(sizes.sum(), 4)) * 3).astype(np.float32)
    labels, at = langid.best_path(scores, sizes, 4.0), 0
    for n in sizes:
        own, path = scores[at : at + n], labels[at : at + n]
        if n:
            value = own[np.arange(n), path].sum() - 4.0 * (np.diff(path) != 0).sum()
            assert value == pytest.approx(best_value(own, 4.0), abs=1e-3)
        at += n


@pytest.mark.parametrize("size", [33, 40, 130])
def test_viterbi_of_many_labels(size):
    scores = (np.random.default_rng(size).normal(size=(200, size)) * 3).astype(np.float32)
    scores[:, 32:] += 2
    path = langid.best_path(scores, np.array([200]), 4.0)
    value = scores[np.arange(200), path].sum() - 4.0 * (np.diff(path) != 0).sum()
    assert value == pytest.approx(best_value(scores, 4.0), abs=1e-2)


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.predict_held_out(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = found[found.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert found.score.between(0, 1).all()
    assert (found.held_out == found.doc_id.map(lambda x: zlib.crc32(str(x).encode()) % 4 == 2)).all()
    rows = [(1, "the house is red", "en"), (3, "la casa es roja", "es"), (0, "дом красный", "ru"), (4, "красный дом", None), (5, None, "en"), (6, "12 34 !", "en"), (7, "", None), (1, "the house is red", "en")]
    few = langid.predict_held_out(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in few.collect()}
    assert few.count() == 8 and got[4] == ("ru", 1.0) and got[5] == got[6] == got[7] == ("und", 0.0)
    assert langid.predict_held_out(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in langid.predict_held_out(spark.createDataFrame([(4, "no labels", None)], "doc_id long, text string, lang string")).collect()} == {"und"}


def test_language_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    by_lang = {r["lang"]: r["text"] for r in docs.where("length(text) > 1500").collect()}
    mixed_text = " ".join(by_lang[x][:1200].rsplit(" ", 1)[0] for x in ("en", "de", "es"))
    words, labels = langid.label_words(pa.array([mixed_text]), model)
    order = [model.languages[labels[0]], *(model.languages[b] for a, b in zip(labels, labels[1:], strict=False) if a != b)]
    assert order == ["en", "de", "es"]


def test_toxicity(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = toxicity.score_held_out(docs, labels).join(labels, "doc_id").toPandas()
    held = found[found.held_out]
    assert held[held.toxic == 1].predicted.mean() > 0.8
    assert held[held.toxic == 0].predicted.mean() < 0.02
    assert found.score.between(0, 1).all()


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (1, 1)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(1, "vile words here", 0.5), (1, "vile words here", 0.5), (2, "fine", None), (3, None, None), (4, "", 1.0)], "doc_id long, text string, score double")
    assert toxicity.score_held_out(docs, labels).count() == 5
    assert toxicity.score_held_out(docs, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.score_held_out(docs.limit(0), labels).count() == 0
    assert toxicity.without_toxic(docs, labels).columns == docs.columns


def test_risk_stays_above_zero():
    rng = np.random.default_rng(3)
    toxic = [np.unique(np.r_[rng.integers(100, 3000, 40), rng.integers(0, 10, 2)]) for _ in range(200)]
    clean = [np.unique(rng.integers(100, 3000, 40)) for _ in range(900)]
    model = toxicity.fit(toxic[:100], clean + toxic[100:], 0.1)
    z = [model.bias + model.weight[x].sum() for x in toxic + clean]
    assert np.mean(np.array(z[:200]) > 0) > 0.95 and np.mean(np.array(z[200:]) > 0) < 0.02
