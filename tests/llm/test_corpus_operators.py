"""Operators that compare rows: packing, near duplicates, repeated strings and passages, neighbours, and the pipeline."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from llm import exact_dups, langid, near_dups, neighbours, packing, phrases, suffixes, toxicity
from llm.components import connected_components
from tests.llm import plain

DOCS = "doc_id long, text string"
PATH = public_tokenizers.path("word_bpe_49k.json")


def rows_of(frame):
    return sorted(map(tuple, frame.collect()))


def check_packing(found, docs):
    """Every id of every document once, sequences gapless and not too long. The share of padding."""
    library = Tokenizer.from_file(PATH)
    wanted = sorted((d, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in docs)
    rows = found.toPandas().sort_values(["sequence_id", "offset"])
    assert (rows.groupby("sequence_id").length.cumsum() - rows.length == rows.offset).all()
    size = rows.groupby("sequence_id").length.sum()
    assert size.max() <= packing.LENGTH
    lengths = {}
    for d, ids in wanted:
        own = rows[(rows.doc_id == d) & (rows.doc_tokens == len(ids))].sort_values("start")
        for start, length, crc in zip(own.start, own.length, own.ids_crc32, strict=True):
            assert zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()) == crc
        lengths[d] = lengths.get(d, 0) + len(ids)
    assert rows.groupby("doc_id").length.sum().to_dict() == lengths
    return 1 - size.sum() / packing.LENGTH / len(size)


def test_packing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert check_packing(packing.pack_documents(docs, PATH), rows) < 0.005


def test_packing_edges(spark):
    rows = [(1, None), (2, ""), (3, "word " * 2047), (4, "word " * 2048), (5, "word " * 9000), (6, "a"), (6, "a"), (7, "x<|endoftext|>y \x1c z")]
    check_packing(packing.pack_documents(spark.createDataFrame(rows, DOCS), PATH), rows)
    assert packing.pack_documents(spark.createDataFrame([], DOCS), PATH).count() == 0
    ids = packing.pieces(spark.createDataFrame(rows, DOCS), PATH, with_ids=True).collect()
    assert all(len(r["ids"]) == r["length"] for r in ids)


def test_word_ids_are_the_library():
    rng = random.Random(2)
    pieces = ["Hello", " ", "\n", "é", "Ñ", "世界", "🙂", "123", "'s", "'LL", "aaaa", "<|endoftext|>", "<|startoftext|>", "!!", "\t", "ab", "\x1c", "٣", "é", "İ", "Σ", " ", "\x85", "᠎"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    words = packing.WordIds(PATH)
    ids, count = words.encode(pa.array([*texts, None]))
    texts.append("")
    wanted = [x.ids for x in words.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == [i for x in wanted for i in x] and count.tolist() == [len(x) for x in wanted]


def test_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_BYTES", 1000)
    words = packing.WordIds(PATH)
    for i in range(30):
        texts = [f"common words and w{i}x{j} again" for j in range(3)] + ["common"] * (i % 2)
        ids, count = words.encode(pa.array(texts))
        wanted = [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == [i for x in wanted for i in x] and count.tolist() == [len(x) for x in wanted]
        assert len(words.index) < 40


@pytest.mark.parametrize("n, most", [(0, 0), (1, 1), (2000, 0.02)])
def test_plan_serves_each_piece_once(n, most):
    lengths = np.random.default_rng(1).integers(1, 65, n)
    demand = np.bincount(lengths, minlength=65)
    made = packing.plan(demand, 64)
    room = np.zeros(made.sequences, np.int64)
    for c in np.flatnonzero(demand):
        own = np.flatnonzero(made.classes == c)
        ends = [*made.first[own][1:], demand[c]]
        for e, end in zip(own, ends, strict=True):
            nth = np.arange(end - made.first[e])
            np.add.at(room, made.sequence[e] + nth // made.each[e], c)
    assert room.sum() == lengths.sum() and (room <= 64).all()
    if n > 1:
        assert 1 - lengths.sum() / 64 / made.sequences < most


def passages(seed, n, alphabet, joiner, copies):
    rng = random.Random(seed)
    base = [[rng.choice(alphabet) for _ in range(150)] for _ in range(3)]
    rows = []
    for i in range(n):
        b, a = rng.choice(base), rng.randint(0, 100)
        t = [rng.choice(alphabet) for _ in range(rng.randint(0, 40))] + b[a : a + rng.randint(0, 70)] + rng.choice([[], [alphabet[0]] * rng.randint(1, 60)])
        t = joiner.join(t)
        rows.append((i if not copies else rng.randint(0, n), rng.choice([t, t, t, None, "", t + joiner + t, joiner.join(b)])))
    return rows + rows[:4]


@pytest.mark.parametrize("most", [20_000, 2])
def test_repeated_bytes(spark, most):
    rows = passages(1, 100, ["a", "b", "c", "dé", " "], "", False)
    found = exact_dups.removal_digests(spark.createDataFrame(rows, DOCS), window=40, gram=8, most_segments=most)
    assert rows_of(found) == plain.repeated_bytes(rows, 40)


@pytest.mark.parametrize("most", [10_000, 2])
def test_recurring_words(spark, most):
    rows = passages(2, 120, ["a", "b", "cé", "dd"], " ", True)
    found = phrases.removal_digests(spark.createDataFrame(rows, DOCS), window=12, gram=3, most_segments=most)
    assert rows_of(found) == plain.recurring_words(rows, 12)


def test_rows_without_ids(spark):
    text = " ".join(f"w{i}" for i in range(70))
    docs = spark.createDataFrame([(None, text), (2, text), (None, text), (1, text)], DOCS)
    near = sorted(map(str, near_dups.grouped(docs).select("doc_id", "component_id", "kept").collect()))
    assert near == sorted(map(str, [near_row(spark, *x) for x in [(None, None, True), (None, None, True), (1, 1, True), (2, 1, False)]]))
    gone = sorted((r["doc_id"] or 0, r["n_removed"]) for r in phrases.removal_digests(docs).collect())
    assert gone == [(0, 0), (0, 0), (1, 0), (2, 70)]
    assert {r["n_removed"] for r in exact_dups.removal_digests(docs).collect()} == {len(text)}


def near_row(spark, doc_id, component_id, kept):
    return spark.createDataFrame([(doc_id, component_id, kept)], "doc_id long, component_id long, kept boolean").first()


def test_automata_in_shards(monkeypatch):
    monkeypatch.setattr(phrases, "MOST_PHRASES", 2)
    segments = ["abcdefgh", "xabcdefy", "zzcdefgh", "q"]
    hits = {(int(i), int(a)) for some in phrases.located(segments, 4) for i, a in zip(some[0], some[1], strict=True)}
    wanted = {(i, a) for i, s in enumerate(segments) for a in range(len(s) - 3) if sum(t.count(s[a : a + 4]) for t in segments) > 1}
    assert hits == wanted


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    for found in (exact_dups.removal_digests(none), phrases.removal_digests(none), near_dups.grouped(none), phrases.without_recurring(none)):
        assert found.count() == 0


def test_text_without_passages(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"own  start\n{passage} end", 7), (2, f"other\t{passage}\n tail", 8), (3, None, 9), (4, passage, 1)], "doc_id long, text string, marks int").withColumnRenamed("marks", "n")
    rows = {r["doc_id"]: (r["text"], r["n"]) for r in phrases.without_recurring(docs).collect()}
    assert rows == {1: (f"own  start\n{passage} end", 7), 2: ("other\ttail", 8), 3: (None, 9), 4: ("", 1)}


def test_suffix_arrays():
    rng = random.Random(5)
    for alphabet in ("ab", "abcdefgh", "a", "aé\0b"):
        for _ in range(20):
            base = "".join(rng.choice(alphabet) for _ in range(90))
            segments = [(base[rng.randint(0, 40) :][: rng.randint(0, 60)] + rng.choice(alphabet)).encode() for _ in range(6)]
            whole = np.frombuffer(b"\xff".join([*segments, b""]), np.uint8) + np.uint8(1)
            ends = np.cumsum([len(x) + 1 for x in segments]) - 1
            rest = np.repeat(ends, [len(x) + 1 for x in segments]) - np.arange(len(whole))
            array = suffixes.suffix_array(whole, rest, 100)
            assert sorted(array.tolist()) == list(range(len(whole)))
            tails = [bytes(whole[i : i + rest[i]]) for i in array]
            assert tails == sorted(tails)
            times = {}
            for s in segments:
                for i in range(len(s) - 15):
                    times[s[i : i + 16]] = times.get(s[i : i + 16], 0) + 1
            wanted = [[i for i in range(len(s) - 15) if times[s[i : i + 16]] > 1] for s in segments]
            assert [x.tolist() for x in suffixes.repeated_starts(segments, 16)] == wanted


def near_rows():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(50)]
    bases = [[rng.choice(words) for _ in range(rng.choice([60, 80, 100]))] for _ in range(5)]
    rows = []
    for i in range(250):
        w = list(rng.choice(bases))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i, rng.choice([" ", "\n"]).join(w)))
    return rows + [(400, None), (401, ""), (402, "  "), (403, "a B"), (404, "A b"), (405, "a"), (3, rows[9][1])] + rows[:4]


@pytest.mark.parametrize("block", [2000, 30])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(near_dups, "BLOCK_TEXTS", block)
    rows = near_rows()
    docs = spark.createDataFrame(rows, DOCS)
    wanted = plain.near_duplicates(rows)
    assert rows_of(near_dups.grouped(docs)) == wanted
    clashing = docs.selectExpr("doc_id", "text", "'x' AS kept", "1 AS node", "2 AS component")
    left = near_dups.one_of_each(clashing)
    assert left.columns == clashing.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [d for d, _, _, kept in wanted if kept]


def test_pipeline_links_from_80_percent(spark):
    # of n shingles the last k differ: similarity (n - k) / (n + k)
    pairs = {(96, 8): 0.846, (96, 9): 0.828, (96, 10): 0.811, (90, 10): 0.8, (96, 11): 0.794, (900, 100): 0.8, (900, 101): 0.798, (900, 74): 0.848, (900, 72): 0.851}
    rows = []
    for i, (n, k) in enumerate(pairs):
        w = [f"d{i}w{j}" for j in range(n + 4)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join([*w[:-k], *(f"e{i}w{j}" for j in range(k))]))]
    docs = spark.createDataFrame(rows, DOCS)
    evens = set(range(0, 2 * len(pairs), 2))
    kept = lambda least: sorted(evens | {2 * i + 1 for i, x in enumerate(pairs.values()) if x < least})
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()) == kept(0.8)
    assert sorted(r["doc_id"] for r in near_dups.grouped(docs).where("kept").collect()) == kept(0.85)
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    left = corpus_pipeline.drop_near_duplicates(spark, table, "")
    assert sorted(r["doc_id"] for r in left.collect()) == [d for d, _, _, kept in plain.near_duplicates([*map(tuple, table.collect())], 80) if kept]
    assert near_dups.collections(85) == 12 and near_dups.missed(80, near_dups.collections(80)) < 1e-5


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(200, 230)] + [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(50)] + [(5, 5), (0, 100), (100, 0)]
    label = {x: x for link in links for x in link if link[0] != link[1]}
    for _ in range(60):
        for a, b in links:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect())) == label
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_neighbours(ids, x, k=5):
    asked = np.flatnonzero(ids % 50 == 0)
    return set(zip(*(a.tolist() for a in neighbours.best_pairs(ids[asked], x[asked], ids, x, k)[:2]), strict=True))


def test_neighbours(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = neighbours.search(vectors, "vec_id % 50 = 0").toPandas()
    table = vectors.toPandas()
    wanted = brute_neighbours(table.vec_id.to_numpy(), np.stack(table.embedding).astype(float))
    assert len(set(zip(found.query_id, found.vec_id, strict=True)) & wanted) >= 0.9 * len(wanted)
    assert (found.groupby("query_id")["rank"].max() == 5).all()
    by_id = dict(zip(table.vec_id, table.embedding, strict=True))
    for q, v, score in zip(found.query_id[:50], found.vec_id[:50], found.score[:50], strict=True):
        a, b = np.array(by_id[q], float), np.array(by_id[v], float)
        assert score == pytest.approx(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b), abs=1e-12)


def test_neighbours_edges(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, None), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0]), (9, [3.0, 0.0]), (50, [0.0, 0.0]), (100, [-1.0, 0.0]), (100, [-1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = [(r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.search(vectors, "vec_id % 50 = 0").orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 1), (0, 2, 9), (0, 3, 2), (0, 4, 100), (100, 1, 2), (100, 2, 0), (100, 3, 1), (100, 4, 9)]
    assert neighbours.search(vectors.limit(0), "vec_id % 50 = 0").count() == 0
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 2)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 1)
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.search(vectors, "vec_id % 50 = 0").orderBy("query_id", "rank").collect()] == found


def test_neighbours_of_small_parts(spark, monkeypatch):
    router = neighbours.Router(np.eye(3), np.zeros(3), np.eye(3), np.zeros(3), 1)
    monkeypatch.setattr(neighbours, "fit", lambda unit, parts: router)
    # parts by the largest component: three ids, then one that comes twelve times, then ten
    rows = [(i, [1.0, 0.1 + 0.01 * i, 0.0]) for i in range(3)] + [(3, [0.1, 1.0, 0.0])] * 12 + [(i, [0.0, 0.01 * i, 1.0]) for i in range(4, 14)]
    found = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id = 0").collect()
    wanted = neighbours.best_pairs(np.array([0]), np.array([rows[0][1]]), *(np.array(x) for x in zip(*{i: (i, v) for i, v in rows}.values(), strict=True)), 5)[1]
    assert [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"])] == wanted.tolist() == [1, 2, 3, 13, 12]


def test_parts_are_balanced():
    rng = np.random.default_rng(0)
    unit = neighbours.units(rng.normal(size=(600, 8)))
    graph = neighbours.nearest(unit, unit, 10, np.arange(600))
    part = neighbours.balanced_parts(unit, graph, 6, rng)
    assert np.bincount(part, minlength=6).max() <= np.ceil(neighbours.SLACK * 100)
    inside = (part[graph] == part[:, None]).mean()
    assert inside > 2 / 6


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    stages = dict(corpus_pipeline.STAGES)
    assert [*stages] == ["toxicity", "near duplicates", "substring dedup", "secret scans", "packing"]
    toxic = stages["toxicity"](spark, docs, sf)
    assert toxic.columns == docs.columns and 0.8 * docs.count() < toxic.count() <= docs.count()
    left = stages["near duplicates"](spark, toxic, sf).cache()
    rows = [(r["doc_id"], r["text"]) for r in toxic.collect()]
    assert sorted(r["doc_id"] for r in left.collect()) == [d for d, _, _, kept in plain.near_duplicates(rows, corpus_pipeline.NEAR_PERCENT) if kept]
    cut = stages["substring dedup"](spark, left, sf).cache()
    rows = [(r["doc_id"], r["text"]) for r in left.collect()]
    gone = {d: n - removed for d, n, removed, _ in plain.recurring_words(rows, phrases.WINDOW)}
    assert {r["doc_id"]: len(plain.WORD.findall(r["text"])) for r in cut.collect()} == gone
    masked = stages["secret scans"](spark, cut, sf).cache()
    assert masked.columns == docs.columns and masked.count() == cut.count()
    assert all(not plain.secrets(r["text"]) for r in masked.collect())
    assert all(r["n_chars"] == len(r["text"]) for r in masked.collect())
    check_packing(stages["packing"](spark, masked, sf), [(r["doc_id"], r["text"]) for r in masked.collect()])
    assert corpus_pipeline.run(spark, sf).select("doc_id").distinct().count() == masked.count()


def thue_morse(n):
    """A text of a and b, and the one with both exchanged: they collide in polynomial hashes modulo 2 ** 64, whatever the base."""
    t = [bin(i).count("1") % 2 for i in range(n)]
    return ("".join("ab"[x] for x in t), "".join("ba"[x] for x in t))


def test_texts_that_fool_weak_hashes(spark):
    one, other = thue_morse(2048)
    head, tail = [f"h{i}" for i in range(30)], [f"t{i}" for i in range(30)]
    passages = [(1, " ".join([*head, one, *tail])), (2, " ".join([*head, other, *tail]))]
    assert [r["n_removed"] for r in phrases.removal_digests(spark.createDataFrame(passages, DOCS)).collect()] == [0, 0]
    words = [(1, f"{one} b c d e"), (2, f"{other} b c d e")]
    assert {r["component_id"] for r in near_dups.grouped(spark.createDataFrame(words, DOCS)).collect()} == {1, 2}
    # equal but for the exchange within a segment: windows that take in the exchange stand once
    rows = [(i, "x" * 300 + t + "y" * 300) for i, t in ((1, one), (2, other))]
    for most in (20_000, 0):
        found = exact_dups.removal_digests(spark.createDataFrame(rows, DOCS), window=1200, gram=32, most_segments=most)
        assert rows_of(found) == plain.repeated_bytes(rows, 1200)


def test_names_that_the_operators_use(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"own {passage}", 7, "k", 1, 0.5, "x"), (2, f"other {passage}", 8, "l", 2, 0.5, None)], "doc_id long, text string, marks int, key string, n int, toxic_score double, __key string")
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    assert rows_of(phrases.without_recurring(docs)) == [(1, f"own {passage}", 7, "k", 1, 0.5, "x"), (2, "other ", 8, "l", 2, 0.5, None)]
    assert rows_of(toxicity.without_toxic(docs, labels)) == rows_of(docs)


def test_pipeline_edges(spark, tmp_path):
    """No rows, null and empty texts, columns with the operators' own names."""
    schema = "doc_id long, text string, lang string, source string, n_chars int, marks int, toxic_score int, kept string"
    rows = [(1, None, "en", "s", None, 1, 1, "k"), (2, "", None, None, 0, 1, 1, "k"), (None, "some words here", "en", "s", 15, 1, 1, "k"), (3, "a b c", "en", "s", 5, 1, 1, "k"), (3, "a b c", "en", "s", 5, 1, 1, "k")]
    for name, some in (("none", []), ("some", rows)):
        spark.createDataFrame(some, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(3, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    found = corpus_pipeline.run(spark, f"{tmp_path}/some").collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "2", "3", "3", "None"]
    assert {r["length"] for r in found if r["doc_id"] in (1, 2)} == {1}


def test_rows_without_ids_are_not_held_out(spark):
    docs = spark.createDataFrame([(None, "the house is red", "en"), (3, "la casa es roja", "es")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(3, 1)], "doc_id long, toxic int")
    for found in (langid.predict_held_out(docs), toxicity.score_held_out(docs, labels)):
        assert all(r["held_out"] is not None for r in found.collect()) and found.where("doc_id IS NULL AND held_out").count() == 0
