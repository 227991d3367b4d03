"""Language of mixed text: scripts narrow the candidates, then Viterbi over word scores with a switching penalty labels spans."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.columns import chunks, flat, over_chunks

#: Hash buckets of letter n-grams, and the lengths in bytes that are counted.
BUCKETS = 1 << 16
GRAMS = (2, 3, 4)
#: At most about so many texts of each language are counted.
TEXTS_PER_LANGUAGE = 3000
#: Log-odds that a change of language costs.
SWITCH = 12.0
#: A language is a candidate for a script in which at least this share of its letters is.
LEAST_SCRIPT_SHARE = 0.01
#: What a word of another script counts for a language that is no candidate.
OUT_OF_SCRIPT = -60.0
#: Words between two places where the search is carried on from all labels at once.
BLOCK = 256
UNDETERMINED = "und"

#: First code points of ranges and the script of each; 0 is shared by all.
SCRIPT_STARTS = np.array([0x0, 0x41, 0x5B, 0x61, 0x7B, 0xC0, 0x250, 0x370, 0x400, 0x530, 0x590, 0x600, 0x700, 0x900, 0xE00, 0xE80, 0x10A0, 0x1100, 0x1200, 0x1E00, 0x2000, 0x3040, 0x3100, 0x3400, 0xA000, 0xAC00, 0xD7B0, 0x20000, 0x40000])
SCRIPT_IDS = np.array([0, 1, 0, 1, 0, 1, 0, 2, 3, 4, 5, 6, 0, 7, 8, 0, 9, 10, 0, 1, 0, 11, 0, 12, 0, 10, 0, 12, 0])
SCRIPTS = 13


@dataclass
class Words:
    """The words of a chunk: runs of letters. grams: bucket and owning word of each n-gram."""

    text_of: np.ndarray
    letters: np.ndarray
    script: np.ndarray
    grams: list[tuple[np.ndarray, np.ndarray]]


def read_words(texts: pa.Array) -> Words:
    data, offsets = flat(pc.utf8_lower(texts))
    n = len(offsets) - 1
    own = np.full(len(data) + n + 4, 0x20, np.uint8)  # a space between texts
    places = np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))
    letter = np.zeros(256, bool)
    letter[0x61:0x7B] = letter[0x80:] = True
    own[places] = np.where(letter[data], data, 0x20)
    full = own != 0x20
    begins = full & np.r_[True, ~full[:-1]]
    word = np.cumsum(begins) - 1
    starts = np.flatnonzero(begins)
    text_starts = offsets[:-1] + np.arange(n)
    text_of = np.searchsorted(text_starts, starts, "right") - 1
    character = full & ((own & 0xC0) != 0x80)
    letters = np.bincount(word[character], minlength=len(starts))

    wide = own.astype(np.uint64)
    grams = []
    for k in GRAMS:
        code = wide[: len(wide) - k + 1].copy()
        for j in range(1, k):
            code = code * np.uint64(257) + wide[j : len(wide) - k + 1 + j]
        inner = full[1 : 1 + len(code)].copy()  # all but the outer bytes are of one word
        for j in range(2, k - 1):
            inner &= full[j : j + len(code)]
        at = np.flatnonzero(inner)
        bucket = ((code[at] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(BUCKETS)
        grams.append((bucket.astype(np.int64), word[at + 1]))

    script = np.zeros(len(starts), np.int64)
    lead = np.flatnonzero(full & (own >= 0xC0))
    latin = np.flatnonzero(full & (own < 0x80))
    script[word[latin]] = 1
    if len(lead):
        a, b, c, d = (own[np.minimum(lead + j, len(own) - 1)].astype(np.int64) for j in range(4))
        point = np.where(a < 0xE0, (a & 0x1F) << 6 | b & 0x3F, np.where(a < 0xF0, (a & 0xF) << 12 | (b & 0x3F) << 6 | c & 0x3F, (a & 0x7) << 18 | (b & 0x3F) << 12 | (c & 0x3F) << 6 | d & 0x3F))
        kind = SCRIPT_IDS[np.searchsorted(SCRIPT_STARTS, point, "right") - 1]
        np.maximum.at(script, word[lead], kind)
    return Words(text_of, letters, script, grams)


@dataclass
class Model:
    """log_p[bucket, language] and candidate[script, language]."""

    languages: list[str]
    log_p: np.ndarray
    candidate: np.ndarray


def train(docs: DataFrame, per_language: int = TEXTS_PER_LANGUAGE) -> Model:
    """From doc_id, text and lang; rows without text or language are left out.

    About `per_language` texts of each language, chosen by a hash of doc_id, are counted on the executors; the driver
    gets the sums, at most BUCKETS rows for each language."""
    rows = docs.select("doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((SCRIPTS, 0), bool))
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_language / n))])
    sample = rows.where((F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("language")), F.lit(1 << 20)) / float(1 << 20)) < share[F.col("lang")])
    number = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(number), BUCKETS + SCRIPTS), np.int64)
        for chunk in chunks(batches):
            words = read_words(chunk.column("text"))
            lang = np.array([number[x] for x in chunk.column("lang").to_pylist()])[words.text_of]
            for bucket, word in words.grams:
                sums += np.bincount(lang[word] * (BUCKETS + SCRIPTS) + bucket, minlength=sums.size).reshape(sums.shape)
            sums += np.bincount(lang * (BUCKETS + SCRIPTS) + BUCKETS + words.script, words.letters, minlength=sums.size).astype(np.int64).reshape(sums.shape)
        lang, at = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(sums[lang, at])], names=["language", "place", "n"])

    found = sample.select("text", "lang").mapInArrow(count, "language int, place int, n long").groupBy("language", "place").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros((len(languages), BUCKETS + SCRIPTS))
    sums[found["language"].to_numpy(), found["place"].to_numpy()] = found["n"].to_numpy()
    counts, scripts = sums[:, :BUCKETS], sums[:, BUCKETS:]
    log_p = np.log((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * BUCKETS))
    candidate = scripts >= LEAST_SCRIPT_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)
    candidate[:, 0] = True
    return Model(languages, np.ascontiguousarray(log_p.T.astype(np.float32)), candidate.T)


def word_scores(words: Words, model: Model) -> np.ndarray:
    """Log-likelihood of each word's n-grams for each language."""
    n, size = len(words.letters), len(model.languages)
    scores = np.zeros((n, size), np.float32)
    for bucket, word in words.grams:
        if len(word):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            scores[word[starts]] += np.add.reduceat(model.log_p[bucket], starts, axis=0)
    own = model.candidate[words.script]
    known = own.any(1)
    return np.where(own | ~known[:, None], np.where(known[:, None], scores, 0), scores + OUT_OF_SCRIPT)


def best_path(scores: np.ndarray, sizes: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """For texts of `sizes` words each, one after the other, the labels with the largest sum of scores less `switch` for each change.

    Texts are cut into blocks that advance together, each from every label before it; then the blocks are joined."""
    total, size = scores.shape
    labels = np.zeros(total, np.int64)
    if not total:
        return labels
    blocks = -(-sizes // BLOCK)
    text = np.repeat(np.arange(len(sizes)), blocks)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = (np.cumsum(sizes) - sizes)[text] + nth * BLOCK
    length = np.minimum(BLOCK, sizes[text] - nth * BLOCK)
    order = np.argsort(-length, kind="stable")
    start, long = begin[order], length[order]
    alive = np.searchsorted(-long, -np.arange(1, BLOCK + 1), "right")
    enter = np.where(np.eye(size, dtype=bool), 0, -switch).astype(np.float32)
    best = np.broadcast_to(enter, (len(start), size, size)).copy()  # block, label before, label now
    turn = np.zeros((total, size), np.min_scalar_type(size))
    jumped = np.zeros((total, size, -(-size // 8)), np.uint8)  # a bit for each label now: came by a switch
    for t in range(int(long[0])):
        k = alive[t]
        now, at = best[:k], start[:k] + t
        if t:
            top = now.argmax(2)
            turn[at] = top
            value = np.take_along_axis(now, top[:, :, None], 2) - switch
            jumped[at] = np.packbits(value > now, axis=2, bitorder="little")
            np.maximum(now, value, out=now)
        now += scores[at][:, None, :]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    first = np.cumsum(blocks) - blocks
    most = int(blocks.max())
    leave = np.zeros((len(order), size), np.int64)  # the label before the block, for each label at its end
    value = np.zeros((len(sizes), size), np.float32)
    for j in range(most):
        own = np.flatnonzero(blocks > j)
        inside = best[back[first[own] + j]]
        # before the first word any label is free
        sums = inside + (value[own][:, :, None] if j else 0)
        leave[first[own] + j] = sums.argmax(1)
        value[own] = sums.max(1)
    last = value.argmax(1)
    final, entry = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    for j in range(most - 1, -1, -1):
        own = np.flatnonzero(blocks > j)
        final[first[own] + j] = last[own]
        last[own] = leave[first[own] + j, last[own]]
        entry[first[own] + j] = last[own]
    label, before = final[order], entry[order]
    for t in range(int(long[0]) - 1, -1, -1):
        k = alive[t]
        at, now = start[:k] + t, label[:k]
        labels[at] = now
        if t:
            from_other = (jumped[at, before[:k], now >> 3] >> (now & 7)) & 1
            label[:k] = np.where(from_other == 1, turn[at, before[:k]], now)
    return labels


def label_words(texts: pa.Array, model: Model) -> tuple[Words, np.ndarray]:
    words = read_words(texts)
    sizes = np.bincount(words.text_of, minlength=len(texts)) if len(words.text_of) else np.zeros(len(texts), np.int64)
    return words, best_path(word_scores(words, model), sizes)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (the share of the text's letters in spans of that language) and n_spans of every row.

    Null texts and those without a letter get `und` and score 0. Ties go to the language that sorts first."""
    languages = model.languages

    def work(chunk: pa.RecordBatch) -> dict[str, object]:
        texts = pc.fill_null(chunk.column("text"), "")
        has_letter = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
        n, size = len(texts), max(len(languages), 1)
        if not languages:
            return {"doc_id": chunk.column("doc_id"), "lang_pred": [UNDETERMINED] * n, "score": np.zeros(n), "n_spans": np.zeros(n, np.int64)}
        words, labels = label_words(texts, model)
        weight = np.bincount(words.text_of * size + labels, words.letters, minlength=n * size).reshape(n, size)
        changes = np.r_[True, (labels[1:] != labels[:-1]) | (words.text_of[1:] != words.text_of[:-1])][: len(labels)]
        spans = np.bincount(words.text_of[changes], minlength=n)
        best = weight.argmax(1)
        score = weight[np.arange(n), best] / np.maximum(weight.sum(1), 1)
        return {"doc_id": chunk.column("doc_id"), "lang_pred": np.where(has_letter, np.array(languages)[best], UNDETERMINED), "score": np.where(has_letter, score, 0.0), "n_spans": np.where(has_letter, spans, 0)}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return over_chunks(docs, ["doc_id", "text"], work, f"doc_id {kind}, lang_pred string, score double, n_spans long")


def predict_held_out(docs: DataFrame) -> DataFrame:
    """Learns from the rows whose crc32(doc_id) mod 4 is not 2, and predicts all rows.

    Rows without a doc_id are not held out. Repeated rows come out once each with equal predictions; of languages that score
    alike the first in alphabetical order is taken. Without labels every text is `und`."""
    held_out = F.expr("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2")
    model = train(docs.where(F.coalesce(~held_out, F.lit(True))))
    return predict(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "n_spans")
