"""Toxicity by non-negative positive-unlabelled learning on hashed words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.columns import chunks, free_names, flat, over_chunks
from llm.hashing import byte_values, prefix, stretches, word_bounds

#: Hash buckets of words.
BUCKETS = 1 << 18
#: The classifier is fitted on at most about so many confirmed toxic and so many unlabelled texts.
TOXIC_TEXTS = 4000
UNLABELLED_TEXTS = 12_000
#: A word has a weight if its share of toxic texts is above that of unlabelled ones by so many standard errors.
LEAST_Z = 4.5
ROUNDS = 300
RATE = 0.05
RIDGE = 1e-4
#: Everything but letters parts words; bytes over 0x7F are taken for letters.
BREAKS = bytes(x for x in range(128) if not chr(x).isalpha())


@dataclass
class Classifier:
    weight: np.ndarray
    bias: float

    def scores(self, text_of: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        z = self.bias + np.bincount(text_of, self.weight[bucket], minlength=n)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def distinct_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of each word that a text has, once for each text."""
    data, offsets = flat(pc.utf8_lower(texts))
    starts, ends, bounds = word_bounds(data, offsets, BREAKS)
    bucket = (stretches(prefix(byte_values(data)), starts, ends) % np.uint64(BUCKETS)).astype(np.int64)
    pairs = np.repeat(np.arange(len(texts)), np.diff(bounds)) * BUCKETS + bucket
    pairs.sort()
    pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]][: len(pairs)]]
    return pairs // BUCKETS, pairs % BUCKETS


def telling_words(toxic: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Which buckets are in clearly more of the toxic texts than of the unlabelled ones."""
    a, b = (np.bincount(np.concatenate(x), minlength=BUCKETS) for x in (toxic, unlabelled))
    n, m = len(toxic), len(unlabelled)
    share = (a + b) / (n + m)
    return a / n - b / m >= LEAST_Z * np.sqrt(share * (1 - share) * (1 / n + 1 / m)) + 1e-12


def fit(toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Classifier:
    """Gradient descent on prior * R+(toxic) + max(0, R-(unlabelled) - prior * R-(toxic)) with the logistic loss.

    Where the second part would fall below zero, its gradient is turned round. The mean of the later half of the
    steps is kept, as such turns make single steps waver."""
    if not toxic or not unlabelled:
        return Classifier(np.zeros(BUCKETS), -4.0)
    both, n_toxic = [*toxic, *unlabelled], len(toxic)
    bucket, owner = np.concatenate(both).astype(np.int64), np.repeat(np.arange(len(both)), [len(x) for x in both])
    keep = telling_words(toxic, unlabelled)[bucket]
    used, column = np.unique(bucket[keep], return_inverse=True)
    owner = owner[keep]
    n, m = len(both), len(used)
    is_toxic = np.arange(n) < n_toxic
    at, mean = np.zeros(m + 1), np.zeros(m + 1)  # the last is the bias
    first, second = np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, ROUNDS + 1):
        z = at[m] + np.bincount(owner, at[column], minlength=n)
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        loss = np.logaddexp(0, z)
        rest = loss[n_toxic:].mean() - prior * loss[:n_toxic].mean()
        g = np.where(is_toxic, -prior * p / n_toxic, p / (n - n_toxic))
        g = -g if rest < 0 else g + np.where(is_toxic, prior * (p - 1) / n_toxic, 0)
        slope = np.r_[np.bincount(column, g[owner], minlength=m) + RIDGE * at[:m], g.sum()]
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope * slope
        at = at - RATE * np.sqrt(1 - 0.999**t) / (1 - 0.9**t) * first / (np.sqrt(second) + 1e-8)
        mean += at if 2 * t > ROUNDS else 0
    mean /= ROUNDS - ROUNDS // 2
    weight = np.zeros(BUCKETS)
    weight[used] = mean[:m]
    return Classifier(weight, float(mean[m]))


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """From the texts of `docs` and those of them that `labels` (doc_id, toxic) marks 1.

    The share of toxic rows among the labels is the class prior; beyond that, labels of 0 are not used. Texts are chosen
    by a hash of doc_id, at most about TOXIC_TEXTS and UNLABELLED_TEXTS of them, and reach the driver as word buckets."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n_known, n_toxic = known.agg(F.count("*"), F.sum(F.col("toxic").cast("long"))).first()
    n_docs = docs.count()
    if not n_toxic or not n_docs:
        return Classifier(np.zeros(BUCKETS), -4.0)
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity")), F.lit(1 << 20)) / float(1 << 20)
    texts = docs.select("doc_id", "text").where("text IS NOT NULL")
    positive = known.where(F.col("toxic") == 1).where(draw < min(1.0, TOXIC_TEXTS / n_toxic)).select("doc_id")
    # both sides are bounded by the two parameters, so the chosen ids may be sent to every task
    chosen = texts.where(draw < min(1.0, UNLABELLED_TEXTS / n_docs)).withColumn("is_toxic", F.lit(False)).union(texts.join(F.broadcast(positive), "doc_id").withColumn("is_toxic", F.lit(True)))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            text_of, bucket = distinct_words(chunk.column("text"))
            ends = np.r_[0, np.cumsum(np.bincount(text_of, minlength=chunk.num_rows))].astype(np.int32)
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id").cast(pa.string()), chunk.column("is_toxic"), pa.ListArray.from_arrays(ends, pa.array(bucket.astype(np.int32)))], names=["doc_id", "is_toxic", "words"])

    found = chosen.select("doc_id", "text", "is_toxic").mapInArrow(words, "doc_id string, is_toxic boolean, words array<int>").toArrow()
    found = found.sort_by("doc_id")
    rows = found["words"].combine_chunks()
    flags = found["is_toxic"].to_pylist()
    lists = [np.asarray(x.values) for x in rows]
    return fit([x for x, y in zip(lists, flags, strict=True) if y], [x for x, y in zip(lists, flags, strict=True) if not y], n_toxic / n_known)


def scores(docs: DataFrame, model: Classifier, column: str = "toxic_score") -> DataFrame:
    """All columns of `docs` and `column` (0 to 1; null and empty texts get the score of no words). It must not be one of theirs."""
    names = docs.columns

    def work(chunk: pa.RecordBatch) -> dict[str, object]:
        texts = pc.fill_null(chunk.column("text"), "")
        return {x: chunk.column(x) for x in names} | {column: model.scores(*distinct_words(texts), chunk.num_rows)}

    return over_chunks(docs, names, work, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def score_held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from rows whose crc32(doc_id) mod 5 is not 0; doc_id, held_out, score and predicted of all rows.

    Rows without a doc_id have no label and are not held out. Repeated rows come out once each with equal scores; a score of
    just 0.5 counts as toxic. Without labels, or with none of 1, no text is toxic."""
    held_out = F.expr("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0")
    learned = F.coalesce(~held_out, F.lit(True))
    model = train(docs.where(learned), labels.where(learned))
    scored = scores(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, all their columns, that a classifier trained on the labelled ones of them does not score 0.5 or more.

    Null and empty texts stay, and so does every row where nothing is labelled 1. Of repeated rows all stay or go."""
    (column,) = free_names(docs, "toxic_score")
    return scores(docs, train(docs, labels), column).where(F.col(column) < 0.5).drop(column)
