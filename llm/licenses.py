"""License scans: an exact set-similarity join of blocks of text with license templates, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the base rule: phrases and their labels, and what parts words (after A-Z are lower-cased).
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
DELIMITERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A block has to hold so many percent of a template's distinct words.
PERCENT = 80


@dataclass(frozen=True)
class Template:
    """The words of a notice and the label it stands for. Blocks of 2 * `width` words, `width` apart, are held against it, so
    that any `width` words of a text lie whole in a block; a template has at most so many."""

    label: str
    words: str
    width: int

    @property
    def tokens(self) -> list[str]:
        return list(dict.fromkeys(self.words.split()))

    @property
    def least(self) -> int:
        return -(-PERCENT * len(self.tokens) // 100)


#: Wordings of public licenses, as their notices have them.
TEMPLATES = [
    Template("cc-by-nc", "licensed under cc by nc", 16),
    Template("cc-by-nc", "creative commons attribution noncommercial international license", 16),
    Template("cc-by-sa", "creative commons attribution sharealike international license", 16),
    Template("mit", "released under the mit license", 16),
    Template("apache", "licensed under the apache license version", 16),
    Template("gpl", "licensed under the gnu general public license version", 16),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", 96),
    Template("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", 96),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version of the license or at your option any later version", 96),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", 96),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license if a copy of the mpl was not distributed with this file you can obtain one at", 96),
]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), DELIMITERS), "")


def _places(words: str, phrases: Sequence[tuple[str, str]]) -> Column:
    """(at, label) of each place of a phrase, by the phrase's last word."""
    tests = []
    for phrase, label in phrases:
        *before, last = phrase.split()
        same = " AND ".join([f"w = '{last}'", *(f"get({words}, i - {k}) = '{x}'" for k, x in enumerate(reversed(before), 1))])
        tests.append(f"WHEN {same} THEN struct(CAST(i - {len(before)} AS BIGINT) AS at, '{label}' AS label)")
    return F.expr(f"filter(transform({words}, (w, i) -> CASE {' '.join(tests)} END), x -> x IS NOT NULL)")


def _literals(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values))


def global_order(words: DataFrame, templates: Sequence[Template]) -> list[str]:
    """The templates' words, rarest first by the number of texts that hold them, over all rows. At most as many rows as there are
    template words come to the driver."""
    vocabulary = sorted({x for t in templates for x in t.tokens})
    found = words.select(F.explode(F.array_intersect(_literals(vocabulary), "words")).alias("token")).groupBy("token").count()
    times = {r["token"]: r["count"] for r in found.collect()}
    return sorted(vocabulary, key=lambda x: (times.get(x, 0), x))


def matching_blocks(words: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """key, at (the block's first word), label, template, score of every block of `words` (key, words) that holds PERCENT of the
    distinct words of a template; score is the share it holds.

    With the tokens of both sides in one order, rarest first, a template of m tokens of which k have to be met meets a block of
    n tokens only if the first m - k + 1 of the one and the first n - k + 1 of the other share a token (prefixes), n >= k
    (length), and from the first shared one on both have enough left (positions). Tokens in no template play no part. What
    is left is counted in full. The templates' prefixes are broadcast: as many rows as the templates have words at most."""
    order = global_order(words, templates)
    spark = words.sparkSession
    rank = {x: i for i, x in enumerate(order)}
    prefixes = []
    for number, t in enumerate(templates):
        own = sorted(t.tokens, key=rank.get)
        for place, token in enumerate(own[: len(own) - t.least + 1], 1):
            prefixes.append((token, number, t.label, own, place, t.least, t.width))
    index = spark.createDataFrame(prefixes, "token string, template int, label string, tokens array<string>, place int, least int, width int")
    met = words.select("key", "words", F.posexplode("words").alias("at", "token")).join(F.broadcast(index), "token")
    # the two blocks that a word lies in
    block = F.explode(F.expr("CASE WHEN at < width THEN array(0) ELSE array(at DIV width - 1, at DIV width) END"))
    met = met.select("key", "words", "token", "template", "label", "tokens", "place", "least", "width", block.alias("block"))
    met = met.select("*", F.expr("slice(words, CAST(block * width + 1 AS INT), 2 * width)").alias("held")).drop("words")
    met = met.withColumn("known", F.array_intersect(_literals(order), "held"))
    own, size, tokens = F.array_position("known", F.col("token")), F.size("known"), F.size("tokens")
    met = met.where((size >= F.col("least")) & (own <= size - F.col("least") + 1) & (1 + F.least(size - own, tokens - F.col("place")) >= F.col("least")))
    shared = F.size(F.array_intersect("tokens", "held"))
    met = met.where(shared >= F.col("least"))
    return met.select("key", (F.col("block") * F.col("width")).alias("at"), "label", "template", (shared / tokens).alias("score")).distinct()


def license_scan(docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    base_labels: of the phrases that stand in the text, at n_base places; labels: those and of the templates that a block of it
    matches. score: 1 where a phrase stands, else the greatest share of a template in a block that matches, else 0. Null and
    empty texts have no words; doc_id may be null; repeated rows come out once each, with equal results; further columns of
    `docs` play no part. Rows of one doc_id are told apart by their texts, so a hot id is nothing to the join."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text))
    words = docs.select("doc_id", key.alias("key"), words_of(F.col("text")).alias("words"))
    rows = words.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), _places("words", phrases).alias("places"))
    blocks = matching_blocks(words.select("key", "words"), templates)
    of_text = blocks.groupBy("key").agg(F.collect_set("label").alias("found"), F.max("score").alias("best"))
    joined = rows.join(of_text, "key", "left")
    base = F.array_distinct(F.col("places.label"))
    every = F.array_union(base, F.coalesce(F.col("found"), F.array().cast("array<string>")))
    return joined.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.at").alias("first_word"),
        F.array_max("places.at").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def license_lines(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """doc_id, at, label, template, score: the blocks of each text that match a template, for a look at what was found."""
    keyed = docs.select(F.struct("doc_id").alias("key"), words_of(F.col("text")).alias("words"))
    return matching_blocks(keyed, templates).select("key.doc_id", "at", "label", "template", "score")
