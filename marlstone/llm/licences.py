"""Licence statements in texts: phrases word by word, and templates by an exact set-similarity join.

DataFrame functions only: no Python runs on the data.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Phrases and the labels they give.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Statements that licence texts and notices open with, and their labels. At the threshold below none passes without
#: the words that tell it from others; one that holds another's words (the Affero licence) gets both labels.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "Licensed under the Apache License Version 2.0"),
    ("apache-2", "You may not use this file except in compliance with the License"),
    ("gpl-3", "GNU General Public License version 3"),
    ("gpl-2", "GNU General Public License version 2"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("agpl-3", "GNU Affero General Public License version 3"),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("bsd", "Redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License v 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
]
#: Share of a template's distinct words that a block must hold.
THRESHOLD = 0.9
#: What stands between words, in lower-cased texts and in any.
_MARKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_MARK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def lowered(text: Column) -> Column:
    """A-Z to a-z, all else as it is."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column) -> Column:
    return F.filter(F.split(lowered(text), _MARKS), lambda w: w != "")


def _plain(phrase: str) -> list[str]:
    return [w for w in re.split(_MARKS, phrase.translate({c: c + 32 for c in range(65, 91)})) if w]


def with_phrases(docs: DataFrame, phrases: dict[str, str], text: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` and ``places``: (start word, label) wherever a phrase's words stand consecutively.

    Only texts in which a pattern finds one of the phrases are cut into words and searched place by place.
    """
    column = F.col(f"`{text}`")
    said = words_of(column)

    def found(phrase: str, label: str) -> Column:
        own = _plain(phrase)
        hit = lambda i: F.array(*[F.get("_w", i + k) for k in range(len(own))]) == F.array(*map(F.lit, own))
        places = F.filter(F.transform("_w", lambda w, i: F.when((w == own[0]) & hit(i), i)), lambda i: i.isNotNull())
        return F.transform(places, lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))

    any_phrase = "|".join(f"{_MARK}+".join(map(re.escape, _plain(p))) for p in phrases if _plain(p))
    hit = column.rlike(f"(?i)(?:{any_phrase})") if any_phrase else F.lit(False)
    none = F.array().cast("array<struct<start:bigint,label:string>>")
    searched = [found(p, label) for p, label in phrases.items() if _plain(p)]
    counted = docs.withColumn("n_words", F.regexp_count(F.coalesce(column, F.lit("")), F.lit(_MARK.replace("[", "[^") + "+")).cast("long"))
    counted = counted.withColumn("_w", F.when(hit, said))
    return counted.withColumn("places", F.when(F.col("_w").isNotNull(), F.concat(*searched)).otherwise(none) if searched else none).drop("_w")


def templates_table(spark: SparkSession, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """(template, label, tokens, need): the distinct words of each template and how many of them a block must hold."""
    rows = []
    for k, (label, statement) in enumerate(templates):
        tokens = sorted(set(_plain(statement)))
        if tokens:
            rows.append((k, label, tokens, needed(len(tokens), threshold)))
    return spark.createDataFrame(rows, "template int, label string, tokens array<string>, need int")


def needed(size: int, threshold: float) -> int:
    """The least whole number of at least ``threshold`` of ``size`` tokens, 1 or more."""
    return max(1, -(-round(size * threshold * 1_000_000) // 1_000_000))


def matches(
    docs: DataFrame, templates: list[tuple[str, str]], threshold: float = THRESHOLD, text: str = "text"
) -> DataFrame:
    """(digest, block, template, label, containment) of every block of every distinct text that holds at least
    ``threshold`` of a template's distinct words; ``digest`` is the text's SHA-256.

    A block is a stretch of twice as many words as the longest template has, one starting every so many words, so
    that whatever is as long as a template stands whole in some block. Templates' words are ordered by their
    frequency in ``docs``, rarest first (ties by code point), and words that no template has are left out of
    blocks, as they cannot count. A template of n words that needs m can only be held by a block that shares
    one of its n - m + 1 rarest (prefix filter); the block must have m words (length filter), and the words from the
    first shared one on must suffice on both sides (positional filter). What is left is compared whole. The work
    grows with the blocks that hold a rare word of a template; templates and their words are broadcast.
    """
    spark = docs.sparkSession
    asked = templates_table(spark, templates, threshold)
    longest = max([len(_plain(s)) for _, s in templates] or [1])
    vocabulary = sorted({w for _, s in templates for w in _plain(s)})  # as many as the templates have
    column = F.col(f"`{text}`")
    if not vocabulary:
        return spark.createDataFrame([], "digest string, block int, template int, label string, containment double")
    known = spark.createDataFrame([(w,) for w in vocabulary], "token string")
    # how often each template word occurs in all documents
    counted = docs.select(F.explode(words_of(column)).alias("token")).join(F.broadcast(known), "token")
    counted = counted.groupBy("token").agg(F.count("*").alias("n"))
    counted = known.join(counted, "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n")).collect()
    order = sorted(vocabulary, key=dict(map(tuple, counted)).get)  # a stable sort: ties by code point
    place = {w: k for k, w in enumerate(order)}

    ranked = spark.createDataFrame(
        [(r["template"], r["label"], sorted(place[w] for w in r["tokens"]), r["need"]) for r in asked.collect()],
        "template int, label string, template_ranks array<int>, need int")
    prefix = ranked.select("*", F.size("template_ranks").alias("size"), F.posexplode(
        F.slice("template_ranks", 1, F.size("template_ranks") - F.col("need") + 1)).alias("template_at", "rank"))
    first_words = sorted({order[r["rank"]] for r in prefix.select("rank").distinct().collect()})

    cut = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size("_w") - 1 - longest) / longest).cast("int"))),
        lambda b: F.slice("_w", b * longest + 1, 2 * longest))
    wanted = F.array(*[F.lit(w) for w in first_words]).cast("array<string>")
    said = docs.select(F.sha2(F.coalesce(column, F.lit("")), 256).alias("digest"), words_of(column).alias("_w"))
    blocks = said.where(F.arrays_overlap("_w", wanted)).select("digest", F.posexplode(cut).alias("block", "words"))
    blocks = blocks.where(F.arrays_overlap("words", wanted))
    ranks = F.create_map(*[F.lit(x) for w, k in place.items() for x in (w, k)])
    own = F.array_intersect("words", F.array(*map(F.lit, order)).cast("array<string>"))
    blocks = blocks.select("digest", "block", F.sort_array(F.transform(own, lambda w: F.element_at(ranks, w))).alias("ranks"))

    tokens = blocks.select("*", F.posexplode("ranks").alias("block_at", "rank"))
    pairs = tokens.join(F.broadcast(prefix), "rank")
    left = F.least(F.size("ranks") - F.col("block_at"), F.col("size") - F.col("template_at"))
    pairs = pairs.where((F.size("ranks") >= F.col("need")) & (left >= F.col("need")))
    # the first shared word stands for the pair: nothing before it on either side is shared
    before = F.arrays_overlap(
        F.expr("slice(ranks, 1, block_at)"), F.expr("slice(template_ranks, 1, template_at)"))
    pairs = pairs.where(~before)
    shared = F.size(F.array_intersect("ranks", "template_ranks"))
    return pairs.where(shared >= F.col("need")).select(
        "digest", "block", "template", "label", (shared / F.col("size")).alias("containment"))


def licences(
    docs: DataFrame, phrases: dict[str, str] | None = None, templates: list[tuple[str, str]] | None = None,
    threshold: float = THRESHOLD, text: str = "text", keep: list[str] | None = None,
) -> DataFrame:
    """``row`` (the document, or its columns ``keep``), ``n_words``, ``places`` (start word, label of each phrase found), ``blocks`` (block, label,
    containment of each template held) and ``score``: 1 with a place, else the best containment, 0 without any.

    Words are ASCII letters and digits and all beyond ASCII, with A-Z lower-cased; a null text is empty and has none.
    Texts are scanned whole. Equal texts give equal results, whatever their ids; the join compares each row's text
    but groups what it finds by text, so a group of copies of any size travels as one row.
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    held = matches(docs, templates, threshold, text).groupBy("digest").agg(F.sort_array(F.collect_set(
        F.struct("block", "label", "containment"))).alias("blocks"))
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])
    base = docs.select(row.alias("row"), F.col(f"`{text}`").alias("_text"))
    base = with_phrases(base, phrases, "_text").withColumn("digest", F.sha2(F.coalesce("_text", F.lit("")), 256)).drop("_text")
    out = base.join(held, "digest", "left").withColumn(
        "blocks", F.coalesce("blocks", F.array().cast("array<struct<block:int,label:string,containment:double>>")))
    best = F.coalesce(F.array_max(F.transform("blocks", lambda b: b["containment"])), F.lit(0.0))
    return out.select("row", "n_words", "places", "blocks", F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"))


def _labels(*lists: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.concat(*lists))), ",")


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = licences(docs, keep=["doc_id"])
    starts = F.transform("places", lambda p: p["start"])
    base, own = (F.transform(c, lambda x: x["label"]) for c in ("places", "blocks"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        _labels(base).alias("base_labels"), _labels(base, own).alias("labels"), "score")


def _sql() -> str:
    """The scan as SQL: every block against every template."""
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    longest = max(len(_plain(s)) for _, s in TEMPLATES)
    phrases = ", ".join(f"({quoted(_plain(p))}, '{label}')" for p, label in PHRASES.items())
    tokens = [(label, sorted(set(_plain(s)))) for label, s in TEMPLATES]
    templates = ", ".join(f"('{label}', {quoted(t)}, {needed(len(t), THRESHOLD)})" for label, t in tokens)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{_MARKS.replace("[", "[^", 1)}') AS w FROM documents),
p(phrase, label) AS (VALUES {phrases}), t(label, tokens, need) AS (VALUES {templates}),
spots AS (SELECT r, label, unnest(list_filter(range(0, len(w) - len(phrase) + 1), lambda i: w[i + 1:i + len(phrase)] = phrase)) AS i FROM d, p),
base AS (SELECT r, count(*) AS n, min(i) AS low, max(i) AS high FROM spots GROUP BY r),
b AS (SELECT r, unnest(list_transform(range(0, greatest(0, (len(w) - 1 - {longest}) // {longest}) + 1),
    lambda k: list_distinct(w[k * {longest} + 1:k * {longest} + 2 * {longest}]))) AS words FROM d WHERE len(w) > 0),
held AS (SELECT r, label, len(list_intersect(words, tokens)) / len(tokens) AS c FROM b, t WHERE len(list_intersect(words, tokens)) >= need),
best AS (SELECT r, max(c) AS c FROM held GROUP BY r),
bl AS (SELECT r, string_agg(label, ',' ORDER BY label) AS s FROM (SELECT DISTINCT r, label FROM spots) GROUP BY r),
al AS (SELECT r, string_agg(label, ',' ORDER BY label) AS s FROM (SELECT r, label FROM spots UNION SELECT r, label FROM held) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, low AS first_word, high AS last_word, coalesce(bl.s, '') AS base_labels,
  coalesce(al.s, '') AS labels, CASE WHEN n > 0 THEN 1 ELSE coalesce(best.c, 0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN best USING (r) LEFT JOIN bl USING (r) LEFT JOIN al USING (r)
"""


OP13_SQL = _sql()
