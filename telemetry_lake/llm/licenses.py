"""License scan by diagonal voting.

Every rolling gram of three words of every text is joined with the grams of the license templates. A
match at word ``i`` of a text and word ``j`` of a template votes for the diagonal ``i - j``, where an
unbroken copy of the template puts all its votes. Votes are counted per diagonal, neighbouring
diagonals (a word more or less in between) are merged, and a merged span counts if its matched words
cover enough of the template. Grams are compared by 64-bit hashes. As one side is a few hundred fixed
grams, a false match is to be expected once in some 10**17 words.

The join's other side is the fixed list of templates below, so it is broadcast. Only matches are
shuffled, plus one row per document that carries its number of words.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

#: Phrases whose exact places are counted, and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

#: Openings of common license notices.
NOTICES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]

K = 3
#: Diagonals at most so far apart belong to one span.
NEAR = 3
#: Share of a notice's words that its matched grams must cover.
MIN_COVERED = 0.8
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KELVIN, OTHER = "K", "Å"


def template_words(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, text.lower()) if w]


def template_grams(spark: SparkSession) -> DataFrame:
    """A row for each gram: ``t`` (template), ``j`` (its place), ``g`` (hash); and row -1, met once by every document."""
    templates = [p.split() for p, _ in PHRASES] + [template_words(n) for _, n in NOTICES]
    rows = [(t, j, words[j : j + K]) for t, words in enumerate(templates) for j in range(len(words) - K + 1)]
    table = spark.createDataFrame([(-1, 0, [""] * K), *rows], "t int, j int, gram array<string>")
    return table.select("t", "j", F.xxhash64(*[F.col("gram")[k] for k in range(K)]).alias("g"))


def facts(spark: SparkSession) -> DataFrame:
    """A row for each template: ``t``, ``label``, ``is_phrase``, ``m`` (words)."""
    rows = [(t, label, True, len(p.split())) for t, (p, label) in enumerate(PHRASES)]
    rows += [(len(PHRASES) + t, label, False, len(template_words(n))) for t, (label, n) in enumerate(NOTICES)]
    return spark.createDataFrame(rows, "t int, label string, is_phrase boolean, m int")


def scan(docs: DataFrame) -> DataFrame:
    """License labels of every row of ``docs``.

    Returns ``doc_id``, ``n_words``, ``n_base`` (places of :data:`PHRASES`), ``first_word`` and
    ``last_word`` (smallest and largest start of one, from 0; null without), ``base_labels``,
    ``labels`` (those of verified notices too; both sorted, comma-joined, empty without) and ``score``
    (1 with a phrase, else the largest covered share of a notice). Null texts count as empty, rows
    that repeat id and text are each returned, ids may be null, further columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    # Lower case changes A-Z and other letters; of these only the Kelvin sign would turn into an ASCII letter.
    lowered = F.lower(F.replace(text, F.lit(KELVIN), F.lit(OTHER)))
    texts = docs.select("doc_id", F.xxhash64(text).alias("h"), F.array_remove(F.split(lowered, SEPARATORS), "").alias("w"))
    n = F.size("w")
    grams = F.transform(F.sequence(F.lit(0), n - K), lambda i: F.xxhash64(*[F.get(F.col("w"), i + k) for k in range(K)]))
    everyone = F.array(F.xxhash64(*[F.lit("")] * K))
    rows = texts.select(
        "doc_id", "h", n.cast("bigint").alias("n"),
        F.concat(everyone, F.when(n >= K, grams).otherwise(F.array().cast("array<bigint>"))).alias("gs"),
    )
    # The outer form, as the other lets the optimizer add a filter that computes all grams once more.
    places = rows.select("doc_id", "h", "n", F.posexplode_outer("gs").alias("p", "g"))
    # The fixed templates above: a few hundred rows at any input size.
    hits = (
        places.join(F.broadcast(template_grams(spark)), "g")
        .filter((F.col("t") < 0) == (F.col("p") == 0))
        .select("doc_id", "h", "n", "t", "j", (F.col("p") - 1 - F.col("j")).alias("diagonal"))
    )
    doc = ["doc_id", "h"]
    votes = hits.groupBy(*doc, "t", "diagonal").agg(
        F.collect_set("j").alias("js"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies")
    )
    # The list of templates is as fixed as their grams.
    known = votes.join(F.broadcast(facts(spark)), "t", "left")
    along = Window.partitionBy(*doc, "t").orderBy("diagonal")
    starts = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > NEAR, F.lit(True))
    spans = (
        known.withColumn("starts", starts)
        .withColumn("span", F.sum(F.col("starts").cast("int")).over(along))
        .groupBy(*doc, "t", "span")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("js"))).alias("js"),
            F.max("n").alias("n"), F.max("copies").alias("copies"), F.first("label").alias("label"),
            F.first("is_phrase").alias("is_phrase"), F.first("m").alias("m"),
            F.collect_list(F.when(F.col("is_phrase") & (F.size("js") == F.col("m") - K + 1), F.col("diagonal"))).alias("at"),
        )
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("js", lambda j: F.array(*[j + k for k in range(K)])))))
    spans = spans.withColumn("covered", F.when(~F.col("is_phrase"), covered / F.col("m")))
    phrase_label = F.when(F.col("is_phrase") & (F.size("at") > 0), F.col("label"))
    notice_label = F.when(~F.col("is_phrase") & (F.col("covered") >= MIN_COVERED), F.col("label"))
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    found = spans.groupBy(*doc).agg(
        F.max("n").alias("n_words"),
        F.max(F.when(F.col("t") < 0, F.col("copies"))).alias("copies"),
        F.sum(F.size("at")).cast("bigint").alias("n_base"),
        F.min(F.array_min("at")).cast("bigint").alias("first_word"),
        F.max(F.array_max("at")).cast("bigint").alias("last_word"),
        joined(F.collect_set(phrase_label)).alias("base_labels"),
        joined(F.collect_set(F.coalesce(phrase_label, notice_label))).alias("labels"),
        F.coalesce(F.max("covered"), F.lit(0.0)).alias("covered"),
    )
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.least(F.col("covered"), F.lit(1.0)))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", score.alias("score"),
        F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")
