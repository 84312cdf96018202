"""License scan by diagonal voting, in DataFrame operations only.

All rolling word k-gram hashes of the texts are joined with the places they
have in license templates. A hit at word p of a text and word t of a template
votes for the diagonal p - t. Votes are aggregated by diagonal, neighbouring
diagonals are merged (a few words may be added or left out), and a merged
span is verified by the share of the template's words that its hits cover.
Short phrases are templates whose words all have to be there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from relcast.llm.common import ascii_lower

#: Words after lower-casing A-Z: digits, letters, and anything beyond ASCII.
WORD_RE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Notices as their licenses publish them.
TEMPLATES = (
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mpl-2.0-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("unlicense-text", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("cc-by-4.0", "licensed under CC BY 4.0"),
    ("cc-by-nc-4.0", "licensed under CC BY-NC 4.0"),
    ("cc-by-sa-4.0", "licensed under CC BY-SA 4.0"),
)

#: Words of a k-gram: two in phrases, three in templates.
PHRASE_GRAM, GRAM = 2, 3
#: Diagonals at most so far apart are one alignment.
SLACK = 4
#: Least share of a template's k-grams for its label; templates of up to SHORT words need all.
COVERAGE, SHORT = 0.6, 12


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.regexp_extract_all(F.coalesce(ascii_lower(text), F.lit("")), F.lit(f"({WORD_RE})"), 1)


def _gram_hash(words: Column, at: Column, size: int) -> Column:
    """Hash of the words at..at+size-1; null where the text ends before."""
    last = F.get(words, at + (size - 1))
    return F.when(last.isNotNull(), F.xxhash64(*[F.get(words, at + k) for k in range(size)], F.lit(size)))


def _gram_text(words: Column, at: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, at + 1, size), " ")


def template_grams(spark: SparkSession) -> DataFrame:
    """(hash, places): places are (template, t, grams, need, gram) of every template k-gram.

    The templates are the constants above, some hundreds of words, so this
    table has a fixed bound and is broadcast.
    """
    rows = [(f"base:{label}:{i}", text, PHRASE_GRAM) for i, (text, label) in enumerate(PHRASES)]
    rows += [(f"text:{label}", text, GRAM) for label, text in TEMPLATES]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("template"), F.lit(x).alias("text"), F.lit(k).alias("k")) for n, x, k in rows]))
    frame = spark.range(1).select(each.alias("r")).select("r.*").withColumn("words", words_of(F.col("text")))
    size = F.size("words")
    placed = frame.withColumn("t", F.explode(F.sequence(F.lit(0), size - F.col("k"))))
    grams = size - F.col("k") + 1
    need = F.when(size <= SHORT, grams).otherwise(F.ceil(grams * F.lit(COVERAGE))).cast("int")
    h = F.when(F.col("k") == PHRASE_GRAM, _gram_hash(F.col("words"), F.col("t"), PHRASE_GRAM)).otherwise(_gram_hash(F.col("words"), F.col("t"), GRAM))
    place = F.struct("template", "t", grams.alias("grams"), need.alias("need"), _gram_text(F.col("words"), F.col("t"), F.col("k")).alias("gram"))
    return placed.select(h.alias("hash"), place.alias("place")).groupBy("hash").agg(F.collect_list("place").alias("places"))


def votes(docs: DataFrame) -> DataFrame:
    """Hits of every text on the templates, and one marker row per text.

    doc_id, th (hash of the text), n_words, template, diagonal, t, grams, need;
    in marker rows the template is null.
    """
    grams = template_grams(docs.sparkSession)
    short, long_ = (F.broadcast(grams.select(F.col("hash").alias(h), F.col("places").alias(p))) for h, p in (("h2", "p2"), ("h3", "p3")))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), words_of(F.col("text")).alias("words"))
    rolled = text.select("doc_id", "th", F.size("words").alias("n_words"), "words", F.posexplode_outer("words").alias("p", "w"))
    rolled = rolled.select("doc_id", "th", "n_words", "words", "p", _gram_hash(F.col("words"), F.col("p"), PHRASE_GRAM).alias("x2"), _gram_hash(F.col("words"), F.col("p"), GRAM).alias("x3"))
    hits = rolled.join(short, F.col("x2") == F.col("h2"), "left").join(long_, F.col("x3") == F.col("h3"), "left")
    first = F.coalesce(F.col("p"), F.lit(0)) == 0
    hits = hits.where(first | F.col("p2").isNotNull() | F.col("p3").isNotNull())
    none = F.array().cast("array<struct<template:string,t:int,grams:int,need:int,gram:string>>")
    marker = F.array(F.struct(F.lit(None).cast("string").alias("template"), F.lit(0).alias("t"), F.lit(0).alias("grams"), F.lit(0).alias("need"), F.lit(None).cast("string").alias("gram")))
    places = F.concat(F.when(first, marker).otherwise(none), F.coalesce("p2", none), F.coalesce("p3", none))
    hits = hits.select("doc_id", "th", "n_words", "words", F.coalesce("p", F.lit(0)).alias("p"), F.explode(places).alias("h"))
    size = F.when(F.col("h.template").startswith("base:"), PHRASE_GRAM).otherwise(GRAM)
    same = F.col("h.template").isNull() | (_gram_text(F.col("words"), F.col("p"), size) == F.col("h.gram"))  # equal words, not just equal hashes
    hits = hits.where(same)
    return hits.select("doc_id", "th", "n_words", "h.template", (F.col("p") - F.col("h.t")).alias("diagonal"), "h.t", "h.grams", "h.need")


def spans(docs: DataFrame) -> DataFrame:
    """Verified spans and markers: doc_id, th, n_words, template, start, score, copies.

    ``start`` is the first word of the alignment, ``score`` the share of the
    template's k-grams found. Marker rows have a null template and in
    ``copies`` the number of input rows with that doc_id and text. Hits are
    sets of template places, so repeated rows do not vote twice.
    """
    doc = ["doc_id", "th", "n_words"]
    lines = votes(docs).groupBy(*doc, "template", "diagonal").agg(
        F.collect_set("t").alias("ts"), F.first("grams").alias("grams"), F.first("need").alias("need"), F.count("*").alias("n"))
    # merging: phrases stay on one diagonal, in templates neighbouring ones join
    along = Window.partitionBy(*doc, "template").orderBy("diagonal")
    exact = F.col("need") == F.col("grams")
    fresh = exact | F.lag("diagonal").over(along).isNull() | (F.col("diagonal") - F.lag("diagonal").over(along) > SLACK)
    merged = lines.withColumn("run", F.sum(fresh.cast("int")).over(along))
    merged = merged.groupBy(*doc, "template", "run").agg(
        F.min("diagonal").alias("start"), F.array_distinct(F.flatten(F.collect_list("ts"))).alias("ts"),
        F.first("grams").alias("grams"), F.first("need").alias("need"), F.first("n").alias("copies"))
    found = F.size("ts")
    return merged.where(F.col("template").isNull() | (found >= F.col("need"))).select(
        *doc, "template", "start", F.when(F.col("template").isNotNull(), found / F.col("grams")).alias("score"), "copies")


def scan(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Null and empty texts have no words, no labels and score 0. Null ids and
    repeated rows are kept, one result row for each. Other columns are not
    read; an empty table gives no rows.
    """
    kind = F.split_part("template", F.lit(":"), F.lit(1))
    label = F.split_part("template", F.lit(":"), F.lit(2))
    base = kind == "base"
    sorted_labels = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    per_text = spans(docs).groupBy("doc_id", "th", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        sorted_labels(F.when(base, label)).alias("base_labels"), sorted_labels(label).alias("labels"),
        F.coalesce(F.max("score"), F.lit(0.0)).alias("score"), F.max(F.when(F.col("template").isNull(), F.col("copies"))).alias("copies"))
    rows = per_text.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op5_query(docs: DataFrame) -> DataFrame:
    return scan(docs)
