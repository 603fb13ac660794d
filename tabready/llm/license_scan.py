"""License scan by diagonal voting, in DataFrame functions only.

Words of a text are joined with the template positions on the hash of each
``K`` consecutive words, and compared word by word.  A hit votes for its
diagonal (text position minus template position).  Diagonals are aggregated per
document and template, neighbouring diagonals that overlap are merged to spans,
and a span counts if it covers enough of the template's words and all of its
distinguishing places (``required_places``), so that notices which differ by one
word or by an inserted word get their own label only.  Base phrases are counted
at every place; their labels stand whatever the templates say, so a notice of
the Lesser or Affero license keeps the base phrase's ``gpl``.

Templates are configuration of at most ``MAX_TEMPLATE_WORDS`` words, which
bounds their broadcast.  A row per word leaves the join only where a template
has the same words, so shuffles carry hits and one narrow row per document; a
frequent license line is spread by the documents that hold it.

Defined results: a null or empty text has no words, no labels and score 0;
equal rows (id and text) get equal results, each its own row; further columns
are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabready.llm.common import row_key

K = 3
MAX_TEMPLATE_WORDS = 200_000
#: Share of a template's words that a span must cover; diagonals that merge.
MIN_COVERAGE, SLACK = 0.75, 4
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# License notices, in their own words.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("gpl", "This work is licensed under the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("agpl", "under the terms of the GNU Affero General Public License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("reserved", "All rights reserved"),
]


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased.  ``lower`` changes other letters
    too, which no phrase holds; the two whose lower case starts with an ASCII
    letter (U+0130, U+212A) are put out of its way first."""
    safe = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("к")), F.lit("İ"), F.lit("ı"))
    return F.regexp_extract_all(F.lower(safe), F.lit(f"({WORD})"), F.lit(1))


def template_words(templates: list[tuple[str, str]]) -> list[list[str]]:
    """The words of each template; one too short for a gram is an error."""
    out = [re.findall(WORD, text.lower()) for _, text in templates]
    for (label, text), ws in zip(templates, out):
        if len(ws) < K:
            raise ValueError(f"template of {label} has less than {K} words: {text!r}")
    return out


def required_places(templates: list[tuple[str, str]]) -> list[list[tuple[int, int]]]:
    """For each template the ranges of ``tpos`` of which a span must hold one.

    Distinguishing words are those of the template's own label, and those
    between two words on either side (or one and the template's end) where a
    template of another label has other words, or none (up to ``SLACK``, the
    shorter of the two up to 2).  Each such word must be in the text, next to
    its neighbours in the template."""
    parts = template_words(templates)
    between: dict[tuple[str, ...], set[tuple[str, tuple[str, ...]]]] = {}
    places = []
    for tid, ((label, _), ws) in enumerate(zip(templates, parts)):
        ended = [*ws, ""]
        for i in range(2, len(ws)):
            for j in range(i, min(i + SLACK, len(ws) - 1) + 1):
                key = (*ws[i - 2:i], *ended[j:j + 2])
                between.setdefault(key, set()).add((label, tuple(ws[i:j])))
                places.append((tid, i, j, key))
    needs: list[set[tuple[int, int]]] = [set() for _ in parts]
    for tid, ((label, _), ws) in enumerate(zip(templates, parts)):
        own = set(re.findall(WORD, label.lower()))
        needs[tid] |= {(i, i) for i, w in enumerate(ws) if w in own}
    for tid, i, j, key in places:
        label, middle = templates[tid][0], tuple(parts[tid][i:j])
        if any(other != label and m != middle and min(len(m), len(middle)) <= 2 for other, m in between[key]):
            needs[tid] |= {(p, p + 1) for p in range(i - 1, j)}
    return [sorted({(max(0, b - K + 1), min(a, len(ws) - K)) for a, b in need}) for need, ws in zip(needs, parts)]


def word_grams(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """``tid, label, length, tpos, t0.., gram`` of every template position."""
    rows = []
    for tid, ((label, _), ws) in enumerate(zip(templates, template_words(templates))):
        rows += [(tid, label, len(ws), i, *ws[i:i + K]) for i in range(len(ws) - K + 1)]
    if len(rows) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"at most {MAX_TEMPLATE_WORDS} template words")
    schema = "tid int, label string, length int, tpos int, " + ", ".join(f"t{k} string" for k in range(K))
    return spark.createDataFrame(rows, schema).withColumn("gram", F.xxhash64(*(f"t{k}" for k in range(K))))


def template_hits(docs: DataFrame, templates: list[tuple[str, str]]) -> DataFrame:
    """``row_key, tid, label, length, tpos, pos``: equal words in text and template."""
    rows = docs.select("row_key", words(F.col("text")).alias("w"))
    shifted = [F.col("w")] + [F.slice("w", k + 1, F.greatest(F.size("w") - k, F.lit(0))) for k in range(1, K)]
    grams = rows.where(F.size("w") >= K).select("row_key", F.posexplode(F.arrays_zip(*(c.alias(f"w{k}") for k, c in enumerate(shifted)))).alias("pos", "z"))
    grams = grams.select("row_key", "pos", *(F.col(f"z.w{k}") for k in range(K)))
    grams = grams.withColumn("gram", F.xxhash64(*(f"w{k}" for k in range(K))))
    same = F.col("w0") == F.col("t0")
    for k in range(1, K):
        same &= F.col(f"w{k}") == F.col(f"t{k}")
    table = word_grams(docs.sparkSession, templates)
    return grams.join(F.broadcast(table), "gram").where(same).select("row_key", "tid", "label", "length", "tpos", "pos")


def template_spans(hits: DataFrame, templates: list[tuple[str, str]], min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``row_key, tid, label, first, last, coverage`` of verified spans."""
    votes = (hits.withColumn("diagonal", F.col("pos") - F.col("tpos")).groupBy("row_key", "tid", "label", "length", "diagonal")
             .agg(F.collect_set("tpos").alias("covered"), F.min("pos").alias("first"), F.max("pos").alias("last")))
    order = Window.partitionBy("row_key", "tid").orderBy("first", "diagonal")
    apart = ((F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > SLACK)
             | (F.col("first") > F.lag("last").over(order) + K + SLACK))
    numbered = (votes.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
                .withColumn("span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))))
    spans = (numbered.groupBy("row_key", "tid", "label", "length", "span")
             .agg(F.min("first").alias("first"), (F.max("last") + K).alias("last"), F.flatten(F.collect_list("covered")).alias("at")))
    in_template = F.size(F.array_distinct(F.flatten(F.transform("at", lambda x: F.sequence(x, x + (K - 1))))))
    needs = hits.sparkSession.createDataFrame(list(enumerate(required_places(templates))), "tid int, needs array<struct<lo: int, hi: int>>")
    return (spans.withColumn("coverage", in_template / F.col("length")).where(F.col("coverage") >= min_coverage)
            .join(F.broadcast(needs), "tid")
            .where(F.forall("needs", lambda r: F.exists("at", lambda x: x.between(r["lo"], r["hi"]))))
            .select("row_key", "tid", "label", "first", "last", "coverage"))


def phrase_places(text: Column, w: Column, phrases: dict[str, str]) -> list[tuple[str, Column]]:
    """For each label the word positions at which its phrase stands.  Only
    texts in which the phrase's words follow each other are looked through."""
    def places(parts: list[str]) -> Column:
        def place(x, i):
            hit = x == F.lit(parts[0])
            for k in range(1, len(parts)):
                hit &= F.get(w, i + k) == F.lit(parts[k])
            return F.when(hit, i.cast("long"))

        return F.filter(F.transform(w, place), lambda x: x.isNotNull())

    out = []
    for phrase, label in phrases.items():
        parts = phrase.split()
        may = F.coalesce(text.rlike("(?i)" + f"{SEPARATOR}+".join(parts)), F.lit(False))
        out.append((label, F.when(may, places(parts)).otherwise(F.array().cast("array<bigint>"))))
    return out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None,
                  templates: list[tuple[str, str]] | None = None, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans``, one row per input row; ``score`` is the best coverage."""
    phrases, templates = phrases or PHRASES, templates or TEMPLATES
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), row_key(id_col, text_col))
    found = (template_spans(template_hits(rows, templates), templates, min_coverage).groupBy("row_key")
             .agg(F.collect_set("label").alias("found"), F.max("coverage").alias("score"),
                  F.sort_array(F.collect_list(F.struct("first", "last", "label", "coverage"))).alias("spans")))
    w = F.col("w")
    places = phrase_places(F.col("text"), w, phrases)
    base = (rows.withColumn("w", words(F.col("text")))
            .select("doc_id", "row_key", F.size(w).cast("long").alias("n_words"),
                    *(p.alias(f"places_{k}") for k, (_, p) in enumerate(places))))
    each = [F.col(f"places_{k}") for k in range(len(places))]
    base = base.select("doc_id", "row_key", "n_words", F.concat(*each).alias("at"),
                       F.array_distinct(F.filter(F.array(*(F.when(F.size(c) > 0, F.lit(label)) for c, (label, _) in zip(each, places))),
                                                 lambda x: x.isNotNull())).alias("base"))
    labels = F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>"))))
    return base.join(found, "row_key", "left").select(
        "doc_id", "n_words", F.size("at").cast("long").alias("n_base"), F.array_min("at").alias("first_word"),
        F.array_max("at").alias("last_word"), F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"), "spans")
