"""License texts found by diagonal voting between documents and templates.

Words are runs of ASCII digits, letters (A-Z lower-cased) and all other non-ASCII
characters.  Every word ``K``-gram of a document is hashed at its place i and joined
to the places j of the templates with that hash; the words themselves are compared
before the pair counts.  A pair votes for the diagonal i - j of its template: a text
copied without a change lies on one diagonal, an inserted or missing word moves the
rest to a neighbouring one.  Diagonals at most ``BAND`` apart are merged, and a
merged band is verified as a span: it must cover ``MIN_COVER`` of the template's
words, and its covered words must be ``MIN_DENSITY`` of the document's words between
its first and last vote.

A diagonal has each place of its template once, so its set of places is bounded by
the template's length.  The templates are the only broadcast table; a longer list
than ``MAX_TEMPLATE_WORDS`` words is refused.

Base labels come from three phrases whose words stand consecutively; the method adds
those of verified templates.  Null and empty texts have no words, no labels and
score 0.  Rows that repeat an id and text get equal results, as do rows with a null
id.  Rows with equal ids and other texts are judged each on its own.  Extra columns
pass through under their names, except those that the result itself has, which it
replaces; an empty table gives no rows.  Only Spark functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import let, to_table, whole

K = 4
BAND = 3
MIN_COVER = 0.6
MIN_DENSITY = 0.6
MAX_TEMPLATE_WORDS = 200_000

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

#: Phrases of the base labels (fixed values).
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Public license notices (fixed values): label and text.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
               "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
               "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
               "permissions and limitations under the License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met: Redistributions of source code must retain the above copyright "
            "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
            "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
            "documentation and/or other materials provided with the distribution."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
            "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
            "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
            "PURPOSE. See the GNU General Public License for more details."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
            "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
                  "a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]


def license_words(text: Column) -> Column:
    """The words of a text.  ``lower`` also changes other letters than A-Z, but neither
    where words end nor, as none of them becomes a letter of a phrase, the base labels."""
    return F.filter(F.split(F.lower(whole(text)), SEPARATORS), lambda w: w != "")


def _grams(words: Column, k: int) -> Column:
    """Hash of the k words from each place that has as many."""
    def at_all(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.greatest(F.size(h) - (k - 1), F.lit(0))),
                           lambda _, i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
    return let(F.transform(words, lambda w: F.xxhash64(w)), at_all)


def template_grams(spark: SparkSession, templates: list[tuple[str, str]], k: int = K) -> DataFrame:
    """``gram, template, label, size, j, said``: every k-gram of the templates."""
    rows = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)],
                                 "template int, label string, text string")
    rows = rows.withColumn("ws", license_words(F.col("text")))
    return (rows.select("template", "label", "ws", F.size("ws").alias("size"), F.posexplode(_grams(F.col("ws"), k)))
            .select(F.col("col").alias("gram"), "template", "label", "size", F.col("pos").alias("j"),
                    F.slice("ws", F.col("pos") + 1, k).alias("said")))


def _phrase_places(words: Column, parts: list[str], label: str) -> Column:
    def here(w: Column, i: Column) -> Column:
        stands = w == parts[0]
        for j in range(1, len(parts)):
            stands = stands & F.coalesce(F.get(words, i + j) == parts[j], F.lit(False))
        return F.when(stands, F.struct(i.alias("at"), F.lit(label).alias("label")))
    return F.filter(F.transform(words, here), lambda p: p.isNotNull())


def base_places(words: Column, phrases: dict[str, str] = PHRASES) -> Column:
    """Array of ``(at, label)``: the places where a phrase's words stand."""
    none = F.array().cast("array<struct<at:int,label:string>>")
    return F.concat(none, *[
        F.when(F.array_contains(words, p.split()[-1]), _phrase_places(words, p.split(), label)).otherwise(none)
        for p, label in phrases.items()])


def spans(worded: DataFrame, grams: DataFrame, k: int = K) -> DataFrame:
    """Merged bands ``doc_id, _h, label, template, first, last, cover, density`` of the
    documents with words ``_ws``, unverified."""
    votes = (worded.select("doc_id", "_h", "_ws", F.posexplode(_grams(F.col("_ws"), k)).alias("i", "gram"))
             .join(F.broadcast(grams), "gram")
             .where(F.forall(F.zip_with(F.slice("_ws", F.col("i") + 1, k), "said", lambda a, b: a == b), lambda x: x)))
    diagonals = (votes.groupBy("doc_id", "_h", "template", "label", "size", (F.col("i") - F.col("j")).alias("diagonal"))
                 .agg(F.collect_set("j").alias("js")))
    one = ["doc_id", "_h", "template", "label", "size"]
    by_offset = Window.partitionBy(*one).orderBy("diagonal")
    new = F.when(F.col("diagonal") - F.lag("diagonal").over(by_offset) <= BAND, 0).otherwise(1)
    bands = (diagonals.withColumn("_new", new)
             .withColumn("band", F.sum("_new").over(by_offset.rowsBetween(Window.unboundedPreceding, 0))))
    covered = F.array_distinct(F.flatten(F.collect_list(
        F.flatten(F.transform("js", lambda j: F.sequence(j, j + (k - 1)))))))
    in_text = F.array_distinct(F.flatten(F.collect_list(
        F.flatten(F.transform("js", lambda j: F.sequence(j + F.col("diagonal"), j + F.col("diagonal") + (k - 1)))))))
    merged = bands.groupBy(*one, "band").agg(F.size(covered).alias("n"), in_text.alias("at"))
    first, last = F.array_min("at"), F.array_max("at")
    return merged.select("doc_id", "_h", "template", "label", first.alias("first"), last.alias("last"),
                         (F.col("n") / F.col("size")).alias("cover"),
                         (F.size("at") / (last - first + 1)).alias("density"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
         k: int = K) -> DataFrame:
    """``docs`` with ``n_words``, the base counts and labels, ``labels``, ``score`` (the
    best cover of a verified span) and ``spans`` ``(label, first, last, cover)``."""
    if sum(len(t.split()) for _, t in templates) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"more than {MAX_TEMPLATE_WORDS} words of templates: scan them in several lists")
    spark = docs.sparkSession
    text = F.col("text")
    h = F.xxhash64(whole(text))
    verified = (spans(docs.select("doc_id", h.alias("_h"), license_words(text).alias("_ws")),
                      template_grams(spark, templates, k), k)
                .where((F.col("cover") >= MIN_COVER) & (F.col("density") >= MIN_DENSITY)))
    found = to_table(
        verified.groupBy("doc_id", "_h").agg(F.sort_array(F.collect_list(F.struct(
            F.col("first").cast("bigint").alias("first"), F.col("last").cast("bigint").alias("last"), "label", "cover")))
            .alias("spans")), "license-spans")
    own = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    plain = [c for c in docs.columns if c not in own]

    def base(ws: Column) -> Column:
        return F.struct(F.size(ws).cast("bigint").alias("n_words"), base_places(ws, phrases).alias("places"))
    # the caller's columns travel under names of their own, so none can clash
    rows = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(plain)], F.col("doc_id").alias("d"),
                       h.alias("h"), let(license_words(text), base).alias("b"))
    out = rows.join(found, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("_h")), "left")
    at, names = F.col("b.places.at"), F.col("b.places.label")

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    found_labels = F.coalesce(F.col("spans.label"), F.array().cast("array<string>"))
    return out.select(
        *[F.col(f"_{i}").alias(c) for i, c in enumerate(plain)], "b.n_words", F.size(at).cast("bigint").alias("n_base"),
        F.array_min(at).cast("bigint").alias("first_word"), F.array_max(at).cast("bigint").alias("last_word"),
        joined(names).alias("base_labels"), joined(F.concat(names, found_labels)).alias("labels"),
        F.coalesce(F.array_max("spans.cover"), F.lit(0.0)).alias("score"), "spans")
