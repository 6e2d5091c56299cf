"""License scans by diagonal voting, with DataFrame functions only.

Every rolling k-word gram of a text meets the grams of the license templates in a join. A match at word d of the text
and word t of a template votes for the diagonal d - t; a copied passage puts all its votes on one diagonal, and each
word put in or left out moves the rest to a neighbouring one. Votes are summed per diagonal, neighbouring diagonals are
merged into spans, and a span is verified word by word: every vote's words are compared with the template's, and the
share of the template that is covered is its score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from courtside.session import settle

GRAM = 3
# diagonals this far apart belong to one span
SHIFT = 4
# share of a template's grams that a span must hold
COVERED = 0.6

# Phrases that are labels by contract.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Published notices and clauses, by label.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
            "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
            "Software."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
               "See the License for the specific language governing permissions and limitations under the License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
            "list of conditions and the following disclaimer."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
            "not distributed with this file, You can obtain one at"),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)


def words_of(text: Column) -> Column:
    """Array of the words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a text in lower-case A-Z; null has none.

    ``lower`` is much cheaper than replacing letter by letter. It also changes letters beyond A-Z, which no phrase or
    template holds; the Kelvin sign alone would become an ASCII letter and is replaced before.
    """
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u00e5")))
    parts = F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    # only the first and the last part can be empty
    return F.array_remove(parts, "")


def _gram(words: Column, at: Column, k: int) -> Column:
    """Hash of the k words from a place on; null where they run out."""
    parts = [F.get(words, at + i) for i in range(k)]
    return F.when(parts[-1].isNotNull(), F.xxhash64(*parts))


def template_grams(spark: SparkSession, templates=TEMPLATES, k: int = GRAM) -> DataFrame:
    """``template, t, gram, t_words``, one row per rolling gram: as many as the templates have words."""
    rows = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(templates)], "template int, text string")
    listed = rows.select("template", words_of(F.col("text")).alias("w")).select(
        "template", "w", F.explode(F.sequence(F.lit(0), F.size("w") - k)).alias("t")
    )
    return listed.select("template", "t", _gram(F.col("w"), F.col("t"), k).alias("gram"), F.slice("w", F.col("t") + 1, k).alias("t_words"))


def scan_licenses(
    documents: DataFrame, templates=TEMPLATES, phrases: dict[str, str] = PHRASES, k: int = GRAM, shift: int = SHIFT,
    covered: float = COVERED,
) -> tuple[DataFrame, DataFrame]:
    """Texts and spans.

    Texts: ``doc_id, print, n_words, n_base, first_word, last_word, base_labels`` (labels as a sorted array), one row per
    row of ``documents``. Spans: ``doc_id, print, label, template, first_word, last_word, covered``, one row per verified
    span. ``print`` tells rows that share an id apart.

    Only ``doc_id`` and ``text`` are read; other columns, whatever their names, play no part. Null and empty texts have no
    words; long texts are scanned whole; repeated rows give equal rows of texts and share their spans; an empty table
    gives empty results.
    """
    spark = documents.sparkSession
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("print"), words_of(F.col("text")).alias("w"))
    # the leading empty word gives every text one row of its own; no phrase or gram begins with it
    at = read.select(
        "doc_id", "print", F.size("w").alias("n_words"), F.concat(F.array(F.lit("")), "w").alias("w")
    ).select("doc_id", "print", "n_words", "w", F.posexplode("w").alias("pos", "word"))
    base = None
    for phrase, label in phrases.items():
        parts = phrase.split(" ")
        found = F.col("word") == parts[0]
        for i, part in enumerate(parts[1:], 1):
            found = found & (F.get("w", F.col("pos") + i) == part)
        base = F.when(found, label) if base is None else base.when(found, label)
    # as many rows as the templates have words: a constant
    grams = F.broadcast(template_grams(spark, templates, k))
    hits = settle(
        at.withColumn("base", base)
        .withColumn("gram", F.when(F.col("pos") > 0, _gram(F.col("w"), F.col("pos"), k)))
        .join(grams, "gram", "left")
        .where("pos = 0 or base is not null or template is not null")
        # a vote counts if its words are the template's
        .withColumn("vote", F.slice("w", F.col("pos") + 1, k) == F.col("t_words"))
        .select("doc_id", "print", "n_words", (F.col("pos") - 1).alias("d"), "base", F.when(F.col("vote"), F.col("template")).alias("template"), "t"),
        "hits",
    )
    key = ["doc_id", "print"]
    # repeated rows repeat their hits; each place counts once
    phrases_at = hits.where("base is not null").select(*key, "d", "base").distinct()
    found = phrases_at.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_base"), F.min("d").cast("long").alias("first_word"), F.max("d").cast("long").alias("last_word"),
        F.array_sort(F.collect_set("base")).alias("base_labels"),
    )
    texts = _beside(hits.where("d = -1").select(*key, F.col("n_words").cast("long").alias("n_words")), found, key)
    return texts, _spans(spark, hits.where("template is not null").select(*key, "template", "d", "t").distinct(), templates, k, shift, covered)


def _spans(spark: SparkSession, votes: DataFrame, templates, k: int, shift: int, covered: float) -> DataFrame:
    key = ["doc_id", "print", "template"]
    diagonals = votes.groupBy(*key, (F.col("d") - F.col("t")).alias("diagonal")).agg(
        F.min("d").alias("d0"), F.max("d").alias("d1"), F.collect_set("t").alias("places")
    )
    order = Window.partitionBy(*key).orderBy("diagonal")
    starts = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > shift, F.lit(True))
    spans = (
        diagonals.withColumn("starts", starts.cast("int"))
        .withColumn("span", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*key, "span")
        .agg(F.min("d0").alias("d0"), F.max("d1").alias("d1"), F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
    )
    about = spark.createDataFrame([(i, label) for i, (label, _) in enumerate(templates)], "template int, label string").join(
        template_grams(spark, templates, k).groupBy("template").agg(F.count(F.lit(1)).alias("grams")), "template"
    )
    share = F.size("places") / F.col("grams")
    return (
        spans.join(F.broadcast(about), "template")
        .withColumn("covered", share)
        .where(F.col("covered") >= covered)
        .select("doc_id", "print", "label", "template", F.col("d0").cast("long").alias("first_word"), (F.col("d1") + k - 1).cast("long").alias("last_word"), "covered")
    )


def _beside(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Left join in which null ids meet each other."""
    right = right.withColumnsRenamed({c: f"_{c}" for c in key})
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    return left.join(right, on, "left").drop(*[f"_{c}" for c in key])


def license_labels(documents: DataFrame, **options) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``, one row per row of ``documents``.

    ``labels`` holds the base labels and those of verified spans, sorted and joined by commas; ``score`` is the largest
    covered share of a template, 1 where a base phrase stands, 0 without any label. See ``scan_licenses`` for nulls, empty
    and long texts and repeated rows; a null ``doc_id`` keeps its row.
    """
    texts, spans = scan_licenses(documents, **options)
    best = spans.groupBy("doc_id", "print").agg(F.array_sort(F.collect_set("label")).alias("more"), F.max("covered").alias("best"))
    none = F.array().cast("array<string>")
    base = F.coalesce("base_labels", none)
    n_base = F.coalesce("n_base", F.lit(0)).cast("long")
    return _beside(texts, best, ["doc_id", "print"]).select(
        "doc_id", "n_words", n_base.alias("n_base"), "first_word", "last_word", F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("more", none))), ",").alias("labels"),
        F.when(n_base > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
