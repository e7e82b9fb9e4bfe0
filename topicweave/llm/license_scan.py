"""License scans by diagonal voting (native: DataFrame operations only).

Every k-word window of every text is hashed and joined with the windows of
the license templates.  A hit at text word p and template word q votes for
diagonal p - q; votes are summed by (document, template, diagonal),
neighbouring diagonals (a word more or less in between) are merged, and a
merged span counts when it holds enough of its template's windows within the
template's length; one changed word is forgiven in a notice of six windows or
more.  Words that begin with a digit are compared as 0, so a license's version
does not matter.  The join compares the words themselves as well as the hash.

Defined cases: null and empty texts have no words, no label and score 0;
repeated rows give the same result each; a table without rows gives none;
other columns are ignored.  Templates are a parameter; their windows are the
broadcast side, which the caller's template list bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicweave.llm.common import read_table, stage_table, text_or_empty

# --- fixed values: base phrases and their labels -----------------------------
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# --- fixed values: notices and texts of public licenses, words as compared -----
# A word that begins with a digit is written 0: versions and years do not matter.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 0 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license version 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license"),
    ("mpl", "subject to the terms of the mozilla public license v 0 0"),
    ("mpl", "mozilla public license version 0 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("epl", "made available under the terms of the eclipse public license"),
    ("cc0", "cc0 0 0 universal"),
    ("cc0", "waived all copyright and related or neighboring rights to this work"),
    ("cc0", "creative commons zero v0"),
    ("cc0", "creative commons cc0"),
    ("cc0", "licensed under cc0"),
    ("cc-by-nc-nd", "cc by nc nd 0 0"),
    ("cc-by-nc-nd", "creative commons attribution noncommercial noderivatives"),
    ("cc-by-nc-sa", "cc by nc sa 0 0"),
    ("cc-by-nc-sa", "creative commons attribution noncommercial sharealike"),
    ("cc-by-nc", "cc by nc 0 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 0 0"),
    ("cc-by-nd", "cc by nd 0 0"),
    ("cc-by-nd", "creative commons attribution noderivatives"),
    ("cc-by-sa", "cc by sa 0 0"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc-by", "cc by 0 0"),
    ("cc-by", "creative commons attribution 0 0"),
    ("reserved", "all rights reserved"),
)
# whole notices, clauses and identifier lines
TEXTS = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software"
        " to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense"
        " and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"
        " the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"
        " the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"
        " fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other"
        " liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    ),
    ("mit", "spdx license identifier mit"),
    (
        "apache",
        "licensed under the apache license version 0 0 the license you may not use this file except in compliance with the license"
        " you may obtain a copy of the license at http www apache org licenses license 0 0 unless required by applicable law or agreed to in writing"
        " software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"
        " see the license for the specific language governing permissions and limitations under the license",
    ),
    ("apache", "spdx license identifier apache 0 0"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by"
        " the free software foundation either version 0 of the license or at your option any later version this program is distributed in the hope"
        " that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"
        " see the gnu general public license for more details",
    ),
    ("gpl", "spdx license identifier gpl 0 0"),
    ("lgpl", "spdx license identifier lgpl 0 0"),
    ("agpl", "spdx license identifier agpl 0 0"),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 0 0 if a copy of the mpl was not distributed with this file"
        " you can obtain one at",
    ),
    ("mpl", "spdx license identifier mpl 0 0"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    (
        "bsd",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"
        " in the documentation and or other materials provided with the distribution",
    ),
    (
        "bsd",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"
        " without specific prior written permission",
    ),
    ("bsd", "spdx license identifier bsd 0 clause"),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above"
        " copyright notice and this permission notice appear in all copies",
    ),
    ("isc", "spdx license identifier isc"),
    ("unlicense", "spdx license identifier unlicense"),
    ("epl", "spdx license identifier epl 0 0"),
    ("cc0", "spdx license identifier cc0"),
)
ALL_TEMPLATES = TEMPLATES + TEXTS
# ------------------------------------------------------------------------------
K = 3
MERGE_GAP = 2  # neighbouring diagonals: at most so many words more or less
MIN_COVER = 0.75  # of a template's windows
SHORT = 6  # windows of a notice in which one changed word, so K windows, is forgiven
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_list(text: Column) -> Column:
    """The words, lower case: runs of digits, letters and non-ASCII characters.

    Upper-case non-ASCII letters change too; no phrase or template has one.
    """
    return F.array_remove(F.split(F.lower(text), SEPARATOR), "")


def compared(words: Column) -> Column:
    """The words as templates are compared: one that begins with a digit is 0."""
    return F.transform(words, lambda w: F.when(w.between("0", "9~"), F.lit("0")).otherwise(w))


def windows_needed(n_grams: Column, min_cover: float = MIN_COVER, k: int = K) -> Column:
    """Windows of a template that a span must hold: ``min_cover`` of them, or
    all but the ``k`` that one changed word breaks where that is fewer; a notice
    of fewer than ``SHORT`` windows is held whole."""
    share = F.ceil(n_grams * min_cover)
    return F.when(n_grams < SHORT, n_grams.cast("long")).otherwise(F.least(share, (n_grams - k).cast("long")))


def template_windows(spark: SparkSession, templates: Sequence[tuple[str, str]], k: int = K) -> DataFrame:
    """t_id, label, t_at, n_grams, t_words, g0.., one row per window."""
    rows = []
    for t, (label, text) in enumerate(templates):
        w = text.split()
        n = len(w) - k + 1
        rows += [(t, label, q, n, len(w), *w[q : q + k]) for q in range(n)]
    cols = ", ".join(f"g{j} string" for j in range(k))
    table = spark.createDataFrame(rows, f"t_id int, label string, t_at int, n_grams int, t_words int, {cols}")
    return table.withColumn("t_hash", F.xxhash64(*[f"g{j}" for j in range(k)]))


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def window_hits(docs: DataFrame, templates: Sequence[tuple[str, str]] = ALL_TEMPLATES, k: int = K) -> DataFrame:
    """doc_id, text_key, t_id, label, n_grams, t_words, at, t_at."""
    words = _keyed(docs).select("doc_id", "text_key", compared(word_list(F.col("text"))).alias("w"))
    shifted = [F.col("w")] + [F.slice("w", F.lit(j + 1), F.greatest(F.size("w") - j, F.lit(0))) for j in range(1, k)]
    zipped = words.where(F.size("w") >= k).select(
        "doc_id", "text_key", F.posexplode(F.arrays_zip(*[c.alias(f"w{j}") for j, c in enumerate(shifted)])).alias("at", "g")
    )
    grams = zipped.select("doc_id", "text_key", "at", *[F.col(f"g.w{j}").alias(f"w{j}") for j in range(k)]).where(f"w{k - 1} is not null")
    grams = grams.withColumn("hash", F.xxhash64(*[f"w{j}" for j in range(k)]))
    known = template_windows(docs.sparkSession, templates, k)
    same = grams["hash"] == known["t_hash"]
    for j in range(k):
        same = same & (grams[f"w{j}"] == known[f"g{j}"])
    # The template table has one row per window of the caller's list.
    return grams.join(F.broadcast(known), same).select("doc_id", "text_key", "t_id", "label", "n_grams", "t_words", "at", "t_at")


def license_spans(docs: DataFrame, templates: Sequence[tuple[str, str]] = ALL_TEMPLATES, k: int = K, gap: int = MERGE_GAP, min_cover: float = MIN_COVER) -> DataFrame:
    """Verified spans: doc_id, text_key, label, t_id, first_word, n_span_words, cover."""
    hits = window_hits(docs, templates, k).distinct()  # repeated rows vote once
    place = ["doc_id", "text_key", "t_id"]
    diagonals = hits.groupBy(*place, "label", "n_grams", "t_words", (F.col("at") - F.col("t_at")).alias("diagonal")).agg(
        F.collect_set("t_at").alias("votes"), F.min("at").alias("first"), F.max("at").alias("last")
    )
    along = Window.partitionBy(*place).orderBy("diagonal")
    started = (F.col("diagonal") - F.lag("diagonal").over(along) > gap).cast("int")
    merged = (
        diagonals.withColumn("cluster", F.sum(F.coalesce(started, F.lit(0))).over(along))
        .groupBy(*place, "label", "n_grams", "t_words", "cluster")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("votes"))).alias("votes"),
            F.min("first").alias("first_word"),
            (F.max("last") - F.min("first") + k).alias("n_span_words"),
        )
        .withColumn("cover", F.size("votes") / F.col("n_grams"))
    )
    fits = F.col("n_span_words") <= F.col("t_words") + 2 * F.lit(gap)
    enough = F.size("votes") >= windows_needed(F.col("n_grams"), min_cover, k)
    return merged.where(enough & fits).select(
        "doc_id", "text_key", "label", "t_id", "first_word", "n_span_words", "cover"
    )


def phrase_places(words: Column, phrase: str) -> Column:
    """Word numbers at which the phrase's words stand consecutively."""
    parts = phrase.split()
    last = F.size(words) - len(parts)

    def here(i):
        hit = F.get(words, i) == parts[0]
        for j, part in enumerate(parts[1:], 1):
            hit = hit & (F.get(words, i + j) == part)
        return hit

    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here)).otherwise(F.array().cast("array<int>"))


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]] = ALL_TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES) -> DataFrame:
    """One row per document: base phrases, the method's labels, score."""
    found = license_spans(docs, templates).groupBy("doc_id", "text_key").agg(
        F.collect_set("label").alias("own"), F.max("cover").alias("cover")
    )
    found = stage_table(found, "license-labels").select(F.col("doc_id").alias("f_id"), F.col("text_key").alias("f_key"), "own", "cover")
    words = _keyed(docs).select(
        "doc_id",
        "text_key",
        F.col("text").rlike("(?i)" + "|".join(p.split()[-1] for p, _ in phrases)).alias("maybe"),
        word_list(F.col("text")).alias("w"),
    )
    none = F.array().cast("array<int>")
    places = [F.when(F.col("maybe"), phrase_places(F.col("w"), p)).otherwise(none) for p, _ in phrases]
    at = words.select("doc_id", "text_key", F.size("w").cast("long").alias("n_words"), *[c.alias(f"p{i}") for i, c in enumerate(places)])
    every = F.flatten(F.array(*[f"p{i}" for i in range(len(phrases))]))
    labels = F.array_sort(
        F.array_distinct(
            F.array_compact(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(phrases)]))
        )
    )
    base = at.select("doc_id", "text_key", "n_words", every.alias("every"), labels.alias("base"))
    own = F.coalesce(F.col("own"), F.array().cast("array<string>"))
    same = base["doc_id"].eqNullSafe(found["f_id"]) & (base["text_key"] == found["f_key"])
    return base.join(found, same, "left").select(
        "doc_id",
        "n_words",
        F.size("every").cast("long").alias("n_base"),
        F.array_min("every").cast("long").alias("first_word"),
        F.array_max("every").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", own)), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
    )


def op10_diagonal_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))
