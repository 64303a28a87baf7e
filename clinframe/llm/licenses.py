"""License scan: MinHash bands over overlapping word windows, then exact shingle containment.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, text_key

SHINGLE, WINDOW, STRIDE, BANDS = 5, 6, 2, 14
#: Template keys are sent to every task up to so many rows (16 bytes each); beyond, the join shuffles.
MAX_BROADCAST = 500_000

# Texts of public license notices (fixed values).
TEMPLATES = [
    ("All-rights-reserved", "All rights reserved."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
     "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
     "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
     "See the License for the specific language governing permissions and limitations under the License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
     "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
     "copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
     "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
     "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
     "You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def _words(text: Column) -> Column:
    """Hashes of the words: lower case, letters and digits."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.transform(F.filter(F.split(plain, " "), lambda w: w != ""), lambda w: F.xxhash64(w))


def _run(names: list[str]) -> Column:
    """Hash of consecutive words; null past the end of the text."""
    return F.when(F.col(names[-1]).isNotNull(), F.xxhash64(F.lit(len(names)), *names))


def _shingles(df: DataFrame, keys: list[str], short: list[int]) -> DataFrame:
    """One row per word position: the five-word shingle and the shorter runs that start there."""
    at = df.select(*keys, "w", F.explode(F.sequence(F.lit(0), F.size("w") - 1)).alias("at"))
    at = at.select(*keys, *[F.get("w", F.col("at") + i).alias(f"w{i}") for i in range(SHINGLE)])
    runs = [_run([f"w{i}" for i in range(n)]) for n in [SHINGLE, *short]]
    return at.select(*keys, F.explode(F.array(*runs)).alias("shingle")).filter("shingle is not null")


def _band_keys(df: DataFrame, keys: list[str], stride: int, short: list[int]) -> DataFrame:
    """One row per window and band: MinHash of the window's shingles; runs of the short lengths are keys of their own."""
    at = df.select(*keys, "w", F.explode(F.sequence(F.lit(0), F.size("w") - 1, F.lit(stride))).alias("at"))
    at = at.select(*keys, *[F.get("w", F.col("at") + i).alias(f"w{i}") for i in range(WINDOW)])
    starts = range(WINDOW - SHINGLE + 1)
    runs = [_run([f"w{i + k}" for k in range(SHINGLE)]).alias(f"s{i}") for i in starts]
    small = [_run([f"w{i + k}" for k in range(n)]) for n in short for i in range(stride)]
    at = at.select(*keys, *runs, *[c.alias(f"r{i}") for i, c in enumerate(small)])
    offer = lambda b, i: F.when(F.col(f"s{i}").isNotNull(), F.xxhash64(F.lit(b), f"s{i}"))
    mins = [F.least(*[offer(b, i) for i in starts]) for b in range(BANDS)]
    at = at.select(*keys, F.explode(F.array(*mins, *[F.col(f"r{i}") for i in range(len(small))])).alias("band_key"))
    return at.filter("band_key is not null")


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(license, text) rows of a list of templates."""
    rows = F.array(*[F.struct(F.lit(n).alias("license"), F.lit(t).alias("text")) for n, t in templates])
    return spark.range(1).select(F.inline(rows))


def scan(docs: DataFrame, templates: DataFrame | None = None, percent: int = 80,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, n_found, n_template, containment): templates that documents hold.

    A template is found if the document holds at least ``percent`` % of its
    distinct five-word shingles (a template of fewer words is one shingle).

    Windows of WINDOW words start at every STRIDE-th word, so every shingle of
    the text is in a window, with at most one other.  Each of BANDS bands is one
    MinHash value of the window; a template's windows start at every word, and
    its single shingles count as windows too, for windows that begin or end
    inside it.  A window that holds a template shingle meets one of its keys
    with probability at least 1 - 2^-14, and a template of n shingles has n such
    windows.  Shorter templates are retrieved by the hash of their whole run.
    The candidate documents are then read again, and containment is counted on
    the full shingle sets.

    Template keys are small and broadcast below MAX_BROADCAST rows, else
    joined by shuffle.  Only (document, license) candidates are shuffled.
    Null, empty and blank texts hold nothing; rows equal in id and text give
    one result; other columns are ignored.
    """
    spark = docs.sparkSession
    templates = template_table(spark) if templates is None else templates
    tpl = cut(templates.select("license", _words(F.col("text")).alias("w")).filter(F.size("w") > 0).distinct(), "templates")
    short = sorted(r[0] for r in tpl.filter(F.size("w") < SHINGLE).select(F.size("w")).distinct().collect())  # four lengths at most
    of = lambda n: F.size("w") == n
    parts = [_shingles(tpl.filter(F.size("w") >= SHINGLE), ["license"], [])] + [
        tpl.filter(of(n)).select("license", F.xxhash64(F.lit(n), *[F.get("w", F.lit(i)) for i in range(n)]).alias("shingle")) for n in short]
    tsh = parts[0]
    for p in parts[1:]:
        tsh = tsh.unionAll(p)
    tsh = cut(tsh.distinct(), "template-shingles")
    single = tsh.select("license", F.explode(F.array(F.col("shingle"), *[F.xxhash64(F.lit(b), "shingle") for b in range(BANDS)])).alias("band_key"))
    tkeys = cut(_band_keys(tpl, ["license"], 1, []).unionAll(single).distinct(), "template-keys")
    small = F.broadcast if tkeys.count() <= MAX_BROADCAST else (lambda df: df)

    words = docs.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("tkey"), _words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    found = _band_keys(words, ["doc_id", "tkey"], STRIDE, short).join(small(tkeys), "band_key")
    candidates = cut(found.select("doc_id", "tkey", "license").distinct(), "candidates")

    hit = candidates.select(F.col("doc_id").alias("__id"), F.col("tkey").alias("__key")).distinct()
    read = docs.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("tkey"), F.col(text_col).alias("text"))
    read = read.join(hit, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("tkey") == F.col("__key")), "left_semi")
    held = (_shingles(read.select("doc_id", "tkey", _words(F.col("text")).alias("w")), ["doc_id", "tkey"], short)
            .join(small(tsh), "shingle").groupBy("doc_id", "tkey", "license").agg(F.count_distinct("shingle").alias("n_found")))
    same = candidates.select(F.col("doc_id").alias("__id"), F.col("tkey").alias("__key"), F.col("license").alias("__license"))
    held = held.join(same, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("tkey") == F.col("__key")) & (F.col("license") == F.col("__license")))
    sizes = tsh.groupBy("license").agg(F.count("*").alias("n_template"))
    return (held.join(sizes, "license").filter(100 * F.col("n_found") >= percent * F.col("n_template"))
            .select("doc_id", "license", "n_found", "n_template", (F.col("n_found") / F.col("n_template")).alias("containment")).distinct())
