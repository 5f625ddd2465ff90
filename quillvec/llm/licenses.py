"""License scan by MinHash over overlapping windows of text, in DataFrame operations only.

1. A text is a sequence of words in lower case. A window is ``SHINGLES`` neighbouring shingles of three words, and a
   new one begins every ``HOP`` words; so a template of ``SHINGLES - HOP + 1`` shingles or fewer, wherever it
   stands, lies whole within one window.
2. A band is the smallest of a window's shingle hashes after a fixed permutation, the exclusive or with a constant. A
   window that holds a template of half its shingles agrees with it in a band with probability 1/2, and in at least one of the
   ``BANDS`` with 1 - 2**-10; longer templates have several windows that agree in every band.
3. Windows are joined with the windows of templates by band and value.
4. Shingles of the text around a match are compared themselves. A template is found if the text holds 80 percent of
   its shingles there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillvec.llm.tables import LAST, Scratch
from quillvec.storage import sized

SHINGLE = 3
SHINGLES, HOP, BANDS = 6, 3, 10
PERCENT = 80
#: Notices of usual licenses, in part.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """``template, license, text``: a number for each notice."""
    return spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)],
                                 "template int, license string, text string")


def words_of(text: Column) -> Column:
    """Runs of letters and digits in lower case. The first or last is empty if something else begins or ends the text."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")


def permutation(band: int) -> int:
    """A fixed 64-bit number for each band: the golden ratio's multiples, which lie far apart."""
    value = (band + 1) * 0x9E3779B97F4A7C15 % 2**64
    return value - 2**64 if value >= 2**63 else value


def _bands(df: DataFrame, keys: list[str], words: Column, hop: int) -> DataFrame:
    """``keys, place, band, value`` for the windows that begin every ``hop`` words. The last windows of a text are
    shorter; one without a whole shingle has no bands."""
    span = SHINGLES + SHINGLE - 1
    codes = df.select(*keys, F.transform(words, lambda w: F.xxhash64(w)).alias("codes"))
    parts = ["codes", *[f"slice(codes, {j + 1}, greatest(0, size(codes) - {j}))" for j in range(1, span)]]
    rows = codes.selectExpr(*keys, f"posexplode(arrays_zip({', '.join(parts)})) AS (place, w)") \
        .filter(f"place % {hop} = 0").selectExpr(
            *keys, "place", *[f"w.`{j}` AS w{j}" if j else "w.codes AS w0" for j in range(span)]) \
        .filter(f"w{SHINGLE - 1} IS NOT NULL")
    hashed = rows.selectExpr(*keys, "place", *[
        f"IF(w{j + SHINGLE - 1} IS NULL, NULL, xxhash64({', '.join(f'w{j + i}' for i in range(SHINGLE))})) AS s{j}"
        for j in range(SHINGLES)])
    # least() passes over NULL.
    bands = [f"struct({b} AS band, least({', '.join(f's{j} ^ {permutation(b)}L' for j in range(SHINGLES))}) AS value)"
             for b in range(BANDS)]
    return hashed.selectExpr(*keys, "place", f"inline(array({', '.join(bands)}))")


def _shingles(words: Column, size: int = SHINGLE) -> Column:
    """Distinct shingles as text."""
    return F.when(F.size(words) >= size, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size(words) - size + 1), lambda i: F.array_join(F.slice(words, i, size), " ")))) \
        .otherwise(F.array().cast("array<string>"))


def found_licenses(docs: DataFrame, templates: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row for each document and notice of ``templates`` (``template, license, text``) that it holds.

    Returns ``doc_id, template, license, start`` (about the word where the notice begins), ``n_shingles`` of the
    notice, ``n_found`` and ``containment``. Of several places the one with most shingles counts, and of equal ones the first.

    NULL and empty texts hold nothing, and notices of fewer than three words are never found. A NULL ``doc_id`` comes
    back as NULL; rows with one id and one text give one result. Other columns are left out; empty tables give no rows.
    """
    scratch = Scratch(docs.sparkSession, "licenses")
    source = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"),
                         F.xxhash64(F.coalesce("text", F.lit(""))).alias("sub"), "text")
    notices = scratch.keep(templates.select("template", "license", F.array_remove(words_of(F.col("text")), "")
                                            .alias("words")).filter(f"size(words) >= {SHINGLE}"), "notices")
    wanted = scratch.keep(_bands(notices, ["template"], F.col("words"), 1)
                          .groupBy("band", "value", "template").agg(F.min("place").alias("at")), "wanted")
    found = _bands(source, ["id", "sub"], words_of(F.col("text")), HOP).join(sized(wanted), ["band", "value"])
    places = scratch.keep(found.groupBy("id", "sub", "template", (F.col("place") - F.col("at")).alias("start"))
                          .agg(F.count("*").alias("bands")), "places")
    # Words of the text around the place, wide enough for the notice and the distance between windows.
    texts = source.dropDuplicates(["id", "sub"]).join(places, ["id", "sub"]) \
        .select("id", "sub", "template", "start", words_of(F.col("text")).alias("there")).join(notices, "template")
    slack = SHINGLES + HOP
    around = F.expr(f"slice(there, greatest(0, start - {slack}) + 1, size(words) + {2 * slack})")
    judged = texts.select("id", "template", "license", F.greatest("start", F.lit(0)).alias("start"),
                          _shingles(F.col("words")).alias("notice"), _shingles(around).alias("around")) \
        .select("id", "template", "license", "start", F.size("notice").alias("n_shingles"),
                F.size(F.array_intersect("notice", "around")).alias("n_found"))
    best = judged.filter(f"100 * n_found >= {percent} * n_shingles").groupBy("id", "template", "license").agg(
        F.min(F.struct((-F.col("n_found")).alias("m"), "start", "n_shingles")).alias("b"))
    return best.select(F.when(F.col("id") != LAST, F.col("id")).alias("doc_id"), "template", "license",
                       F.col("b.start").cast("long").alias("start"), F.col("b.n_shingles").cast("long").alias("n_shingles"),
                       (-F.col("b.m")).cast("long").alias("n_found"),
                       F.round(-F.col("b.m") / F.col("b.n_shingles"), 6).alias("containment"))
