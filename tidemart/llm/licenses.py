"""Licence notices in documents, by MinHash over overlapping windows of text.

Templates are put in classes by length (8, 16, 32, ... words). For each class a document is
cut into windows of twice that length, each starting one length after the one before, so
that a notice lies whole in some window. MinHash values of the shingles of a window, one per
band, meet those of the templates; exact containment of the template's shingles in the
window confirms. The bands of a template are as many as let a full window that holds just the
asked part of it miss them all with a probability of 1e-5 at most, and 32 at least.

SPDX tags name their licence and are read as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import ascii_lower, let, stored, words

# Notices by licence.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the "
            "Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed "
                   "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
                "terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
                  "License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0."),
    ("All-Rights-Reserved", "All rights reserved."),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies "
            "or substantial portions of the Software."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may "
                   "obtain a copy of the License at"),
    ("GPL-2.0", "Released under the GNU General Public License, version 2"),
    ("GPL-2.0", "GNU General Public License as published by the Free Software Foundation; either "
                "version 2 of the License"),
    ("LGPL-2.1", "redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                 "License as published by the Free Software Foundation; either version 2.1 of the "
                 "License"),
    ("LGPL-3.0", "Released under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
            "or without fee is hereby granted"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of "
            "conditions and the following disclaimer"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may "
                     "be used to endorse or promote products derived from this software"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
TEMPLATE_COLUMNS = "license string, text string"


#: Punctuation at the edges of words, and words that tell related licences apart.
_EDGE = ("(?<![^\\x20\\x09-\\x0D])[\\p{Punct}\u2018-\u201d]++"
         "|[\\p{Punct}\u2018-\u201d]++(?![^\\x20\\x09-\\x0D])")
_TELLING = "(^| )gnu( |$)|[0-9]"
_NAME = "\\(*[A-Za-z0-9][A-Za-z0-9.+:-]*\\)*"
_SPDX = (f"(?i)SPDX-License-Identifier:[ \\t]*({_NAME}"
         f"(?:[ \\t]+(?:AND|OR|WITH)[ \\t]+{_NAME})*)")


def bare_words(text: Column) -> Column:
    """Words in lower case (A-Z) without punctuation at their edges."""
    return words(F.regexp_replace(ascii_lower(text), _EDGE, ""))


def spdx_tags(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows like those of ``scan`` for each licence that an SPDX tag names, exceptions (WITH)
    included. A tag counts as one shingle."""
    tags = F.explode(F.regexp_extract_all(F.col(text), F.lit(_SPDX), F.lit(1)))
    parts = F.explode(F.split("tag", "(?i)[ \\t]+(?:AND|OR)[ \\t]+"))
    name = F.regexp_replace("part", "^[(]+|[).:-]+$", "")
    found = docs.select(F.col(key), tags.alias("tag")).select(key, parts.alias("part")).select(
        key, name.alias("license")).distinct()
    return found.select(key, "license", F.xxhash64(F.concat(
        F.lit("spdx-license-identifier "), "license")).alias("template_id"),
        F.lit(1).cast("long").alias("n_shingles"), F.lit(1).cast("long").alias("n_shared"))


def shingles(words: Column, size: int, like: str | None = None) -> Column:
    """64-bit hashes of the runs of ``size`` words, of those that match ``like``; empty if there
    are fewer words."""
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(
        F.array().cast("array<int>"))
    if like:
        starts = F.filter(starts, lambda i: F.array_join(
            F.slice(words, i + 1, F.lit(size)), " ").rlike(like))
    return F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(size))))


def bands_of(n: int, class_: int, size: int, percent: int, least: int, miss: float = 1e-5) -> int:
    """Bands for a template of ``n`` shingles: a full window of its class that holds just the
    asked part misses all with a probability of ``miss`` at most."""
    shared = max(1, math.ceil(n * percent / 100))
    j = shared / (max(0, n - shared) + max(shared, 2 * 2 ** class_ - size + 1))
    return least if j >= 1 else max(least, math.ceil(math.log(miss) / math.log1p(-j)))


def _bands(shingled: str, bands: Column) -> Column:
    """(band, least hash) for each hash function, from an array column."""
    return F.transform(F.sequence(F.lit(0), bands - 1), lambda b: F.struct(
        b.alias("band"), F.array_min(F.transform(F.col(shingled), lambda s: F.xxhash64(s, b))
                                     ).alias("least")))


def _windows(shingled: Column, class_: int, size: int) -> Column:
    """(class, shingles) of each window: 2 * 2**class words, starting each 2**class words."""
    step = 2 ** class_
    last = F.greatest(F.lit(0), F.floor((F.size(shingled) - 1) / step).cast("int"))
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(
        F.lit(class_).alias("class"),
        F.slice(shingled, k * step + 1, F.lit(2 * step - size + 1)).alias("s")))


def scan(docs: DataFrame, templates: DataFrame, percent: int = 80, size: int = 3, bands: int = 32,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, license, template_id, n_shingles, n_shared`` of each document and template of
    which a window holds ``percent`` or more of the distinct shingles.

    ``template_id`` is a hash of the template's words. A-Z is compared in lower case; words
    are split at ASCII white space, punctuation at their edges does not count. Shingles of a
    template with a digit or the word GNU must all be there: they tell versions and relatives
    apart. ``bands`` is the least number of bands. Templates with fewer than ``size`` words, null texts and
    empty texts match nothing. A key has one row per template, from its best window,
    however often its row is repeated; null keys stay. Shingles of all templates together
    are taken to fit a literal (a few thousand); documents with none of them are not cut.
    """
    known = stored(templates.select("license", bare_words(F.col("text")).alias("w"))
                   .distinct().select(
        "license", F.xxhash64(F.array_join("w", " ")).alias("template_id"),
        F.greatest(F.lit(3), F.ceil(F.log2(F.size("w"))).cast("int")).alias("class"),
        F.array_distinct(shingles(F.col("w"), size)).alias("t"),
        F.array_distinct(shingles(F.col("w"), size, _TELLING)).alias("must")).where(
        F.size("t") > 0), "templates")
    sizes = known.select("class", F.size("t").alias("n")).distinct().collect()
    numbers = {(c, n): bands_of(n, c, size, percent, bands) for c, n in sizes}
    classes = sorted({c for c, _ in numbers})

    def number(pairs: dict, *of: Column) -> Column:
        """The number of bands that stands in a dict, by the columns of its keys."""
        return F.coalesce(*(F.when(F.struct(*of) == F.struct(*map(F.lit, k)), F.lit(v))
                            for k, v in pairs.items()), F.lit(bands))

    most = {(c,): max(v for (x, _), v in numbers.items() if x == c) for c in classes}
    vocabulary = F.array(*(F.lit(r["s"]) for r in known.select(
        F.explode("t").alias("s")).distinct().collect())).cast("array<bigint>")

    def cut(shingled: Column) -> Column:
        found = F.flatten(F.array(*(_windows(shingled, c, size) for c in classes)))
        return F.filter(found, lambda x: F.arrays_overlap(x["s"], vocabulary))

    none = F.array().cast("array<struct<class:int,s:array<bigint>>>")
    held = let(bare_words(F.col(text)), lambda w: let(shingles(w, size), lambda s: F.when(
        F.arrays_overlap(s, vocabulary), cut(s)).otherwise(none))) if classes else none
    windows = docs.select(F.col(key).alias("id"), F.explode(held).alias("x")).select(
        "id", F.col("x.class").alias("class"), F.array_distinct("x.s").alias("s")).distinct()
    asked = windows.select("id", "class", "s", F.explode(_bands("s", number(
        most, F.col("class")))).alias("b"))
    ready = known.select("license", "template_id", "class", "t", "must", F.explode(_bands(
        "t", number(numbers, F.col("class"), F.size("t")))).alias("b"))
    met = asked.join(ready, ["class", "b"])
    shared = F.size(F.array_intersect("s", "t"))
    told = F.size(F.array_except("must", "s")) == 0
    return met.where(told & (100 * shared >= percent * F.size("t"))).groupBy(
        "id", "license", "template_id").agg(
        F.max(F.size("t")).cast("long").alias("n_shingles"),
        F.max(shared).cast("long").alias("n_shared")).withColumnRenamed("id", key)
