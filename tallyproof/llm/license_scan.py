"""License texts by MinHash bands over overlapping text windows.

Documents are read in windows of WINDOW words that start every STRIDE words; each five-word shingle lies in one
window. Templates are read in windows that start at every word. Each window's MinHash signature is cut into
BANDS bands of one row. A document window inside a longer template equals some template window, so every band
collides; the least similar case is a template of five words, one of the four shingles of its window, and then
the chance that no band collides is 0.75 ** BANDS, 0.001. Retrieved templates are verified by exact containment: the
share of the template's shingles found in the text around the window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.llm.common import set_aside, settled, within_bound
from tallyproof.llm.phrase_index import words_of

SHINGLE, WINDOW, STRIDE, BANDS = 5, 8, 4, 24

# Fixed values. A license is named by words that no other license listed has: as ``least`` is below 1, a template that
# tells versions or relatives apart is so short that another version's or name's words leave too few of its shingles.
# GPL and BSD without a number are notices that several versions share.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "GNU General Public License, version 3"),
    ("GPL", "under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("MPL-2.0", "terms of the Mozilla Public License, v. 2.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Proprietary", "All rights reserved. No part of this work may be reproduced without written permission."),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-2.0", "GNU General Public License v2"),
    ("GPL-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or"),
    ("GPL-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, version 2 of the License"),
    ("GPL-3.0", "GNU General Public License v3"),
    ("GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or"),
    ("GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, version 3 of the License"),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-2.1", "GNU Lesser General Public License v2.1"),
    ("LGPL-2.1", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or"),
    ("LGPL-2.1", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, version 2.1 of the License"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", "GNU Lesser General Public License v3"),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or"),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, version 3 of the License"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("AGPL-3.0", "GNU Affero General Public License v3"),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or"),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3 of the License"),
    ("BSD-2-Clause", "or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS"),
    ("BSD-3-Clause", "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSD-4-Clause", "All advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("BSL-1.0", "Boost Software License, Version 1.0"),
    ("EPL-2.0", "Eclipse Public License v. 2.0"),
    ("EPL-2.0", "Eclipse Public License v2.0"),
    ("EPL-2.0", "Eclipse Public License, version 2.0"),
]


def default_templates(spark: SparkSession) -> DataFrame:
    """(template_id, license, text)."""
    return spark.createDataFrame([(k, name, text) for k, (name, text) in enumerate(TEMPLATES)], "template_id int, license string, text string")


def _bands(windows: DataFrame, keep: list[str]) -> DataFrame:
    """One row per band of each window (``w``: its words): the least of its shingles' hashes under that band's function."""
    per_shingle = [
        f"CASE WHEN size(w) >= {k + SHINGLE} THEN xxhash64({', '.join(f'w[{k + j}]' for j in range(SHINGLE))}) END AS s{k}" for k in range(WINDOW - SHINGLE + 1)
    ]
    hashed = windows.selectExpr(*keep, *per_shingle).selectExpr(*keep, "s0", "s1", "s2", "s3", f"explode(sequence(0, {BANDS - 1})) AS band")
    low = ", ".join(f"CASE WHEN s{k} IS NOT NULL THEN xxhash64(s{k}, band) END" for k in range(WINDOW - SHINGLE + 1))
    # Every window has a shingle, so there is a least; the hash holds the band, and a lone long makes a quick join key.
    return hashed.selectExpr(*keep, f"coalesce(least({low}), 0L) AS low")


def _windows(arrays: DataFrame, stride: int, keep: list[str]) -> DataFrame:
    """Windows of the arrays ``words`` that hold at least one shingle."""
    # Outer, and the filter afterwards: else the words would be made twice, once for the filter.
    starts = f"explode_outer(CASE WHEN size(words) >= {SHINGLE} THEN sequence(0, size(words) - {SHINGLE}, {stride}) END)"
    return arrays.select(*keep, "words", F.expr(starts).alias("i")).where("i IS NOT NULL").selectExpr(*keep, "i", f"slice(words, i + 1, {WINDOW}) AS w", "words")


def _shingles(words: str) -> str:
    return f"transform(sequence(0, size({words}) - {SHINGLE}), k -> array_join(slice({words}, k + 1, {SHINGLE}), ' '))"


def license_matches(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """(doc_id, text_key, i, template_id, license, containment): templates retrieved at word ``i`` of a document.

    Templates of fewer than SHINGLE words match nothing.
    """
    own = settled(templates.select("template_id", "license", words_of("text").alias("words")).where(f"size(words) >= {SHINGLE}"))
    known = settled(_bands(_windows(own, 1, ["template_id"]), ["template_id"]).distinct())
    reach = own.agg(F.max(F.size("words"))).first()[0] or 0
    arrays = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words_of("text").alias("words"))
    kept = ["doc_id", "text_key", "i", "around", "lead"]
    windows = _windows(arrays, STRIDE, ["doc_id", "text_key"])
    first = f"greatest(i - {reach}, 0)"
    # The text around a window is cut out only where a band has found a template.
    bands = _bands(windows, ["doc_id", "text_key", "i", "words"]).join(within_bound(known), "low")
    found = bands.selectExpr("doc_id", "text_key", "i", "template_id", f"slice(words, {first} + 1, {2 * reach + WINDOW}) AS around", f"i - {first} AS lead")
    once = found.dropDuplicates(["doc_id", "text_key", "i", "template_id"]).select(*kept, "template_id")
    both = once.join(within_bound(own), "template_id").withColumn("n", F.size("words"))
    near = both.withColumn("near", F.expr("slice(around, greatest(lead - n, 0) + 1, least(lead, n) + 8 + n)"))
    shared = f"size(array_intersect({_shingles('words')}, {_shingles('near')})) / size(array_distinct({_shingles('words')}))"
    return near.selectExpr("doc_id", "text_key", "i", "template_id", "license", f"{shared} AS containment")


def scan(docs: DataFrame, templates: DataFrame, least: float = 0.8) -> DataFrame:
    """``docs`` with ``licenses`` (names of the templates contained to ``least`` or more, sorted) and ``n_templates``.

    Columns of ``docs`` with these names are replaced. A NULL or short text has none. Rows that share a
    doc_id are told apart by their text; a NULL doc_id is matched like any other.
    """
    own, columns = set_aside(docs, "licenses", "n_templates")
    base = own.withColumn("text_key", F.xxhash64("text"))
    found = license_matches(own, templates).where(F.col("containment") >= least)
    by_doc = found.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("license")).alias("_names"), F.count_distinct("template_id").alias("_n"))
    by_doc = by_doc.withColumnsRenamed({"doc_id": "_doc", "text_key": "_key"})
    out = base.join(by_doc, F.expr("doc_id <=> _doc AND text_key = _key"), "left")
    out = out.withColumns({"licenses": F.coalesce("_names", F.expr("cast(array() as array<string>)")), "n_templates": F.coalesce("_n", F.lit(0).cast("long"))})
    return out.select(*columns, "licenses", "n_templates")
