"""Benchmark phrases, licenses and mixtures."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyproof.llm import license_scan, mixing, phrase_index


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contaminated(rows, items, width):
    out = []
    for doc, text in rows:
        w, hit, ids = words(text), set(), set()
        for item, test in items:
            t = words(test)
            for q in range(max(1, len(t) - width + 1) if t else 0):
                s = t[q : q + width]
                for p in range(len(w) - len(s) + 1):
                    if w[p : p + len(s)] == s:
                        hit |= set(range(p, p + len(s)))
                        ids.add(str(item))
        out.append((doc, len(w), len(hit), sorted(ids), bool(hit)))
    return sorted(out, key=str)


def test_contamination(spark, awkward, prose):
    small = awkward.where("doc_id is null or doc_id not in (6, 7)")
    items = [(1, prose(2, 60)[20:150]), (2, prose(2, 60).upper()), (3, "É-à_b"), (10, "ONE"), (10, "bär"), (4, None), (5, "..."), (6, ""), (7, prose(99, 30)), (8, "same " * 25), (9, "é à b")]
    benchmark = spark.createDataFrame([*items, (None, "one")], "item_id long, text string")
    got = phrase_index.contamination(small, benchmark).select("doc_id", "n_words", "n_hit", "item_ids", "contaminated").collect()
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    assert sorted([tuple(r) for r in got], key=str) == contaminated(rows, items, 10)
    assert phrase_index.contamination(small, benchmark.where("false")).where("contaminated").count() == 0
    assert phrase_index.contamination(small.where("false"), benchmark).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a b c rare d e f"), (2, "f e d rare c b a"), (3, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c rare d e f")], "item_id long, text string")
    got = {(r["doc_id"], r["phrase"]) for r in phrase_index.matches(docs, items, 7).collect()}
    assert got == {(1, True), (2, False)}


def test_licenses(spark, awkward):
    filler = " ".join(f"x{k}" for k in range(90))
    apache = license_scan.TEMPLATES[3][1]
    rows = [(k, f"{' '.join(filler.split()[:k])} Released under the MIT license! {filler}") for k in range(12)]
    rows += [(20, apache), (21, apache.upper() + filler), (22, filler + " " + " ".join(apache.split()[:9])), (23, "Licensed under CC BY-NC 4.0."), (24, "a license"), (25, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["licenses"] for r in license_scan.scan(docs, license_scan.default_templates(spark)).collect()}
    assert got == {k: ["MIT"] for k in range(12)} | {20: ["Apache-2.0"], 21: ["Apache-2.0"], 22: [], 23: ["CC-BY-NC-4.0"], 24: [], 25: []}
    odd = license_scan.scan(awkward, license_scan.default_templates(spark))
    assert odd.count() == awkward.count() and odd.where("size(licenses) > 0").count() == 0
    assert license_scan.scan(docs, license_scan.default_templates(spark).where("false")).where("n_templates > 0").count() == 0
    assert 0.75**license_scan.BANDS < 0.0011


def test_versions_and_relatives_are_told_apart(spark):
    notice = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation; {}version {} of the License, or (at your option) any later version."
    conditions = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice. 2. Redistributions in binary form must reproduce the above copyright notice in the documentation and/or other materials provided with the distribution. {}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES"
    third = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
    cases = [(notice.format(name, either, v), want) for either in ("", "either ") for name, v, want in (
        ("", 2, ["GPL", "GPL-2.0"]), ("", 3, ["GPL", "GPL-3.0"]), ("Lesser ", 2.1, ["LGPL-2.1"]), ("Lesser ", 3, ["LGPL-3.0"]), ("Affero ", 3, ["AGPL-3.0"]))]
    cases += [(conditions.format(""), ["BSD", "BSD-2-Clause"]), (conditions.format(third), ["BSD", "BSD-3-Clause"])]
    cases += [(f"This work is licensed under the GNU General Public License, version {v}.", [f"GPL-{v}.0"]) for v in (2, 3)]
    cases += [("GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", ["LGPL-3.0"]), ("GNU AFFERO GENERAL PUBLIC LICENSE Version 3", ["AGPL-3.0"])]
    cases += [("This is free and unencumbered software released into the public domain.", ["Unlicense"]), ("Apache License Version 2.0, January 2004", ["Apache-2.0"])]
    cases += [("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", ["ISC"])]
    docs = spark.createDataFrame([(k, f"x y z {text} and so on") for k, (text, _) in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: r["licenses"] for r in license_scan.scan(docs, license_scan.default_templates(spark)).collect()}
    assert got == {k: want for k, (_, want) in enumerate(cases)}


def split(budget, children):
    """{name: (weight, cap)}: fill the child that is full first, again and again."""
    out, left = {}, dict(children)
    while left:
        total = sum(w for w, _ in left.values())
        name = min(left, key=lambda n: (left[n][0] == 0, left[n][1] / max(left[n][0], 1), n))
        weight, cap = left[name]
        if not weight or cap * total > weight * budget:
            return out | {n: min(c, w * max(budget, 0) // total) if w else 0 for n, (w, c) in left.items()}
        out[name] = cap
        budget -= cap
        left.pop(name)
    return out


def mixed(rows, weights, share, epochs, seed):
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for k, r in enumerate(rows)}
    leaf = {k: tuple(x or "" for x in r[2:]) for k, r in enumerate(rows)}
    tokens = defaultdict(int)
    for k in size:
        tokens[leaf[k]] += size[k]
    tokens = {n: t for n, t in tokens.items() if t}
    given = {(): sum(tokens.values()) * share[0] // share[1]}
    for depth, level in enumerate(mixing.LEVELS):
        new = {}
        for node, budget in given.items():
            caps = defaultdict(int)
            for n, t in tokens.items():
                if n[:depth] == node:
                    caps[n[depth]] += t * epochs
            new |= {(*node, c): g for c, g in split(budget, {c: (weights.get(level, {}).get(c, 1), cap) for c, cap in caps.items()}).items()}
        given = new
    out = []
    for node, t in tokens.items():
        whole, more = divmod(given[node], t)
        keys = {k: hashlib.md5(f"{seed}:{whole}:{'' if rows[k][0] is None else rows[k][0]}".encode()).hexdigest() for k in size if leaf[k] == node and size[k]}
        for k in keys:
            ahead = sum(size[j] for j in keys if keys[j] < keys[k])
            out.append((rows[k][0], *node, size[k], whole + (more > ahead)))
    return sorted(out + [(rows[k][0], *leaf[k], 0, 0) for k in size if not size[k]], key=str)


@pytest.mark.parametrize(("share", "epochs"), [((3, 5), 2), ((1, 10), 1), ((5, 2), 2), ((0, 1), 3)])
def test_mixture(spark, prose, share, epochs):
    rows = [(k, prose(k, 5 + k % 40), f"d{k % 3}" if k % 13 else None, "en" if k % 2 else "de", "hot" if k % 5 < 3 else f"s{k % 7}") for k in range(400)]
    rows += [(1, prose(1, 6), "d1", "en", "hot"), (1, prose(1, 6), "d1", "en", "hot"), (900, None, None, None, None), (901, "", "d1", "en", "empty"), (None, "a b c", "d1", "xx", "one")]
    weights = {"domain": {"d0": 6, "d1": 3, "d2": 0}, "lang": {"en": 3}, "source": {"s1": 10}}
    df = spark.createDataFrame(rows, "doc_id long, text string, domain string, lang string, source string")
    got = mixing.mix(df, F.col("domain"), weights, share, epochs, seed=3)
    assert got.columns == ["doc_id", "domain", "lang", "source", "n_tokens", "copies"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == mixed(rows, weights, share, epochs, 3)


def test_mixture_of_awkward_and_empty(spark, awkward):
    assert mixing.mix(awkward, F.lit("d"), {}).count() == awkward.count()
    assert mixing.mix(awkward.where("false"), F.lit("d"), {}).count() == 0
    assert {r["copies"] for r in mixing.mix(awkward.where("text is null"), F.lit("d"), {}).collect()} == {0}


def test_columns_of_any_name_come_back(spark, awkward):
    names = ["_doc", "_key", "_hit", "_ids", "_names", "_n", "_rest", "n_hit", "text_key", "words"]
    docs = awkward.select("text", "doc_id", *[F.lit(k).alias(n) for k, n in enumerate(names)])
    items = spark.createDataFrame([("i", awkward.where("doc_id = 1").first()["text"])], "item_id string, text string")
    found = phrase_index.contamination(docs, items)
    kept = [n for n in names if n != "n_hit"]
    assert found.columns == ["text", "doc_id", *kept, "n_words", "n_hit", "item_ids", "n_items", "contaminated"]
    assert found.where("contaminated").count() > 0 and {tuple(r) for r in found.select(*kept).collect()} == {tuple(k for k, n in enumerate(names) if n != "n_hit")}
    scanned = license_scan.scan(docs, license_scan.default_templates(spark))
    assert scanned.columns == [*docs.columns, "licenses", "n_templates"] and scanned.count() == docs.count()
