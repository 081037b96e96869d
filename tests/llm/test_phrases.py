"""Phrase mining against a plain count over lists of words."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyproof.llm import phrase_mining
from tallyproof.llm.common import pack


def plain(rows, longest=4, least=30, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) for rows of (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    gone = set()
    for p, a in candidates.items():
        words = p[1:]
        gone |= {q for k in range(2, len(words)) for i in range(len(words) - k + 1) if (q := (p[0], *words[i : i + k])) in candidates and 100 * a >= 80 * candidates[q]}
    out = []
    for lang in n:
        ranked = []
        for p, a in candidates.items():
            if p[0] == lang and p not in gone:
                words = p[1:]
                score, _, left, right = min(((2_000_000 * a // (f[lang, *words[:k]] + f[lang, *words[k:]])), k, f[lang, *words[:k]], f[lang, *words[k:]]) for k in range(1, len(words)))
                ranked.append((-score, -a, " ".join(words).encode(), left, right))
        out += [(lang, k + 1, phrase.decode(), -a, left, right, n[lang], -score) for k, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


def mined(docs, **options):
    return sorted(tuple(r) for r in phrase_mining.collocations(docs, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize(("block_bytes", "longest"), [(2_000, 4), (8 << 20, 4), (50_000, 5)])
def test_supplied_documents(spark, data, block_bytes, longest):
    docs = spark.read.parquet(f"{data('0.001')}/documents.parquet").select("lang", "text")
    got = mined(docs, longest=longest, least=8, block_bytes=block_bytes)
    assert got == plain([tuple(r) for r in docs.collect()], longest, 8) and any(len(r[2].split()) == longest for r in got)


def test_awkward_documents(spark, awkward):
    more = [(None, "New York, new york! NEW York? " * 20), ("en", None), ("en", ""), (None, "a\tb a  b\ra b\x0bé Ä é Ä\x00x \x1cy"), ("xx", ".,;"), ("zz", "same same same same " * 9)]
    docs = awkward.select("lang", "text", "word").unionByName(spark.createDataFrame(more, "lang string, text string"), allowMissingColumns=True)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    for least in (2, 30):
        assert mined(docs, least=least) == plain(rows, least=least)
    assert {r[0] for r in mined(docs, least=2)} >= {"und", "zz", "en"}
    assert mined(docs, least=2, top=3) == plain(rows, least=2, top=3)


def test_nothing_to_mine(spark, awkward):
    assert mined(awkward.where("false")) == []
    assert mined(spark.createDataFrame([("en", "one two three")], "lang string, text string")) == []


def test_large_counts_are_exact(spark):
    """Products and sums beyond 64 bits."""
    a, left, right = 9_000_000_000_000_000_000, 9_100_000_000_000_000_000, 9_200_000_000_000_000_000
    got = spark.sql(f"SELECT {a}L AS a, {left}L AS l, {right}L AS r").selectExpr(f"{phrase_mining.SCORE} AS s").first()["s"]
    assert got == 2_000_000 * a // (left + right)


def test_a_frequent_word_in_every_block(spark):
    docs = spark.createDataFrame([("en", "the cat sat on the mat " * 3)] * 300, "lang string, text string").repartition(40)
    assert mined(docs, block_bytes=1) == plain([("en", "the cat sat on the mat " * 3)] * 300)


def test_phrases_travel_packed(spark, data, monkeypatch):
    """A block sends the phrases of a part as one row of few bytes, and the result is the same with many parts."""
    rng = np.random.default_rng(1)
    heads, tails = np.sort(rng.integers(0, 50_000, 200_000)), rng.integers(0, 50_000, 200_000)
    block = {"block": [3], "codes": [pack(np.arange(200_000, dtype=np.int32))], "heads": [pack(np.diff(heads, prepend=0))], "tails": [pack(tails)]}
    rows = pa.concat_tables(map(pa.Table.from_batches, [[x] for x in phrase_mining._ask_phrases(8)(iter(pa.table(block).to_batches()))]))
    assert len(rows) == 8 and rows.nbytes < 8 * 200_000
    docs = spark.read.parquet(f"{data('0.001')}/documents.parquet").select("lang", "text")
    monkeypatch.setattr(phrase_mining, "MEETING", 5_000)
    assert mined(docs, least=8, block_bytes=50_000) == plain([tuple(r) for r in docs.collect()], 4, 8)


def test_large_phrase_numbers():
    """Numbers that do not fit half of a 64-bit key."""
    heads, tails = np.array([1 << 40, 5, 1 << 40, 5, 5]), np.array([2, 7, 2, 1 << 35, 7])
    order, new = phrase_mining._by_phrase(heads, tails)
    assert order.tolist() == [1, 4, 3, 0, 2] and new.tolist() == [0, 2, 3]
