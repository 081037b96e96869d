"""Word and byte repeats against brute force."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyproof.llm import merged_bwt, superkmers


def words_kept(rows, width):
    """Brute force over (doc_id, text): (n_words, n_removed, digest) of each row."""
    first = {}
    for doc, text in rows:
        w = (text or "").encode().split()
        for i in range(len(w) - width + 1 if doc is not None else 0):
            key = tuple(w[i : i + width])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = (text or "").encode().split()
        gone = set()
        for i in range(len(w) - width + 1 if doc is not None else 0):
            if first[tuple(w[i : i + width])] < doc:
                gone |= set(range(i, i + width))
        out.append((doc, len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    return sorted(out, key=str)


def bytes_kept(rows, length):
    seen, out = set(), {}
    for doc, text in sorted({(d, t) for d, t in rows if d is not None and t is not None}):
        data, gone = text.encode(), set()
        for i in range(len(data) - length + 1):
            s = data[i : i + length]
            if s in seen:
                gone |= set(range(i, i + length))
            seen.add(s)
        spans = sum(i - 1 not in gone for i in gone)
        out[doc, text] = (len(data), len(gone), spans, hashlib.sha256(bytes(x for i, x in enumerate(data) if i not in gone)).hexdigest())
    return sorted([(d, *out.get((d, t), (len((t or "").encode()), 0, 0, hashlib.sha256((t or "").encode()).hexdigest()))) for d, t in rows], key=str)


def collected(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=str)


def test_words(spark, awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    got = superkmers.remove_repeats(awkward, width=13)
    assert collected(got, "doc_id", "n_words", "n_removed", "kept_sha256") == words_kept(rows, 13)
    assert "score" in got.columns and got.schema["n_words"].dataType.simpleString() == "bigint"


def test_untouched_texts_stay_as_they_are(spark, awkward):
    got = {r["doc_id"]: r for r in superkmers.remove_repeats(awkward.where("doc_id in (4, 5, 8, 11)")).collect()}
    assert got[8]["kept_text"] == "  \t\n " and got[5]["kept_text"] is None and got[4]["kept_text"] == "" and got[11]["kept_text"] == "one"


def test_many_short_windows(spark, prose):
    rows = [(k, prose(k % 7, 30 + k % 11, 6)) for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert collected(superkmers.remove_repeats(df, width=4), "doc_id", "n_words", "n_removed", "kept_sha256") == words_kept(rows, 4)


@pytest.mark.parametrize("bucket", [60, 600, 6000])
def test_hot_minimisers_are_split(spark, prose, bucket):
    """The same pair of words, and the same run of bytes, in ever different contexts."""
    rows = [(k, f"{prose(k % 9, 12 + k % 5, 50)} of the {prose(k, 9)} of the {prose(k + 1, 9)}{' ' * (k % 150)}{'-' * (k % 160)} {prose(k % 11, 20)}") for k in range(150)]
    rows += [(150, "- " * 60), (151, "- " * 90), (152, "-" * 400), (152, "-" * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    words = superkmers.repeated_windows(df, 13, bucket_bytes=bucket).collect()
    got = {(r["doc_id"], s) for r in words for s in range(r["start"], r["start"] + r["windows"])}
    first, want = {}, set()
    for doc, text in rows:
        w = text.split()
        want |= {(doc, i) for i in range(len(w) - 12) if first.setdefault(tuple(w[i : i + 13]), doc) < doc}
    assert got == want
    found = merged_bwt.repeated_bytes(df, 50, bucket_bytes=bucket)
    keys = {r["text"]: r["k"] for r in df.selectExpr("text", "hash(text) k").collect()}
    got = {(r["doc_id"], r["text_key"], s) for r in found.collect() for s in range(r["start"], r["start"] + r["windows"])}
    seen, want = set(), set()
    for doc, key, text in sorted((d, keys[t], t) for d, t in rows):
        for i in range(len(text) - 49):
            if text[i : i + 50] in seen:
                want.add((doc, key, i))
            seen.add(text[i : i + 50])
    assert got == want


def test_no_bucket_holds_a_hot_pair():
    rng = np.random.default_rng(3)
    texts = [b" ".join(b"w%d" % x if k % 4 else b"of the" for k, x in enumerate(rng.integers(0, 10**6, 200))) for _ in range(300)]
    grains = [2, 7, 13]
    grams, ends = superkmers._grams(grains)(texts)
    spans = [12, 7, 1]
    plain, _ = superkmers.level_keys(grams, spans, [])
    value, n = np.unique(plain, return_counts=True)
    heavy = [np.sort(value[n > 500]), np.zeros(0, np.uint64)]
    assert n.max() > 2000  # all in one bucket
    split, _ = superkmers.level_keys(grams, spans, heavy)
    assert np.unique(split, return_counts=True)[1].max() <= 500


def test_hash_collisions_do_not_matter(monkeypatch):
    monkeypatch.setattr(superkmers, "mixed", lambda x: x * np.uint64(0))
    ids = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3])
    at, owners = np.array([0, 3, 6]), np.array([5, 4, 3])
    assert superkmers.smallest_owner(ids, at, 3, owners).tolist() == [3, 4, 3]


def test_bytes(spark, awkward):
    small = awkward.where("doc_id is null or doc_id not in (6, 7)")
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    # Different texts under one id come in the order of their key.
    assert len({t for d, t in rows if d == 12}) == 2
    got = merged_bwt.remove_repeated_bytes(small, length=50)
    assert collected(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == bytes_kept(rows, 50)


def test_long_and_half_of_it(spark, awkward):
    got = {r["doc_id"]: r for r in merged_bwt.remove_repeated_bytes(awkward.where("doc_id in (6, 7)"), length=100).collect()}
    assert got[6]["n_removed"] == 0 and got[7]["n_removed"] == got[7]["n_bytes"] and got[7]["n_spans"] == 1


@pytest.mark.parametrize("shard", [200, 5_000, 1 << 20])
def test_merged_transforms(shard):
    rng = np.random.default_rng(shard)
    base = bytes(rng.choice(list(b"ab"), 500).tolist())
    strings = [base[a : a + 90] for a in rng.integers(0, 400, 20)] + [b"a" * 200, b"ab" * 60]
    seen, want = set(), []
    for s in strings:
        for i in range(len(s) - 40 + 1):
            want.append(s[i : i + 40] in seen)
            seen.add(s[i : i + 40])
    assert merged_bwt.repeated_in(strings, 40, 10, shard).tolist() == want


def test_common_prefixes():
    strings = [b"abcdefgh", b"abcdxxxx", b"zzzz"]
    data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    sizes = np.array([9, 9, 5])
    begins = np.cumsum(sizes) - sizes
    into = np.arange(len(data)) - np.repeat(begins, sizes)
    left = np.repeat(sizes - 1, sizes) - into
    merged, common = merged_bwt.merge_transforms(merged_bwt.block_codes(data, 2), left, into, np.array([0, 9, 18, 23]), 2, 4)
    order = merged.tolist()
    i, j = sorted((order.index(0), order.index(9)))
    assert j == i + 1 and common[j] == 2  # two symbols of two bytes


@pytest.mark.parametrize("remove", [superkmers.remove_repeats, merged_bwt.remove_repeated_bytes])
def test_empty(spark, awkward, remove):
    assert remove(awkward.where("false")).count() == 0
    assert {r["n_removed"] for r in remove(awkward.where("text is null")).collect()} == {0}
    none = remove(awkward.withColumn("doc_id", F.lit(None).cast("long"))).collect()
    assert {r["n_removed"] for r in none} == {0}


def test_long_texts_are_looked_at_in_segments(spark, prose):
    """Texts beyond the megabyte that is looked at together, with passages across its borders."""
    long = prose(5, 330_000, 30_000)
    border = superkmers.TEXT
    rows = [(1, long), (2, f"{prose(6, 50)} {long[border - 300 : border + 300]} {prose(7, 50)}"), (3, long[200:]), (4, long[2 * border - 90 : 2 * border + 90])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert len(long) > 2 * border
    assert collected(superkmers.remove_repeats(df, width=13), "doc_id", "n_words", "n_removed", "kept_sha256") == words_kept(rows, 13)
    got = {r["doc_id"]: r for r in merged_bwt.remove_repeated_bytes(df, length=100).collect()}
    assert [got[k]["n_removed"] for k in (1, 2, 3, 4)] == [0, 602, len(long) - 200, 180]


def test_segments_hold_every_window_once():
    text = b"  a bb \t ccc\ndddd e  f " * 40
    words = text.split()
    pieces = list(superkmers.word_segments(5)(text, 50))
    got = [(first + i, tuple(p.split()[i : i + 5])) for first, p in pieces for i in range(len(p.split()) - 4)]
    assert len(pieces) > 10 and got == [(i, tuple(words[i : i + 5])) for i in range(len(words) - 4)]
    got = [(first + i, p[i : i + 40]) for first, p in merged_bwt.byte_segments(40)(text, 64) for i in range(len(p) - 39)]
    assert got == [(i, text[i : i + 40]) for i in range(len(text) - 39)]


def sent(send, texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([0] * len(texts)), pa.array(texts)], ["doc_id", "text_key", "text"])
    return [b for b in send(iter([batch]))]


@pytest.mark.parametrize("make", [lambda n, parts: superkmers._send(13, [2, 7, 13], n, parts, []), lambda n, parts: merged_bwt._send(100, n, parts, [])])
def test_what_is_sent_does_not_follow_the_number_of_buckets(make, prose):
    texts = [prose(k, 2_000, 5_000) for k in range(200)]
    few, many = (sum(b.nbytes for b in sent(make(n, 20), texts)) for n in (20, 2_000))
    assert many < 1.2 * few


def test_what_is_received_is_what_was_sent():
    rng = np.random.default_rng(1)
    out = superkmers.Outbox(100, 7, b" ")
    strings = [(int(rng.integers(100)), int(rng.integers(10**12)), int(rng.integers(-(2**31), 2**31)), int(k), int(rng.integers(1, 9)), int(rng.integers(2**32)), b"s%d" % k) for k in range(500)]
    for s in strings:
        out.send(*s)
    out.repeats(5, 6, 7, 2)
    out.repeats(5, 6, 9, 3)
    rows = out.flush().to_pandas()
    assert not out.held and out.flushed == 1 and rows["part"].max() < 7
    got, known = [], []
    for part, group in rows.groupby("part"):
        x, buckets = superkmers.received(group)
        known += list(zip(*(x[n].tolist() for n in ("docs", "keys", "starts", "windows")), strict=True))
        for x, packed in buckets:
            words = b" ".join(packed).split()
            got += [(*row, w) for row, w in zip(zip(*(x[n].tolist() for n in superkmers.NUMBERS), strict=True), words, strict=True)]
    assert known == [(5, 6, 7, 5)] and sorted(got) == sorted(s[1:] for s in strings)


def test_a_group_of_words_stays_small(spark, prose, monkeypatch):
    """Strings of few bytes of text go to one task together, however much text there is; the result is the same."""
    rows = [(k, prose(k % 50, 60)) for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    dealt, send = [], superkmers._send
    monkeypatch.setattr(superkmers, "text_bytes", lambda docs: 480 << 20)
    monkeypatch.setattr(superkmers, "_send", lambda width, grains, buckets, parts, heavy: dealt.append(parts) or send(width, grains, buckets, parts, heavy))
    assert collected(superkmers.remove_repeats(df, width=13), "doc_id", "n_words", "n_removed", "kept_sha256") == words_kept(rows, 13)
    assert (480 << 20) / dealt[0] <= 10 << 20
