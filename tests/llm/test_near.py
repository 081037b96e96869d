"""Near-duplicate texts and vectors against brute force."""

from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from tallyproof.llm import binary_codes, probminhash
from tallyproof.llm.common import components


def classes_of(nodes, links):
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def bag(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def jaccard_p(a, b):
    keys = set(a) | set(b)
    return sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in keys) for d in a if d in b)


def edited(text, k):
    w = text.split()
    w[(k * 7) % len(w)] = f"new{k}"
    return " ".join(w)


def test_components(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 300)] + [(500, 400), (400, 450), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    want = classes_of({n for x in links for n in x}, links)
    assert got == {n: c for n, c in want.items()}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_probability_jaccard():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = (Counter(rng.integers(0, 12, 30).tolist()) for _ in range(2))
        arrays = [(np.array(sorted(x)), np.array([x[k] for k in sorted(x)])) for x in (a, b)]
        assert probminhash.probability_jaccard(*arrays) == pytest.approx(jaccard_p(a, b))


def test_signatures_estimate_similarity(prose):
    base = prose(5, 400) + " " + " ".join(["again and again it says"] * 30)
    texts = [t.encode() for t in (base, edited(base, 1), prose(6, 300), "a b")]
    text, shingle, weight = probminhash.weighted_shingles(texts, probminhash._Hashes())
    signs = probminhash.signatures(len(texts), text, shingle, weight)
    want = jaccard_p(bag(texts[0].decode()), bag(texts[1].decode()))
    assert abs((signs[0] == signs[1]).mean() - want) < 0.1 and (signs[0] == signs[2]).mean() < 0.05
    assert probminhash.signatures(2, text[:0], shingle[:0], weight[:0]).sum() == 0


def test_near_duplicates(spark, prose, awkward):
    rows = [(100 + k, edited(edited(prose(50, 150), k), k + 3)) for k in range(60)]  # pairwise near, through each other
    rows += [(200 + k, prose(60 + k, 80)) for k in range(20)] + [(300 + k, prose(61, 80)) for k in range(30)]
    rows += [(400 + k, prose(70, 60) + " " + prose(80 + k, 5 + 3 * k)) for k in range(12)]
    own = spark.createDataFrame(rows, "doc_id long, text string")
    everything = awkward.select("doc_id", "text").where("doc_id is null or doc_id not in (6, 7)").unionByName(own)
    texts = [(r["doc_id"], r["text"]) for r in everything.collect() if r["doc_id"] is not None]
    bags = [(d, bag(t)) for d, t in texts]
    links = [(a, b) for (a, x), (b, y) in combinations(bags, 2) if x and y and (x == y or jaccard_p(x, y) >= 0.8 - 1e-12)]
    want = classes_of({d for d, _ in texts}, links)
    got = probminhash.near_duplicates(everything.selectExpr("*", "1 AS class_id", "2 AS kept")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] is not None} == want
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["class_id"]) for r in got) and len(got) == len(texts) + 1
    sizes = Counter(want.values())
    assert all(r["class_size"] == sizes[r["class_id"]] for r in got if r["doc_id"] is not None)
    assert probminhash.near_duplicates(everything.where("false")).count() == 0


def test_classes_within_a_band_are_compared(spark, prose):
    """Texts of a band that aren't near its first text, but near each other."""
    base = prose(90, 200).split()
    texts = [" ".join(base[: 200 - 4 * k]) for k in range(14)]  # each near its neighbours only
    rows = list(enumerate(texts))
    bags = [(d, bag(t)) for d, t in rows]
    links = [(a, b) for (a, x), (b, y) in combinations(bags, 2) if jaccard_p(x, y) >= 0.8]
    got = probminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == classes_of(dict(rows), links)


def vectors(seed=1, n=400, dim=24):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for k in range(0, n // 2, 4):
        x[k + 1] = x[k] + rng.normal(0, 0.3, dim)
        x[k + 2] = x[k + 1] * 3.0
        x[k + 3] = x[k]
    return x.astype(np.float32)


def test_links(spark):
    x = vectors()
    rows = [(k, [float(v) for v in row]) for k, row in enumerate(x)]
    odd = [(1000, None), (1001, []), (1002, [0.0] * 24), (1003, [float("nan")] + [1.0] * 23), (1004, [None] + [1.0] * 23), (1005, [1e30] * 24), (1006, [1e-30] * 24), (1007, [1.0, 2.0]), (None, rows[0][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").selectExpr("*", "9 AS label", "8 AS node")
    got = {r["vec_id"]: r for r in binary_codes.link_vectors(df, 0.9).collect()}
    y = x.astype(float)
    u = y / np.linalg.norm(y, axis=1, keepdims=True)
    near = (u @ u.T >= 0.9) & ~np.eye(len(u), dtype=bool)
    found = sum(got[k]["n_links"] for k in range(len(u)))
    assert found <= near.sum() and found >= 0.97 * near.sum()
    assert all(got[k]["n_links"] <= near[k].sum() for k in range(len(u)))
    low = classes_of(range(len(u)), zip(*np.nonzero(near)))
    assert np.mean([got[k]["component_id"] == low[k] for k in range(len(u))]) > 0.97
    assert [got[k]["n_links"] for k in (1000, 1001, 1002, 1003, 1004, 1007, None)] == [0] * 7
    assert got[1005]["n_links"] == got[1006]["n_links"] == 1 and got[1006]["component_id"] == 1005
    assert got[1000]["component_id"] == 1000 and got[1000]["kept"] and got[None]["component_id"] is None
    assert binary_codes.link_vectors(df.where("false")).count() == 0


def test_hot_band(spark, monkeypatch):
    """More near copies than a block holds, equal ones among them: every link is counted once."""
    monkeypatch.setattr(binary_codes, "BLOCK", 64)
    rng = np.random.default_rng(4)
    base = rng.normal(size=32)
    x = np.concatenate([base + rng.normal(0, 0.02, (300, 32)), np.repeat(base[None], 50, 0)]).astype(np.float32)
    df = spark.createDataFrame([(k, [float(v) for v in r]) for k, r in enumerate(x)], "vec_id long, embedding array<float>")
    got = binary_codes.link_vectors(df, 0.9).collect()
    assert {r["n_links"] for r in got} == {349} and {r["component_id"] for r in got} == {0}


def test_estimates_are_unbiased():
    x = vectors(2, 300, 64).astype(float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    signs, factors = binary_codes.encode(u, 4)
    value, bound = binary_codes.estimate(signs, factors, u)
    error = value - u @ u.T
    off = ~np.eye(len(u), dtype=bool)
    assert abs(error[off].mean()) < 0.005 and (np.abs(error) <= bound[:, None]).mean() > 0.999
