"""Near-duplicates by ProbMinHash over weighted shingles.

A document is its shingles of five words, each weighted by how often it occurs. In ProbMinHash every shingle
arrives at random registers at the times of a Poisson process whose rate is its weight, and a register keeps the
shingle that arrives first. Two signatures agree in a register with the probability Jaccard similarity of the
documents. Arrivals of a shingle stop as soon as they come later than every register's first, so most shingles arrive once or twice.

Signatures are cut into bands. Of texts that share a band, first each is compared with one of them. Where that leaves a
band's texts in different classes, texts of different classes whose signatures agree enough are put into clusters, and
within a cluster all texts are compared, in blocks. Signature estimates dismiss what is clearly below the threshold, and
the texts of the rest decide; only links that span a class leave a block. Exact copies are one text throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.common import components, reached, settled, sliced, tidied, tidied_group, within_bound
from tallyproof.llm.superkmers import MULTIPLIERS, _Hashes, mixed, text_parts

SHINGLE, BANDS, ROWS = 5, 32, 5  # a pair at 0.8 shares no band with a chance of 3 in a million
REGISTERS = BANDS * ROWS
SLACK = 0.13  # four standard deviations of an estimate at 0.8
BLOCK = 512
DEAL = 500  # texts to a group of comparisons


def weighted_shingles(texts: list[bytes], hashes: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, occurrences), sorted by text and hash; a text of fewer words is one shingle, a wordless one has none."""
    words = [t.split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((h for w in words for h in map(hashes.__getitem__, w)), np.uint64, int(sizes.sum()))
    flat = np.concatenate([flat, np.zeros(SHINGLE, np.uint64)])
    own = np.repeat(np.arange(len(texts)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    at = np.flatnonzero((np.arange(len(own)) + SHINGLE <= ends) | (np.arange(len(own)) == ends - np.repeat(sizes, sizes)))
    value = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE):
        value += np.where(at + k < ends[at], flat[at + k], np.uint64(0)) * MULTIPLIERS[k]
    value = mixed(value)
    order = np.lexsort([value, own[at]])
    text, value = own[at][order], value[order]
    first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (value[1:] != value[:-1])])) if len(text) else order
    return text[first], value[first], np.diff(np.append(first, len(text)))


def signatures(n: int, text: np.ndarray, shingle: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """REGISTERS numbers of 16 bits for each of ``n`` texts; texts without shingles get zeros."""
    first, kept = np.full(n * REGISTERS, np.inf), np.zeros(n * REGISTERS, np.uint16)
    time, rate, state = np.zeros(len(text)), weight.astype(float), shingle.copy()
    live = np.arange(len(text))
    while len(live):
        state[live] += np.uint64(0x9E3779B97F4A7C15)
        draw = mixed(state[live] ^ (state[live] >> np.uint64(27)))
        time[live] -= np.log((draw >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54) / rate[live]
        place = text[live] * REGISTERS + (mixed(draw + MULTIPLIERS[1]) >> np.uint64(32)).astype(np.int64) % REGISTERS
        sooner = np.flatnonzero(time[live] < first[place])
        order = sooner[np.lexsort([time[live[sooner]], place[sooner]])]
        order = order[np.concatenate([[True], place[order][1:] != place[order][:-1]])] if len(order) else order
        first[place[order]] = time[live[order]]
        kept[place[order]] = (shingle[live[order]] >> np.uint64(48)).astype(np.uint16)
        latest = first.reshape(n, REGISTERS).max(1)
        live = live[time[live] < latest[text[live]]]
    return kept.reshape(n, REGISTERS)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """J_P of two sets of (sorted shingles, weights): over common d, the sum of 1 / sum_e max(u_e / u_d, v_e / v_d)."""
    (x, u), (y, v) = a, b
    common, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    cu, cv = u[i].astype(float), v[j].astype(float)
    only_u, only_v = u.sum() - cu.sum(), v.sum() - cv.sum()
    ratio = cu / cv
    order = np.argsort(ratio, kind="stable")
    ratios, up, down = ratio[order], np.concatenate([[0], np.cumsum(cu[order])]), np.concatenate([[0], np.cumsum(cv[order])])
    at = np.searchsorted(ratios, ratio, side="left")  # below: v counts; from here on: u counts
    return float((1 / ((only_u + up[-1] - up[at]) / cu + (only_v + down[at]) / cv)).sum())


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for batch in sliced(batches):
        rows = []
        texts = pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), batch.column("text")], ["a", "b", "text"])
        for ids, digests, part in text_parts(texts, 1 << 20):
            text, shingle, weight = weighted_shingles(part, hashes)
            some = np.bincount(text, minlength=len(part)) > 0
            for k, s in enumerate(signatures(len(part), text, shingle, weight)):
                rows.append((ids[k], digests[k], s.tobytes() if some[k] else None))
        ids, digests, signs = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(signs, pa.binary())], ["doc_id", "digest", "sign"])


def _agreement(a: pa.Array, b: pa.Array) -> np.ndarray:
    x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in (a, b))
    return (x == y).mean(1)


def _promising(least: float):
    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                keep = _agreement(batch.column("sign"), batch.column("lead_sign")) >= least
                yield batch.select(["lead", "node"]).filter(pa.array(keep))

    return promising


def _bounds(rows: pd.DataFrame, by: list[str]) -> Iterator[pd.DataFrame]:
    """The parts of a deal."""
    rows = rows.sort_values(by, kind="stable").reset_index(drop=True)
    cuts = np.append(np.flatnonzero((rows[by] != rows[by].shift()).any(axis=1)), len(rows))
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield rows.iloc[i:j]


def _two_halves(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are compared with which."""
    half = part["half"].to_numpy()
    return np.flatnonzero(half == part["left"].iloc[0]), np.flatnonzero(half == part["right"].iloc[0])


def _edges(found: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
    none = np.zeros(0, np.int64)
    return pd.DataFrame({"lead": np.concatenate([none, *(low for _, low in found)]), "node": np.concatenate([none, *(node for node, _ in found)])})


def _across(least: float):
    """Links between texts of a band that are of different classes and agree enough, reduced to what spans them."""

    def across(rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        for part in _bounds(rows, ["key", "left", "right"]):
            if len(part) < 2:
                continue
            signs = np.frombuffer(b"".join(part["sign"]), np.uint16).reshape(-1, REGISTERS)
            comp, (a, b) = part["comp"].to_numpy(), _two_halves(part)
            i, j = [], []
            for k in a:
                others = b[comp[b] != comp[k]]
                others = others[(signs[others] == signs[k]).mean(1) >= least]
                i.append(np.full(len(others), k))
                j.append(others)
            found.append(reached(part["node"].to_numpy(), np.concatenate([*i, a[:0]]), np.concatenate([*j, a[:0]])))
        return _edges(found)

    return across


def _similar(texts: list[bytes], a: np.ndarray, b: np.ndarray, apart: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a x b that are similar enough. ``apart``: a number for each text; pairs of one number needn't be found."""
    text, shingle, weight = weighted_shingles(texts, _Hashes())
    values, column, often = np.unique(shingle, return_inverse=True, return_counts=True)
    shared = often[column] > 1
    place = np.cumsum(often > 1) - 1
    size, mass = np.bincount(text, minlength=len(texts)), np.bincount(text, weight, len(texts))
    plain = size == mass
    common, part = np.zeros((len(a), len(b)), np.float32), np.zeros((2, len(a), len(b)), np.float32)
    t, c, w = text[shared], place[column[shared]], weight[shared]
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, 4096):
        some = (c >= start) & (c < start + 4096)
        x = np.zeros((len(texts), 4096), np.float32)
        x[t[some], c[some] - start] = w[some]
        one = (x > 0).astype(np.float32)
        common += one[a] @ one[b].T
        if not plain.all():
            part += np.stack([x[a] @ one[b].T, one[a] @ x[b].T])
    both = plain[a][:, None] & plain[b][None, :]
    near = both & (common >= threshold * (size[a][:, None] + size[b][None, :] - common) - 1e-3) & (common > 0)
    # With weights the similarity is at most either text's share in common shingles.
    if not plain.all():
        near |= ~both & (part[0] >= (threshold - 1e-4) * mass[a][:, None]) & (part[1] >= (threshold - 1e-4) * mass[b][None, :]) & (common > 0)
    i, j = np.nonzero(near)
    i, j = a[i], b[j]
    keep = apart[i] != apart[j]
    i, j = i[keep], j[keep]
    cuts = np.searchsorted(text, np.arange(len(texts) + 1))
    bags = [(shingle[x:y], weight[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
    exact = plain[i] & plain[j]
    good = exact.copy()
    group = apart.copy()
    for k in np.flatnonzero(~exact).tolist():
        if group[i[k]] != group[j[k]] and probability_jaccard(bags[i[k]], bags[j[k]]) >= threshold:
            good[k] = True
            group[group == group[j[k]]] = group[i[k]]
    # Plain pairs at the very threshold are counted in whole numbers.
    edge = np.flatnonzero(exact)
    inter = common[np.searchsorted(a, i[edge]), np.searchsorted(b, j[edge])].astype(np.int64)
    good[edge] = inter / (size[i[edge]] + size[j[edge]] - inter) >= threshold
    return i[good], j[good]


def _compare(threshold: float):
    """Links within a cluster, reduced to what spans its classes."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        for part in _bounds(rows[~rows["text"].isna()], ["cluster", "left", "right"]):
            if len(part) > 1:
                i, j = _similar([t.encode() for t in part["text"]], *_two_halves(part), part["comp"].to_numpy(), threshold)
                found.append(reached(part["node"].to_numpy(), i, j))
        return _edges(found)

    return compare


def _verify(threshold: float):
    """Of a lead and some nodes: the nodes similar enough to it."""

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        found, hashes = [], _Hashes()
        for part in _bounds(rows[~rows["text"].isna()], ["lead", "part"]):
            text, shingle, weight = weighted_shingles([t.encode() for t in part["text"]], hashes)
            cuts = np.searchsorted(text, np.arange(len(part) + 1))
            bags = [(shingle[i:j], weight[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
            node, lead = part["node"].to_numpy(), part["lead"].iloc[0]
            for own in np.flatnonzero(node == lead).tolist():
                near = [k for k in np.flatnonzero(node != lead).tolist() if probability_jaccard(bags[own], bags[k]) >= threshold]
                found.append((node[near], np.full(len(near), lead)))
        return _edges(found)

    return verify


def _with_texts(wanted: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """Settled rows of nodes with their texts, dealt by ``key`` into groups of about DEAL rows."""
    wanted = settled(wanted)
    deals = max(8, wanted.count() // DEAL)
    return texts.withColumnRenamed("doc_id", "node").join(within_bound(wanted), "node").withColumn("deal", F.expr(f"pmod(xxhash64({key}), {deals})")).groupBy("deal")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The (lead, node) pairs whose texts (doc_id, text) are similar enough. A lead's nodes are split into parts of about 64."""
    sizes = pairs.groupBy("lead").agg(F.ceil(F.count("*") / 64).cast("int").alias("parts"))
    members = pairs.join(sizes, "lead").selectExpr("lead", "node", "pmod(hash(node), parts) AS part")
    leads = sizes.selectExpr("lead", "lead AS node", "explode(sequence(0, parts - 1)) AS part")
    rows = _with_texts(members.unionByName(leads), texts, "lead, part")
    return settled(rows.applyInPandas(tidied_group(_verify(threshold)), "lead long, node long"))


def in_blocks(rows: DataFrame, key: str) -> DataFrame:
    """Rows of each ``key`` for all pairs of its blocks of about BLOCK rows: ``half`` is a row's own, to be compared in ``left`` and ``right``."""
    sizes = rows.groupBy(key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    halves = rows.join(sizes, key).withColumn("half", F.expr("pmod(hash(node), blocks)")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    return halves.withColumns({"left": F.least("half", "other"), "right": F.greatest("half", "other")}).drop("other", "blocks")


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, class_id, class_size, kept): the class of every row of ``docs``.

    ``class_id`` is the smallest doc_id reachable by links; two documents are linked if they have the same text, or if their weighted
    shingles have a probability Jaccard similarity of ``threshold`` or more (for shingles that occur once each, that
    is plain Jaccard). ``kept``: doc_id is class_id. ``class_size`` counts documents. Rows that share a doc_id are one
    document, linked by any of its texts. Texts without words link with nothing, not even with each other; a row with a
    NULL doc_id has a NULL class and is kept.
    """
    rows = docs.where("doc_id is not null").selectExpr("cast(doc_id as long) AS doc_id", "text")
    signed = settled(rows.where("text is not null").withColumn("digest", F.unhex(F.sha2("text", 256))).mapInArrow(tidied(_sign), "doc_id long, digest binary, sign binary")).where("sign is not null")
    # One document stands for all exact copies.
    texts = settled(signed.groupBy("digest").agg(F.min(F.struct("doc_id", "sign")).alias("m")).select("digest", "m.doc_id", "m.sign"))
    width = 2 * ROWS
    bands = texts.select(F.col("doc_id").alias("node"), F.expr(f"explode(sequence(0, {BANDS - 1}))").alias("band"), "sign")
    bands = settled(bands.selectExpr("node", f"xxhash64(band, substring(sign, band * {width} + 1, {width})) AS key"))
    shared = bands.groupBy("key").agg(F.min("node").alias("lead"), F.count("*").alias("size")).where("size > 1")
    together = settled(bands.join(shared, "key"))
    by_node = texts.select(F.col("doc_id").alias("node"), "sign")
    stars = together.where("lead <> node").select("lead", "node").distinct()
    signs = stars.join(by_node, "node").join(by_node.withColumnsRenamed({"node": "lead", "sign": "lead_sign"}), "lead")
    promising = settled(signs.mapInArrow(tidied(_promising(threshold - SLACK)), "lead long, node long"))
    # Exact copies hang on their first document, and different texts under one doc_id belong together.
    first_of = settled(signed.select("doc_id", "digest").join(texts.select("digest", F.col("doc_id").alias("lead")), "digest").select("doc_id", "lead").distinct())
    several = first_of.groupBy("doc_id").agg(F.min("lead").alias("lead"), F.max("lead").alias("high")).where("lead <> high").select("doc_id", "lead")
    same = first_of.withColumnRenamed("lead", "node").join(several, "doc_id").where("lead <> node").select("lead", "node")
    classes = components(verified(promising, rows, threshold).unionByName(same), "lead", "node")

    # Texts that share a band but not yet a class.
    placed = together.select("key", "node").join(classes, "node", "left").select("key", "node", F.coalesce("component", "node").alias("comp"))
    split = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
    unlike = settled(in_blocks(placed.join(split, "key"), "key"))
    deals = max(8, unlike.count() // 20_000)
    signed_rows = unlike.join(by_node, "node").withColumn("deal", F.expr(f"pmod(xxhash64(key, left, right), {deals})"))
    edges = settled(signed_rows.groupBy("deal").applyInPandas(tidied_group(_across(threshold - SLACK)), "lead long, node long").distinct())
    if not edges.isEmpty():
        clusters = components(edges, "lead", "node").withColumnRenamed("component", "cluster")
        members = clusters.join(classes, "node", "left").select("cluster", "node", F.coalesce("component", "node").alias("comp"))
        rows_of = _with_texts(in_blocks(members, "cluster"), rows, "cluster, left, right")
        more = settled(rows_of.applyInPandas(tidied_group(_compare(threshold)), "lead long, node long"))
        classes = components(classes.select(F.col("component").alias("lead"), "node").unionByName(more), "lead", "node")

    own = first_of.groupBy("doc_id").agg(F.min("lead").alias("node"))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(own, "doc_id", "left").join(classes, "node", "left")
    out = out.select("doc_id", F.coalesce("component", "node", "doc_id").alias("class_id"))
    sizes = out.where("class_id is not null").groupBy("class_id").agg(F.count_distinct("doc_id").alias("class_size"))
    out = out.join(sizes, "class_id", "left")
    return out.select("doc_id", "class_id", F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"), F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"))
