"""Near-duplicate vectors by randomised-rotation binary codes.

A unit vector is turned by random rotations and each coordinate kept as its sign. Stored beside the signs is, for each
rotation, how much of the vector they hold (the correction factor); the inner product of signs and another turned vector, divided by it,
is an unbiased estimate of the cosine, with an error bound that the factor gives. Runs of sign bits are also the
keys of bands: vectors that share a band meet, and bits per band and the number of bands follow the number of vectors so that
a pair at the threshold misses every band with a chance below MISS. In a band, pairs whose upper confidence bound is below the
threshold are dismissed; the cosine of the rest is recomputed in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.common import components, reached, settled

MISS = 0.005
BUCKET = 64  # vectors that an even band key would gather
BLOCK = 512  # rows of a band key compared at once
DEVIATIONS = 4.0


@lru_cache(maxsize=4)
def rotations(dim: int, count: int) -> np.ndarray:
    """``count`` random rotations side by side: dim x (count * dim)."""
    rng = np.random.default_rng([dim, 20])
    return np.concatenate([np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(count)], 1)


def bands_for(n: int, threshold: float) -> tuple[int, int]:
    """Bits per band and number of bands for ``n`` vectors."""
    bits = min(48, max(6, math.ceil(math.log2(max(n, 1) / BUCKET + 1)) + 1))
    agree = (1 - math.acos(min(threshold, 1.0)) / math.pi) ** bits
    return bits, max(4, math.ceil(math.log(MISS) / math.log(1 - min(agree, 1 - 1e-9))))


def encode(vectors: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Signs (n x count * dim, True for positive) and correction factors (n x count) of unit vectors."""
    n, dim = vectors.shape
    turned = vectors @ rotations(dim, count)
    return turned > 0, np.abs(turned).reshape(n, count, dim).sum(2) / math.sqrt(dim)


def estimate(signs: np.ndarray, factors: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosines of stored codes with full vectors (stored x queries), and each stored code's error bound."""
    n, count = factors.shape
    dim = queries.shape[1]
    turned = (queries @ rotations(dim, count)).astype(np.float32)
    scaled = np.where(signs, 1, -1).reshape(n, count, dim) / (factors[:, :, None] * math.sqrt(dim) * count)
    spread = np.sqrt(((1 - factors**2).clip(0) / factors**2).mean(1) / (max(dim - 1, 1) * count))
    return scaled.reshape(n, -1).astype(np.float32) @ turned.T, DEVIATIONS * spread + 1e-5


def _index(bits: int, bands: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            rows: dict[str, list] = {n: [] for n in ("node", "copies", "dim", "vector", "code", "factors", "keys")}
            nodes, copies, data = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("node", "copies", "embedding"))
            sizes = np.array([len(v) for v in data])
            for dim in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dim)
                vectors = np.stack([data[i] for i in own]).astype(np.float64)
                count = max(2, -(-bits * bands // dim))
                unit = vectors / np.abs(vectors).max(1, keepdims=True)
                signs, factors = encode(unit / np.linalg.norm(unit, axis=1, keepdims=True), count)
                keys = signs[:, : bits * bands].reshape(len(own), bands, bits) @ weights
                rows["node"] += nodes[own].tolist()
                rows["copies"] += copies[own].tolist()
                rows["dim"] += [dim] * len(own)
                rows["vector"] += [v.tobytes() for v in vectors]
                rows["code"] += [c.tobytes() for c in np.packbits(signs, axis=1)]
                rows["factors"] += [f.tobytes() for f in factors.astype(np.float32)]
                rows["keys"] += keys.tolist()
            types = {"node": pa.int64(), "copies": pa.int64(), "dim": pa.int32(), "keys": pa.list_(pa.int64())}
            yield pa.RecordBatch.from_arrays([pa.array(v, types.get(n, pa.binary())) for n, v in rows.items()], list(rows))

    return index


def _compare(threshold: float, bits: int, bands: int):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        out_nodes, out_peers, out_links = [], [], []
        rows = rows.sort_values(["dim", "band", "key", "left", "right"], kind="stable")
        changes = (rows[["dim", "band", "key", "left", "right"]].diff().fillna(1) != 0).any(axis=1).to_numpy()
        cuts = np.append(np.flatnonzero(changes), len(rows))
        columns = {n: rows[n].to_numpy() for n in ("node", "copies", "half", "vector", "code", "factors")}
        single = {n: rows[n].to_numpy() for n in ("dim", "band", "left", "right")}
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if b - a < 2:
                continue
            dim, band, left, right = (int(single[n][a]) for n in ("dim", "band", "left", "right"))
            count = max(2, -(-bits * bands // dim))
            node, copies, half = (columns[n][a:b] for n in ("node", "copies", "half"))
            vectors = np.frombuffer(b"".join(columns["vector"][a:b])).reshape(b - a, dim)
            signs = np.unpackbits(np.frombuffer(b"".join(columns["code"][a:b]), np.uint8).reshape(b - a, -1), axis=1)[:, : count * dim].astype(bool)
            factors = np.frombuffer(b"".join(columns["factors"][a:b]), np.float32).reshape(b - a, count).astype(float)
            scaled = vectors / np.abs(vectors).max(1, keepdims=True)
            unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
            stored, queries = np.flatnonzero(half == left), np.flatnonzero(half == right)
            value, bound = estimate(signs[stored], factors[stored], unit[queries])
            i, j = np.nonzero(value + bound[:, None] >= threshold)
            i, j = stored[i], queries[j]
            keep = i < j if left == right else np.ones(len(i), bool)
            i, j = i[keep], j[keep]
            same = (signs[i, : bits * bands] == signs[j, : bits * bands]).reshape(len(i), bands, bits).all(2)
            keep = same.argmax(1) == band  # a pair counts in the first band that it shares
            i, j = i[keep], j[keep]
            keep = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
            i, j = i[keep], j[keep]
            links = np.bincount(i, copies[j], b - a) + np.bincount(j, copies[i], b - a)
            some = np.flatnonzero(links)
            moved, peers = reached(node, i, j)
            out_nodes += [node[some], moved]
            out_links += [links[some].astype(np.int64), np.zeros(len(moved), np.int64)]
            out_peers += [node[some], peers]
        none = np.zeros(0, np.int64)
        return pd.DataFrame({"node": np.concatenate([none, *out_nodes]), "peer": np.concatenate([none, *out_peers]), "links": np.concatenate([none, *out_links])})

    return compare


def link_vectors(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    Links join vectors of one length whose cosine is ``threshold`` or more, as far as they share a band (at least 1 - MISS of such
    pairs are expected to). Equal vectors are compared once and counted as often as they occur; a repeated vec_id is
    a vector as often. NULL and zero vectors, and those with NULL or non-finite components, link with nothing. A row with a
    NULL vec_id links with nothing and has a NULL component.
    """
    fine = "vec_id is not null and embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(embedding, x -> x <> 0)"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("digest", F.expr(f"CASE WHEN {fine} THEN sha2(array_join(cast(embedding as array<string>), ','), 256) END"))
    distinct = rows.where("digest is not null").groupBy("digest").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.min("embedding").alias("embedding"))
    # Equal digests whose first vec_id is equal too (a repeated vec_id with other values) stay apart by digest.
    distinct = settled(distinct)
    n = distinct.count()
    bits, bands = bands_for(n, threshold)
    index = settled(distinct.drop("digest").mapInArrow(_index(bits, bands), "node long, copies long, dim int, vector binary, code binary, factors binary, keys array<long>"))
    keyed = index.select("node", "copies", "dim", "vector", "code", "factors", F.posexplode("keys").alias("band", "key"))
    sizes = index.select("dim", F.posexplode("keys").alias("band", "key")).groupBy("dim", "band", "key").agg(F.count("*").alias("size")).where("size > 1")
    halves = keyed.join(sizes, ["dim", "band", "key"]).withColumn("blocks", F.expr(f"cast(ceil(size / {BLOCK}) as int)")).withColumn("half", F.expr("pmod(hash(node, vector), blocks)"))
    halves = halves.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumns({"left": F.least("half", "other"), "right": F.greatest("half", "other")})
    deals = max(8, n * bands // 20_000)
    found = halves.drop("size", "blocks", "other").withColumn("deal", F.expr(f"pmod(xxhash64(dim, band, key, left, right), {deals})"))
    found = settled(found.groupBy("deal").applyInPandas(_compare(threshold, bits, bands), "node long, peer long, links long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.where("node <> peer"), "node", "peer").select(F.col("node").alias("_node"), F.col("component").alias("component"))
    own = rows.drop("embedding").join(distinct.select("digest", "node", "copies"), "digest", "left")
    out = own.join(links, "node", "left").join(classes, F.col("node") == F.col("_node"), "left")
    component = F.coalesce("component", "node", "vec_id")
    count = F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))
    return out.select("vec_id", count.cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
