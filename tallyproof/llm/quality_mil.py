"""Quality by attention over passages (multiple-instance learning).

A document is a bag of passages and only the bag has a label. Every passage is encoded (a learned layer over
its hashed words, its pairs of character classes and a few rates), gated attention weighs the passages, and
the weighted sum is scored. Encoder, attention and score are learned together from document labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame

from tallyproof.llm.common import by_bytes, give_back, tidied, with_fields
from tallyproof.llm.labelled import labelled_sample

PASSAGE = 512  # bytes
WORDS, CLASSES, RATES = 256, 16, 4
WIDTH = WORDS + CLASSES * CLASSES + RATES


def _char_classes() -> np.ndarray:
    """Bytes to 16 classes: white space, digits, upper and lower case, non-ASCII, and kinds of punctuation."""
    out = np.full(256, 5, np.uint8)
    for members, value in (("\n", 0), (" \t\r\v\f", 1), ("0123456789", 2), (".", 6), (",;:", 7), ("!?", 8), ("'\"`", 9), ("-_", 10), ("()[]{}<>", 11), ("|/\\", 12), ("#$%&", 13), ("*+=~^", 14), ("@", 15)):
        for c in members.encode():
            out[c] = value
    out[ord("A") : ord("Z") + 1] = 3
    out[ord("a") : ord("z") + 1] = 4
    return out


CHAR_CLASS = _char_classes()


class WordBuckets(dict):
    """Word to one of WORDS buckets; forgets everything when large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 250_000:
            self.clear()
        self[word] = value = xxhash.xxh32_intdigest(word)
        return value


def features(texts: list[bytes], buckets: WordBuckets) -> tuple[np.ndarray, np.ndarray]:
    """Passages of all texts as rows of WIDTH numbers, and the number of passages of each text (at least one)."""
    sizes = np.array([len(t) for t in texts])
    passages = np.maximum(1, -(-sizes // PASSAGE))
    base = np.cumsum(passages) - passages
    total = int(passages.sum())
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    begins = np.cumsum(sizes + 1) - sizes - 1
    offset = np.arange(len(data)) - np.repeat(begins, sizes + 1)
    passage = np.repeat(base, sizes + 1) + np.minimum(offset // PASSAGE, np.repeat(passages, sizes + 1) - 1)
    kind = CHAR_CLASS[data].astype(np.int64)
    own = np.flatnonzero(offset[1:])  # a separator and the first byte of the next text are no pair
    pairs = np.bincount(passage[own] * 256 + kind[own] * CLASSES + kind[own + 1], minlength=total * 256).reshape(total, 256)
    solid = kind > 1
    starts = np.flatnonzero(solid & ~np.concatenate([[False], solid[:-1]]))
    words = [w for t in texts for w in t.split()]
    hashes = np.fromiter(map(buckets.__getitem__, words), np.int64, len(words))
    where = passage[starts]
    bags = np.bincount(where * WORDS + hashes % WORDS, minlength=total * WORDS).reshape(total, WORDS)
    n_words = np.bincount(where, minlength=total)
    distinct = np.bincount(np.unique(where << 32 | hashes) >> 32, minlength=total)
    letters = pairs.sum(1)
    rates = np.stack([distinct / np.maximum(n_words, 1), np.log1p(n_words) / 5, letters / np.maximum(n_words, 1) / 10, np.minimum(letters, PASSAGE) / PASSAGE], 1)
    scaled = [np.sqrt(x / np.maximum(x.sum(1, keepdims=True), 1)) for x in (bags, pairs)]
    return np.concatenate([*scaled, rates], 1).astype(np.float32), passages


def _forward(p: dict[str, np.ndarray], x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    bag = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    h = np.maximum(x @ p["w"] + p["b"], 0)
    t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
    e = (t * g) @ p["a"]
    e = np.exp(e - np.maximum.reduceat(e, first)[bag])
    weight = e / np.add.reduceat(e, first)[bag]
    z = np.add.reduceat(weight[:, None] * h, first)
    s = 1 / (1 + np.exp(-np.clip(z @ p["s"] + p["c"], -30, 30)))
    return {"bag": bag, "first": first, "h": h, "t": t, "g": g, "weight": weight, "z": z, "score": s}


def _gradients(p: dict[str, np.ndarray], x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    f = _forward(p, x, counts)
    h, t, g, weight, bag = f["h"], f["t"], f["g"], f["weight"], f["bag"]
    d = (f["score"] - y) / len(y)
    dz = d[:, None] * p["s"]
    dweight = (dz[bag] * h).sum(1)
    de = weight * (dweight - np.add.reduceat(weight * dweight, f["first"])[bag])
    dt, dg = de[:, None] * p["a"] * g * (1 - t * t), de[:, None] * p["a"] * t * g * (1 - g)
    dh = (weight[:, None] * dz[bag] + dt @ p["v"].T + dg @ p["u"].T) * (h > 0)
    return {"w": x.T @ dh, "b": dh.sum(0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ de, "s": f["z"].T @ d, "c": d.sum()}


def fit(examples: list[tuple[int, bytes]], hidden: int = 24, gate: int = 12, epochs: int = 24, seed: int = 11) -> dict[str, np.ndarray]:
    """Weights learned from (label, text). Without examples of both labels the score is their share, or 0.5."""
    rng = np.random.default_rng(seed)
    p = {"w": rng.normal(0, 0.15, (WIDTH, hidden)), "b": np.zeros(hidden), "v": rng.normal(0, 0.3, (hidden, gate)), "u": rng.normal(0, 0.3, (hidden, gate)), "a": rng.normal(0, 0.3, gate), "s": rng.normal(0, 0.3, hidden), "c": np.zeros(())}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    y = np.array([label for label, _ in examples], np.float32)
    if len(set(y.tolist())) < 2:
        p["s"] *= 0
        p["c"] += (30 if y[0] else -30) if len(y) else 0
        return p
    buckets, parts = WordBuckets(), []
    for _, text in examples:
        parts.append(features([text], buckets)[0])
    first, second = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    step, steps = 0, epochs * -(-len(y) // 32)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 32):
            some = order[at : at + 32]
            grads = _gradients(p, np.concatenate([parts[i] for i in some]), np.array([len(parts[i]) for i in some]), y[some])
            step += 1
            rate = 0.01 * (1 - step / steps) + 1e-4
            for k, grad in grads.items():
                grad = grad + 1e-4 * p[k]
                first[k] += 0.1 * (grad - first[k])
                second[k] += 0.001 * (grad * grad - second[k])
                p[k] = (p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return p


def _score(p: dict[str, np.ndarray], threshold: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = WordBuckets()
        for batch in by_bytes(batches, "text"):
            x, counts = features(batch.column("text").fill_null("").cast(pa.binary()).to_pylist(), buckets)
            f = _forward(p, x, counts)
            value, attention = f["score"].astype(np.float64), np.maximum.reduceat(f["weight"], f["first"]).astype(np.float64)
            rest = {n: batch.column(n) for n in batch.schema.names}
            rest |= {"score": pa.array(value), "top_attention": pa.array(attention), "predicted": pa.array((value >= threshold).astype(np.int32))}
            yield pa.RecordBatch.from_arrays(list(rest.values()), list(rest))

    return score


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, threshold: float = 0.3, per_class: int = 2000, sample_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: better), ``top_attention`` and ``predicted`` (1 if score >= threshold).

    Learns from at most ``per_class`` documents and ``sample_bytes`` of each label, among doc_ids for which ``learn``
    holds. Only the text is scored, all of it: a NULL or empty text is one empty passage. Columns of ``docs``
    that have these names are replaced.
    """
    own = docs.drop("score", "top_attention", "predicted")
    weights = fit(labelled_sample(own, labels, "quality", learn, per_class, sample_bytes))
    give_back()  # the driver's, which has held the features of all examples
    return own.mapInArrow(tidied(_score(weights, threshold)), with_fields(own.schema, "score double, top_attention double, predicted int"))
