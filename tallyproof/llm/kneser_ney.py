"""Toxicity by two class-conditional Kneser-Ney models.

One bigram model is learned from toxic and one from ordinary texts. Each level gives the mass that its discounts
free to the next: a class's pairs to the class's words, and these to continuation counts that both classes share (in how many
different contexts a word stands, in either), so that every word has a probability in both, however rare it is.
In addition to the freed mass a backoff has a strength in proportion to the class's share of all counts (the
Bayesian form of the method): classes differ in size, and by freed mass alone a word that the smaller one
lacks would be likelier there. A text is judged by its log-likelihood ratio divided by its length, and by its most
telling stretch of one to STRETCH words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from tallyproof.llm.common import sliced, tidied, with_fields
from tallyproof.llm.labelled import labelled_sample
from tallyproof.llm.superkmers import text_parts

#: Letters A-Z in lower case; ASCII other than letters and digits as spaces.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
STRETCH = 3  # words at most
FLAT = 40  # contexts added to those of every word in the shared backoff
SHARED = 0.25  # strength of the backoff, in its contexts
#: Letters of scripts without spaces between words (Han, kana, Bopomofo, Yi, Thai, Lao, Tibetan, Burmese, Khmer, Tai): each is a word.
UNSPACED = re.compile(
    "([\u0e00-\u0eff\u0f00-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029\u3031-\u312f\u31a0-\ua4cf"
    "\ua9e0-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U00016fe0-\U00018dff\U0001aff0-\U0001b2ff\U00020000-\U0003ffff])"
)
#: White space and punctuation beyond ASCII.
BETWEEN = re.compile("[\u0080-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u2000-\u200b\u200e-\u206f\u3000-\u3004\u3008-\u3020\u3030\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")


@dataclass
class Model:
    """Words by number (0: in no text of either class), and for each class its discounted bigrams, the mass that each context frees, and the words after it."""

    words: dict[bytes, int]
    keys: list[np.ndarray]
    gains: list[np.ndarray]
    freed: list[np.ndarray]
    totals: list[np.ndarray]
    singles: list[np.ndarray]
    calibration: np.ndarray

    def ratios(self, ids: np.ndarray, before: np.ndarray) -> np.ndarray:
        """log10 P(word | word before, toxic) / P(word | word before, ordinary)."""
        wanted = before * np.int64(len(self.words) + 2) + ids
        logs = []
        for keys, gains, freed, totals, singles in zip(self.keys, self.gains, self.freed, self.totals, self.singles, strict=True):
            at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
            gain = np.where(keys[at] == wanted, gains[at], 0.0) if len(keys) else np.zeros(len(ids))
            logs.append(np.log10((gain + freed[before] * singles[ids]) / totals[before]))
        return np.where(ids > 0, logs[1] - logs[0], 0.0)  # no text of either class has the word


def tokens(text: bytes) -> list[bytes]:
    """Whole words; each letter of an unspaced script is a word of its own."""
    if not text.isascii():
        text = UNSPACED.sub(r" \1 ", BETWEEN.sub(" ", text.decode(errors="replace"))).encode()
    return text.translate(PLAIN).split()


def _numbers(texts: list[list[bytes]], words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers, those of the words before (a mark at the start of a text), and the sizes of the texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ids = np.fromiter((x for t in texts for x in map(words.get, t, repeat(0))), np.int64, int(sizes.sum()))
    before = np.concatenate([[0], ids[:-1]])
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    before[starts] = len(words) + 1
    return ids, before, sizes


def count(examples: list[tuple[int, list[bytes]]], discount: float) -> Model:
    """Both models, without calibration.

    An expression counts once per text. In each context the probabilities of all words, the unknown and the mark of
    a start included, sum to one.
    """
    words = {w: k + 1 for k, w in enumerate(sorted({w for _, t in examples for w in t}))}
    base = len(words) + 2
    counted = []
    for label in (0, 1):
        texts = [t for y, t in examples if y == label]
        ids, before, sizes = _numbers(texts, words)
        # Pairs by number first: with the text they would not fit 64 bits.
        key, pair = np.unique(before * np.int64(base) + ids, return_inverse=True)
        text = np.repeat(np.arange(len(texts)), sizes)
        n = np.bincount(np.unique(text * np.int64(max(1, len(key))) + pair) % max(1, len(key)), minlength=len(key)).astype(float)
        single = np.bincount(np.unique(text * np.int64(base) + ids) % base, minlength=base).astype(float)
        counted.append((key, n, single))
    contexts = np.bincount(np.unique(np.concatenate([key for key, _, _ in counted])) % base, minlength=base).astype(float)
    strength = SHARED * (contexts.sum() + FLAT * base)
    shared = (contexts + FLAT) / (contexts.sum() + FLAT * base)
    shares = np.array([single.sum() for _, _, single in counted]) / max(1, sum(single.sum() for _, _, single in counted))
    model = Model(words, [], [], [], [], [], np.zeros(3))
    for share, (key, n, single) in zip(shares, counted, strict=True):
        own, more = discount * share, max(strength * share, 1e-9)
        model.keys.append(key)
        model.gains.append(np.maximum(n - own, 0))
        model.freed.append(np.bincount(key // base, np.minimum(n, own), base) + more)
        model.totals.append(np.bincount(key // base, n, base) + more)
        model.singles.append((np.maximum(single - own, 0) + (np.minimum(single, own).sum() + more) * shared) / (single.sum() + more))
    return model


def measures(model: Model, texts: list[list[bytes]]) -> np.ndarray:
    """For each text: mean ratio, and the highest sum over a stretch divided by the root of its words; 0 without words."""
    ids, before, sizes = _numbers(texts, model.words)
    out = np.zeros((len(texts), 2))
    if not len(ids):
        return out
    sums = np.concatenate([[0], np.cumsum(model.ratios(ids, before))])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    out[:, 0] = (sums[ends] - sums[starts]) / np.maximum(sizes, 1)
    text_end = np.repeat(ends, sizes)
    at, text_end = np.arange(len(ids)), np.repeat(ends, sizes)
    # Over the root of its words, as the chance ratios of a stretch vary: so words that are each a little toxic add up.
    stretch = np.max([(sums[np.minimum(at + n, text_end)] - sums[:-1]) / np.sqrt(np.minimum(n, text_end - at)) for n in range(1, STRETCH + 1)], axis=0)
    some = sizes > 0
    out[some, 1] = np.maximum.reduceat(stretch, starts[some])
    return out


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Newton steps for weights and intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) / len(y) + penalty * w
        h = (x * (p * (1 - p) / len(y))[:, None]).T @ x + penalty * np.eye(len(w))
        w -= np.linalg.solve(h, g)
    return w


def fit(examples: list[tuple[int, bytes]], discount: float = 0.75, folds: int = 4) -> Model:
    """Both models, and a calibration learned on texts that the models judged had not seen.

    Without examples of both labels every text scores their share, or 0.5 if there are none.
    """
    data = [(y, tokens(t)) for y, t in dict.fromkeys(examples)]
    y = np.array([label for label, _ in data], float)
    if len(set(y.tolist())) < 2:
        model = count([(0, []), (1, [])], discount)
        model.calibration[2] = (30 if y[0] else -30) if len(y) else 0
        return model
    model = count(data, discount)
    x = np.zeros((len(data), 2))
    for k in range(folds):
        rest = count([d for i, d in enumerate(data) if i % folds != k], discount)
        x[k::folds] = measures(rest, [t for _, t in data[k::folds]])
    model.calibration = _logistic(x, y)
    return model


def judge(model: Model, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    x = measures(model, texts)
    return 1 / (1 + np.exp(-np.clip(x @ model.calibration[:2] + model.calibration[2], -30, 30))), x


def _score(model: Model, threshold: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            empty = pa.nulls(len(batch))
            texts = pa.RecordBatch.from_arrays([empty, empty, batch.column("text").fill_null("")], ["a", "b", "text"])
            found = [judge(model, [tokens(t) for t in part]) for _, _, part in text_parts(texts, 1 << 20)]
            value = np.concatenate([s for s, _ in found]) if found else np.zeros(0)
            x = np.concatenate([x for _, x in found]) if found else np.zeros((0, 2))
            rest = {n: batch.column(n) for n in batch.schema.names}
            rest |= {"score": pa.array(value), "mean_ratio": pa.array(x[:, 0]), "peak_ratio": pa.array(x[:, 1]), "predicted": pa.array((value >= threshold).astype(np.int32))}
            yield pa.RecordBatch.from_arrays(list(rest.values()), list(rest))

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, threshold: float = 0.3, per_class: int = 3000, sample_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: likelier toxic), ``mean_ratio``, ``peak_ratio`` and ``predicted``.

    Learns from at most ``per_class`` documents and ``sample_bytes`` of each label, among doc_ids for which ``learn``
    holds. Only the text is scored, all of it; a NULL, empty or wordless text has ratios of 0. Columns of ``docs``
    that have these names are replaced.
    """
    own = docs.drop("score", "mean_ratio", "peak_ratio", "predicted")
    model = fit(labelled_sample(own, labels, "toxic", learn, per_class, sample_bytes))
    return own.mapInArrow(tidied(_score(model, threshold)), with_fields(own.schema, "score double, mean_ratio double, peak_ratio double, predicted int"))
