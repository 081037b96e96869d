"""Classifiers and the language model: held-out quality, gradients, and awkward input."""

import math
import os
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyproof.llm import gru, kneser_ney, language_model, quality_mil
from tallyproof.llm.common import fold
from tallyproof.llm.labelled import labelled_sample
from tallyproof.llm.queries import QUERIES

CLASSIFIERS = [(quality_mil.score_quality, "quality"), (kneser_ney.score_toxicity, "toxic")]


def area(scores, labels):
    """Chance that a document of label 1 scores above one of label 0."""
    order = np.argsort(np.argsort(scores)) + 1
    ones = labels == 1
    return (order[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


@pytest.mark.parametrize(("name", "label", "least"), [("op1_attention_quality", "quality", 0.97), ("op9_kneser_ney_toxicity", "toxic", 0.9)])
def test_held_out_documents(spark, data, name, label, least):
    folder = data("0.1")
    scored = QUERIES[name](spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").toPandas()
    assert area(scored["score"].to_numpy(), scored[label].to_numpy()) > least
    assert ((scored["score"] >= 0.3) == (scored["predicted"] == 1)).all() and scored["score"].between(0, 1).all()
    assert (scored["predicted"] == scored[label]).mean() > 0.95


@pytest.mark.parametrize(("score", "label"), CLASSIFIERS)
def test_awkward_documents(spark, awkward, score, label):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (2, 0, 0), (3, 1, 1), (6, 0, 0), (None, 1, 1), (9, None, None), (5, 1, 1)], "doc_id long, quality int, toxic int")
    got = score(awkward, labels, F.lit(True)).collect()
    assert len(got) == awkward.count() and all(0 <= r["score"] <= 1 for r in got)
    by_text = {r["text"]: r["score"] for r in got}
    assert all(r["score"] == pytest.approx(by_text[r["text"]], abs=1e-5) for r in got) and by_text[None] == pytest.approx(by_text[""], abs=1e-5)
    assert score(awkward.where("false"), labels, F.lit(True)).count() == 0
    alone = {r["score"] for r in score(awkward, labels.where(f"{label} = 1"), F.lit(True)).collect()}
    assert min(alone) > 0.99
    none = score(awkward, labels.where("false"), F.lit(True)).collect()
    assert {round(r["score"], 6) for r in none} == {0.5}


def test_passages_do_not_see_other_texts():
    """Each text alone, in order, reversed, and in batches of other sizes."""
    texts = [b"", b"One. Two!", b"", b"9", b"x" * 512, b"a b\n" * 400, b"(end)", b"\tz ", b"", b"caf\xc3\xa9 " * 300]
    alone = [quality_mil.features([t], quality_mil.WordBuckets()) for t in texts]
    for order in (range(len(texts)), range(len(texts) - 1, -1, -1)):
        for size in (1, 2, 3, len(texts)):
            for at in range(0, len(texts), size):
                some = list(order)[at : at + size]
                x, counts = quality_mil.features([texts[k] for k in some], quality_mil.WordBuckets())
                assert counts.tolist() == [alone[k][1][0] for k in some]
                assert np.array_equal(x, np.concatenate([alone[k][0] for k in some]))
    # The same numbers by plain counting over the characters of one passage.
    x = alone[1][0][0]
    kinds = [int(quality_mil.CHAR_CLASS[c]) for c in texts[1] + b" "]
    pairs = Counter(zip(kinds, kinds[1:], strict=False))
    want = np.zeros(256)
    for (a, b), n in pairs.items():
        want[a * quality_mil.CLASSES + b] = math.sqrt(n / sum(pairs.values()))
    assert np.allclose(x[quality_mil.WORDS : quality_mil.WORDS + 256], want)


def test_examples_that_do_not_fit_are_passed_over(spark, prose):
    rows = [(k, prose(k, 20)) for k in range(40)] + [(100, prose(100, 3_000)), (101, prose(0, 20)), (102, prose(0, 20)), (5, prose(5, 21)), (None, "x"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(100, 1), (101, 0), (102, 1), (5, 0)], "doc_id long, mark int")
    texts = {t for _, t in rows}
    for size in (400, 1_000, 1 << 20):
        got = labelled_sample(docs, marks, "mark", F.lit(True), 1_000, size)
        found = [t.decode() for _, t in got]
        assert len(found) == len(set(found)) and set(found) <= texts
        assert all(sum(len(t) for y, t in got if y == label) <= size and all(len(t) <= size // 8 for y, t in got) for label in (0, 1))
    assert len(found) == 42 and {y for y, t in got if t.decode() == prose(0, 20)} == {1}
    assert len(labelled_sample(docs, marks, "mark", F.lit(True), 3, 1 << 20)) == 6


def test_labels_outside_the_fold_are_not_learned(spark, awkward):
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(1, 12)], "doc_id long, quality int, toxic int")
    for score, _ in CLASSIFIERS:
        assert {round(r["score"], 6) for r in score(awkward, labels, F.lit(False)).collect()} == {0.5}


def test_attention_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(float) for k, v in quality_mil.fit([], hidden=5, gate=3).items()}
    p["s"] = rng.normal(size=5)
    x, counts, y = rng.normal(size=(6, quality_mil.WIDTH)), np.array([2, 3, 1]), np.array([1.0, 0.0, 1.0])
    grads = quality_mil._gradients(p, x, counts, y)

    def loss():
        s = quality_mil._forward(p, x, counts)["score"]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    for name in p:
        at = tuple(rng.integers(0, n) for n in p[name].shape)
        kept = p[name][at].copy()
        p[name][at] = kept + 1e-5
        up = loss()
        p[name][at] = kept - 1e-5
        down = loss()
        p[name][at] = kept
        assert grads[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_expressions_of_neither_class_say_nothing():
    texts = [(k % 2, kneser_ney.tokens(f"common words {'bad' if k % 2 else 'good'} end".encode())) for k in range(40)]
    model = kneser_ney.count(texts, 0.75)
    x = kneser_ney.measures(model, [[b"bad"], [b"good"], [b"common"], [b"never", b"seen"], []])
    assert x[0, 1] > 0.5 and x[1, 1] < -0.5 and abs(x[2, 1]) < 0.2 and x[3].tolist() == [0, 0] and x[4].tolist() == [0, 0]


def test_words_are_read_to_their_end_and_unspaced_texts_letter_by_letter():
    assert kneser_ney.tokens("Unbelievable Хорошенький \u201cquoted\u201d".encode()) == [b"unbelievable", "Хорошенький".encode(), b"quoted"]
    assert kneser_ney.tokens("今天天气。好ab".encode()) == [*(c.encode() for c in "今天天气好"), b"ab"]
    assert kneser_ney.tokens("ภาษาไทย".encode()) == [c.encode() for c in "ภาษาไทย"]
    # Toxic and clean words with one beginning, in a spaced script and in texts without any space.
    for bad, good, line in [("хорошомерзкий", "хорошосветлый", "{} слово номер{}"), ("笨蛋", "先生", "今天我们在公园里看见{}然后回家{}")]:
        examples = [(k % 2, line.format(bad if k % 2 else good, "甲乙丙丁戊"[k % 5]).encode()) for k in range(80)]
        model = kneser_ney.fit(examples)
        scores, _ = kneser_ney.judge(model, [kneser_ney.tokens(line.format(w, "己").encode()) for w in (bad, good)])
        assert scores[0] > 0.8 and scores[1] < 0.2


def test_rare_words_back_off_to_shared_contexts():
    texts = [(k % 2, kneser_ney.tokens(f"some common words{' slur' if k in (1, 3, 5) else ''} end".encode())) for k in range(60)]
    texts += [(0, [b"San", b"Francisco"])] * 5 + [(0, [w, b"often"]) for w in (b"a", b"b", b"c", b"d", b"e")]
    model = kneser_ney.count(texts, 0.75)
    # Three texts are enough to say something.
    assert kneser_ney.measures(model, [kneser_ney.tokens(b"some slur end")])[0, 1] > 0.15
    # As many texts, but more contexts.
    assert all(s[model.words[b"often"]] > s[model.words[b"Francisco"]] for s in model.singles)
    base = len(model.words) + 2
    for keys, gains, freed, totals, singles in zip(model.keys, model.gains, model.freed, model.totals, model.singles, strict=True):
        assert (np.bincount(keys // base, gains, base) + freed * singles.sum()) / totals == pytest.approx(np.ones(base))
    # Words that are each a little toxic add up.
    alone, together = kneser_ney.measures(model, [[b"slur"], [b"slur", b"slur"]])[:, 1]
    assert together > alone * 1.2


def test_recurrent_gradients():
    rng = np.random.default_rng(0)
    n = 64
    p = {k: v.astype(float) for k, v in gru.initial(rng.random(n) * 10).items()}
    before, words, h = rng.integers(0, n, (6, 5)), rng.integers(0, n, (6, 5)), np.zeros((5, gru.HIDDEN))
    before[3, 2] = before[0, :] = n
    grads, _, _ = gru.gradients(p, before, words, h)

    def loss():
        states, _, _ = gru.run(p, before, h)
        return -gru.output(p, states.reshape(-1, gru.HIDDEN).astype(float), words.ravel())[0].mean()

    for name in p:
        at = (before[2, 1], 5) if name == "inputs" else tuple(rng.integers(0, s) for s in p[name].shape)
        kept = p[name][at]
        p[name][at] = kept + 1e-2
        up = loss()
        p[name][at] = kept - 1e-2
        down = loss()
        p[name][at] = kept
        assert grads[name][at] == pytest.approx((up - down) / 2e-2, abs=2e-5)


def test_state_is_carried_through_documents():
    rng = np.random.default_rng(1)
    p = gru.initial(np.ones(64))
    sizes = rng.integers(1, 400, 90)
    words = rng.integers(0, 64, sizes.sum())
    together = gru.log_likelihoods(p, words, sizes)
    at = 0
    for n in sizes[:20].tolist():
        own = words[at : at + n]
        states, _, _ = gru.run(p, np.concatenate([[64], own[:-1]])[:, None], np.zeros((1, gru.HIDDEN), np.float32))
        assert together[at : at + n] == pytest.approx(gru.output(p, states[:, 0], own)[0], abs=1e-4)
        at += n


def test_probabilities_sum_to_one():
    p = gru.initial(np.arange(1.0, 65))
    states = np.random.default_rng(2).normal(size=(3, gru.HIDDEN)).astype(np.float32)
    total = sum(np.exp(gru.output(p, states, np.full(3, w))[0]) for w in range(64))
    assert total == pytest.approx(np.ones(3), abs=1e-5)


def lower(text):
    return (text or "").encode().translate(language_model.LOWER).split() + [b""]


@pytest.mark.parametrize("learn", ["some", "none", "all"])
def test_scores(spark, awkward, learn):
    held = {"some": fold("doc_id", 5) == 1, "none": F.lit(True), "all": F.lit(False)}[learn]
    rows = awkward.collect()
    out = lambda d: {"some": zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1, "none": True, "all": False}[learn]
    counts = Counter(w for r in rows if not out(r["doc_id"]) for w in lower(r["text"]))
    n, v = sum(counts.values()), len(counts)
    want = []
    for r in rows:
        words = lower(r["text"])
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        want.append((r["doc_id"], out(r["doc_id"]), len(words), sum(counts[w] > 0 for w in words), n, round(base, 6)))
    got = language_model.score_documents(awkward, held, block_bytes=3000).collect()
    assert sorted([(*r[:5], round(r["base_score"], 6)) for r in got], key=str) == sorted(want, key=str)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert language_model.score_documents(awkward.where("false"), held).count() == 0


def test_model_beats_counts_on_held_out_texts(spark, data):
    got = QUERIES["op4_recurrent_scores"](spark, data("0.01")).where("held_out").toPandas()
    assert got["score"].sum() / got["n_tokens"].sum() > got["base_score"].sum() / got["n_tokens"].sum() + 0.2
    assert (got["score"] > got["base_score"]).mean() > 0.95


FIT = """
import re
from types import SimpleNamespace
from tallyproof.llm import quality_mil
from tallyproof.llm.common import give_back

def held():
    return sum(map(int, re.findall(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

quality_mil.labelled_sample = lambda *args: [(k % 2, b"word%d and other words. " % k * 130) for k in range(3000)]
plain, quality_mil.fit = quality_mil.fit, lambda examples: plain(examples, epochs=1)
quality_mil.with_fields = lambda schema, added: added
docs = SimpleNamespace(schema=None, mapInArrow=lambda f, schema: f)
docs.drop = lambda *names: docs
quality_mil.score_quality(docs, None, None)
before = held()
give_back()
print(before - held())
"""


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory can't be read here")
def test_the_driver_keeps_no_memory_of_the_fit():
    """Features of all examples take some 50 MB, which the system has again after the weights are known."""
    run = subprocess.run([sys.executable, "-c", FIT], capture_output=True, text=True, check=True, cwd=Path(__file__).resolve().parents[2], env={**os.environ, "OMP_NUM_THREADS": "1"})
    assert float(run.stdout) < 20
