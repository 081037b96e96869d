"""The pipeline's stages against brute force, and as a whole."""

from collections import Counter

import pytest

import corpus_pipeline
from tallyproof.llm import quality_mil
from tallyproof.llm.common import fold
from tallyproof.llm.queries import WEIGHTS

from .test_near import bag, classes_of, jaccard_p
from .test_repeats import words_kept
from .test_scans import contaminated, mixed


@pytest.fixture(scope="module")
def stages(spark, data, tmp_path_factory):
    """What each stage read and returned."""
    folder, out = data("0.001"), tmp_path_factory.mktemp("stages")
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(str(out / name))
        after = spark.read.parquet(str(out / name))
        seen[name] = (docs, after)
        docs = after
    return seen


def test_names_and_columns(stages):
    assert list(stages) == ["quality classifier", "MinHash near-dedup", "substring dedup", "benchmark decontamination", "mixing to target weights"]
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.schema == before.schema, name


def test_quality(spark, data, stages):
    before, after = stages["quality classifier"]
    scored = quality_mil.score_quality(before, spark.read.parquet(f"{data('0.001')}/labels.parquet"), fold("doc_id", 5) != 0)
    assert {r["doc_id"] for r in scored.where("score >= 0.3").collect()} == {r["doc_id"] for r in after.collect()}
    assert 0 < after.count() < before.count()


def test_near_dedup(stages):
    before, after = stages["MinHash near-dedup"]
    bags = {r["doc_id"]: bag(r["text"]) for r in before.collect()}
    ids = sorted(bags)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if bags[a] and len(bags[a]) < 3 * len(bags[b]) and not bags[a].keys().isdisjoint(bags[b]) and jaccard_p(bags[a], bags[b]) >= 0.8 - 1e-12]
    low = classes_of(ids, links)
    assert {r["doc_id"] for r in after.collect()} == {d for d in ids if low[d] == d} and after.count() < before.count()


def test_one_of_equal_rows_stays(spark, data, prose):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(1, a, 1), (1, a, 2), (1, a, 2), (2, a, 3), (3, b, 4), (None, a, 5), (None, c, 6), (None, c, 7), (4, "", 8), (None, "", 9), (None, "", 9), (5, "", 8), (6, None, 1), (None, None, 2)]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string, _same long")
    got = corpus_pipeline.near_dedup(spark, docs, data("0.001"))
    assert got.columns == docs.columns
    assert sorted([(r["doc_id"], r["text"]) for r in got.collect()], key=str) == sorted([(1, a), (3, b), (None, c), (4, ""), (5, ""), (None, ""), (6, None), (None, None)], key=str)


def test_substring_dedup(stages):
    before, after = stages["substring dedup"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    want = {d: (n, gone) for d, n, gone, _ in words_kept(rows, 13)}
    got = {r["doc_id"]: r for r in after.collect()}
    assert set(got) == {d for d, (n, gone) in want.items() if not gone or gone < n}
    assert all(len(got[d]["text"].encode().split()) == want[d][0] - want[d][1] and got[d]["n_chars"] == len(got[d]["text"]) for d in got)


def test_decontamination(spark, data, stages):
    before, after = stages["benchmark decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{data('0.001')}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert {r["doc_id"] for r in after.collect()} == {d for d, _, _, _, hit in contaminated(rows, items, 10) if not hit}


def test_mixture(stages):
    before, after = stages["mixing to target weights"]
    assert after.columns == [*before.columns, "domain", "epoch"]
    want = mixed([(r["doc_id"], r["text"], f"domain{int(r['source'][3:]) % 4}", r["lang"], r["source"]) for r in before.collect()], WEIGHTS, (3, 5), 2, 7)
    got = Counter(r["doc_id"] for r in after.collect())
    assert got == {d: copies for d, *_, copies in want if copies}


def test_run(spark, data, stages):
    got = corpus_pipeline.run(spark, data("0.001"))
    want = stages["mixing to target weights"][1]
    assert sorted(got.select("doc_id", "epoch").collect()) == sorted(want.select("doc_id", "epoch").collect())


def test_awkward_documents(spark, data, awkward, tmp_path):
    """Every stage by itself over NULLs, empty and repeated rows, and columns of clashing names."""
    own = awkward.drop("domain")  # the mixture adds one
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, own, data("0.001")).columns[: len(own.columns)] == own.columns, name
        assert stage(spark, own, data("0.001")).count() > 0, name
        assert stage(spark, own.where("false"), data("0.001")).count() == 0, name
