"""The shape of every registered query's plan: what would hurt on a large table must not be in it."""

import re

import pytest

from tallyproof.operators import counters
from tallyproof.operators.checks import DUPLICATE_KEYS
from tallyproof.operators.history import compare_copies
from tallyproof.plans import supplied
from tallyproof.plans.registry import QUERIES
from tallyproof.sources import write_bucketed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_nothing_that_hurts_at_scale(name, spark, data):
    text = plan(QUERIES[name](spark, data("0.001")))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)
    assert not re.search(r"EvalPython|MapInPandas|MapInArrow|FlatMapGroups", text)
    if name != "version_assign":  # its only such window runs over one row per partition
        assert not re.search(r"Window \[.*\n\W*(Sort .*\n\W*)?Exchange SinglePartition", text)


@pytest.mark.parametrize("name", ["latest_active", "latest_run"])
def test_newest_row_is_picked_before_the_shuffle(name, spark, data):
    text = plan(QUERIES[name](spark, data("0.001")))
    assert re.search(r"row_number\(\), 1, Final[\s\S]*Exchange hashpartitioning[\s\S]*row_number\(\), 1, Partial", text)


def test_duplicate_count_aggregates_by_hash_and_does_not_sort_rows(spark, data):
    text = plan(QUERIES["dq_duplicates"](spark, data("0.001")))
    assert "SortAggregate" not in text
    assert text.count("partial_count(1)") >= 3
    # The one window runs over grains, above the finished aggregate.
    assert len(re.findall(r"\bWindow \[", text)) == 1


def test_counters_share_one_scan_per_pass(spark, data):
    text = plan(QUERIES["dq_view_counters"](spark, data("0.001")))
    assert text.count("l_orderkey") == 0, "columns that no check needs are not read"
    assert len(re.findall(r"FileScan parquet \[l_", text)) == 1
    fact = plan(QUERIES["dq_fact_counters"](spark, data("0.001")))
    assert len(re.findall(r"FileScan parquet \[l_", fact)) == 2


def test_daily_run_pushes_its_date_to_the_files(spark, data):
    df = QUERIES["dq_result_daily"](spark, data("0.001"))
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(formatted)
    assert text.count("GreaterThanOrEqual(l_shipdate,1998-01-01") == 3
    assert text.count("LessThan(l_shipdate,1999-01-01") == 3
    assert text.count("GreaterThanOrEqual(o_orderdate,1998-01-01") == 1


def test_filter_is_pushed_down(spark, data):
    text = plan(QUERIES["filter_gt"](spark, data("0.001")))
    assert "GreaterThan(p_size,10)" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in text


def test_duplicates_of_a_bucketed_fact_are_counted_where_they_lie(spark, data):
    fact = supplied.fact(spark, data("0.001"))
    spark.sql("DROP TABLE IF EXISTS bucketed_fact")
    write_bucketed(fact, "bucketed_fact", DUPLICATE_KEYS, 8)
    table = spark.table("bucketed_fact")
    counted = counters.duplicate_counts(table, DUPLICATE_KEYS)
    assert compare_copies(counted, counters.duplicate_counts(fact, DUPLICATE_KEYS)).isEmpty()
    assert "hashpartitioning(item_id" in plan(counters.duplicate_counts(fact, DUPLICATE_KEYS))
    assert "hashpartitioning(item_id" not in plan(counted) and "Bucketed: true" in plan(counted)
