"""A third of all rows shares one key: no task may end up with them.

Each test runs an operator on such rows and reads from Spark's own task metrics how many shuffled rows
the busiest task took. With eight partitions an even share is an eighth; a hot key left whole shows as
a third or more.
"""

import contextlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyproof.operators import counters, dayflags, history, incremental, versions
from tallyproof.operators.checks import BREAK_CHECKS, DUPLICATE_KEYS, reading
from tallyproof.plans import supplied
from tallyproof.sources import overwrite_partitions


@contextlib.contextmanager
def conf(spark, **settings):
    names = {k.replace("__", "."): v for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def busiest_task(spark, run):
    """Most shuffled rows that one task read while ``run`` was going."""
    context, jvm = spark._jsc.sc(), spark._jvm
    store = context.statusStore()
    nothing = jvm.java.util.ArrayList()

    def stages():
        context.listenerBus().waitUntilEmpty()
        quantiles = spark.sparkContext._gateway.new_array(jvm.double, 0)
        found = store.stageList(nothing, False, False, quantiles, nothing)
        return {(found.apply(i).stageId(), found.apply(i).attemptId()) for i in range(found.size())}

    before = stages()
    # Partitions this small would be merged, which says nothing about large ones.
    with conf(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        run().write.format("noop").mode("overwrite").save()
    most = 0
    for stage, attempt in stages() - before:
        tasks = store.taskList(stage, attempt, 10000)
        for i in range(tasks.size()):
            metrics = tasks.apply(i).taskMetrics()
            if metrics.isDefined():
                most = max(most, metrics.get().shuffleReadMetrics().recordsRead())
    return most


@pytest.fixture(scope="module")
def lines(spark, data, tmp_path_factory):
    """Fact rows in eight files; ``hot`` is one value in a third of them."""
    path = str(tmp_path_factory.mktemp("skew") / "fact")
    fact = supplied.fact(spark, data("0.01"))
    mixed = F.when(F.xxhash64("item_id", "k") % 3 == 0, F.lit(7)).otherwise(F.xxhash64("item_id", "l_shipdate"))
    fact.withColumn("hot", mixed).repartition(8).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def total(lines):
    n, hot = lines.agg(F.count(F.lit(1)), F.count_if(F.col("hot") == 7)).first()
    assert hot > n * 0.32
    return n


def test_the_measure_sees_a_hot_task(spark, lines, total):
    assert busiest_task(spark, lambda: lines.repartition(8, "hot")) > total / 3


def test_duplicates(spark, lines, total):
    df = lines.withColumn("item_id", F.col("hot")).withColumn("instance", F.lit("I")).withColumn("dwh_business_date", F.lit(1))
    assert busiest_task(spark, lambda: counters.duplicate_counts(df, DUPLICATE_KEYS)) < total / 5


def test_counters(spark, lines, total):
    df = lines.withColumn("instance", F.when(F.col("hot") == 7, F.lit("I")).otherwise(F.col("instance")))
    on_fact = [c for c in reading(BREAK_CHECKS, "fact") if c.rule == "blank"]
    assert busiest_task(spark, lambda: counters.counters(df, on_fact)) < total / 20


def test_numbering(spark, lines, total):
    df = lines.select("hot", "item_id", "k", "l_shipdate")
    order = ["hot", "l_shipdate", "item_id", "k"]
    assert busiest_task(spark, lambda: versions.numbered(df, order, "n")) < total / 4


def test_newest_row_per_key(spark, lines, total):
    newest = [F.desc("l_shipdate"), F.desc("k")]
    assert busiest_task(spark, lambda: history.latest_per_key(lines, ["hot"], newest)) < total / 5


def test_comparing_tables_full_of_copies(spark, lines, total):
    copies = lines.select(*[
        F.when(F.col("hot") == 7, F.lit(0)).otherwise(F.col(c)).alias(c) for c in ("k", "l_partkey", "l_suppkey", "set_id")
    ])
    assert busiest_task(spark, lambda: history.compare_copies(copies, copies)) < total / 3


SPLIT_JOINS = dict(
    spark__sql__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1k",
    spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
)


@pytest.mark.parametrize("one_day", [False, True])
def test_closing_effective_dates(spark, lines, total, one_day):
    """With thresholds lowered to the size of the data, as 100 TB would exceed the usual ones."""
    start = F.lit(date(2024, 1, 1)) if one_day else F.to_date("l_shipdate")
    rows = lines.select(
        "hot", start.alias("effective_from"), F.lit(None).cast("date").alias("effective_to"), "k", "item_id"
    )
    with conf(spark, **SPLIT_JOINS):
        most = busiest_task(
            spark, lambda: history.scd2_close(rows.where("k % 2 = 0"), rows.where("k % 2 = 1"), ["hot"], ["k", "item_id"])
        )
    assert most < total / 4


def test_rescan_by_shuffle(spark, lines, total):
    keys = lines.select("hot").distinct()
    with conf(spark, **SPLIT_JOINS):
        most = busiest_task(spark, lambda: incremental.rescan(lines.select("hot", "k"), keys))
    assert most < total / 4


def test_writing_a_hot_partition(spark, lines, total, tmp_path):
    """The redistribution that a partition overwrite asks for, and what it writes."""
    with conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="64k"):
        assert busiest_task(spark, lambda: lines.hint("rebalance", "hot")) < total / 4
        few = lines.withColumn("p", F.when(F.col("hot") == 7, F.lit("hot")).otherwise(F.lit("rest"))).select("k", "p")
        overwrite_partitions(few, str(tmp_path / "t"), ["p"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == total


def test_a_hot_day_flag_key(spark, lines, total):
    """A row type that holds most of the latest day, joined to one open failure of the day before."""
    days = lines.select(
        F.when(F.col("k") == 1, F.lit(date(2024, 6, 2))).otherwise(F.lit(date(2024, 6, 3))).alias("cob_date"),
        F.col("dwh_business_date"), F.col("hot").cast("string").alias("row_type"), F.lit("pass").alias("flag"),
        F.lit("N").alias("status"),
    )
    failure = days.limit(1).withColumn("cob_date", F.lit(date(2024, 6, 2))).withColumns(
        {"row_type": F.lit("7"), "flag": F.lit("fail"), "status": F.lit("Y")}
    )
    with conf(spark, **SPLIT_JOINS):
        assert busiest_task(spark, lambda: dayflags.flag_changes(days.unionByName(failure))) < total / 4
