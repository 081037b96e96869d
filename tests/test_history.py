"""Day flags, incremental loading, versions and run history on hand-made rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyproof.functions import checkpoint_folder, settle_small, surrogate_key
from tallyproof.operators import dayflags, history, incremental, versions
from tallyproof.plans import supplied

COB = "cob_date date, dwh_business_date date, row_type string, flag string, status string"


def cob(spark, *rows):
    return spark.createDataFrame([(d, d, *rest) for d, *rest in rows], COB)


FRIDAY, SUNDAY, MONDAY = date(2024, 5, 31), date(2024, 6, 2), date(2024, 6, 3)


def test_flag_changes(spark):
    df = cob(
        spark,
        (SUNDAY, "a", "fail", "Y"), (SUNDAY, "b", "fail", "N"),
        (MONDAY, "a", "pass", "Y"), (MONDAY, "b", "fail", "N"), (MONDAY, "c", "pass", None),
        (MONDAY, "d", "other", "N"), (MONDAY, "e", None, "Y"),
    )
    got = [(r.row_type, r.old_status, r.new_status, r.change_type) for r in dayflags.flag_changes(df).collect()]
    assert got == [
        ("a", "Y", "N", "CHANGED"), ("b", "N", "Y", "CHANGED"), ("c", None, "N", "NEW"),
        ("d", "N", "N", "NO CHANGE"), ("e", "Y", "N", "CHANGED"),
    ]
    assert dayflags.flag_history(df).count() == 7
    assert dayflags.flag_changes(df.limit(0)).count() == 0
    assert dayflags.previous_failures(df.limit(0), "prior_available").count() == 0


def test_previous_failures_by_calendar_or_by_data(spark):
    df = cob(spark, (FRIDAY, "a", "fail", "Y"), (FRIDAY, "b", "fail", None), (MONDAY, "a", "pass", "Y"))
    assert dayflags.previous_failures(df).count() == 0
    assert [r[0] for r in dayflags.previous_failures(df, "prior_available").collect()] == ["a"]
    with pytest.raises(ValueError):
        dayflags.previous_failures(df, "next")


def test_repeated_failures_do_not_repeat_the_row(spark):
    df = cob(spark, (SUNDAY, "a", "fail", "Y"), (SUNDAY, "a", "fail", "Y"), (MONDAY, "a", "pass", "Y"), (MONDAY, "b", "pass", "Y"))
    assert [(r.row_type, r.failed_before) for r in dayflags.flag_changes(df).collect()] == [("a", True), ("b", False)]
    assert dayflags.previous_failures(df).count() == 1


LOOKUP = "environment string, created_ts timestamp, k int"
T0, T1, T2 = datetime(2024, 6, 1), datetime(2024, 6, 2), datetime(2024, 6, 3)


def test_delta_per_environment(spark):
    lookup = spark.createDataFrame(
        [("NY", T0, 1), ("NY", T1, 2), ("NY", T2, 3), ("NJ", T1, 4), ("NJ", T2, 5), (None, T0, 6), (None, T1, 7), ("IN", T0, 8)],
        LOOKUP,
    )
    target = spark.createDataFrame([("NY", T1, 0), ("NY", T0, 0), ("NJ", T2, 0), (None, T0, 0)], LOOKUP)
    marks = incremental.high_watermark(target, "created_ts", ["environment"])

    def taken(**options):
        return sorted(r.k for r in incremental.delta(lookup, marks, "created_ts", ["environment"], **options).collect())

    assert taken() == [3, 7, 8]
    assert taken(inclusive=True) == [2, 3, 5, 6, 7, 8]
    assert taken(cold_start="load_none") == [3, 7]
    assert taken(cold_start="load_none", inclusive=True) == [2, 3, 5, 6, 7]
    whole = incremental.high_watermark(target.where("environment = 'NY'"), "created_ts")
    assert incremental.delta(lookup, whole, "created_ts").count() == 2
    empty = incremental.high_watermark(target.limit(0), "created_ts")
    assert incremental.delta(lookup, empty, "created_ts").count() == 8
    assert incremental.delta(lookup, empty, "created_ts", cold_start="load_none").count() == 0


def test_incremental_rows(spark):
    schema = "run_date string, run_time string"
    new = spark.createDataFrame([("2024-06-01", "10:00"), ("2024-06-01", "11:00"), (None, "12:00")], schema)
    stored = spark.createDataFrame([("2024-06-01", "10:00"), ("2024-06-02", None)], schema)
    assert [r.run_time for r in incremental.incremental_rows(new, stored).collect()] == ["11:00"]
    assert incremental.incremental_rows(new, stored.limit(0)).count() == 3
    assert incremental.incremental_rows(new, stored.limit(0), cold_start="load_none").count() == 0
    with pytest.raises(ValueError):
        incremental.incremental_rows(new, stored, cold_start="?")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string", "int"])
def test_watermarks_keep_their_type(spark, kind):
    values = ["7", "8", "9"] if kind == "int" else ["2024-11-03 00:30:00.123456", "2024-11-04 01:30:00.5", "2024-11-05 00:00:00"]
    df = spark.createDataFrame([(v,) for v in values], "v string").select(F.col("v").cast(kind))
    mark = incremental.high_watermark(df.orderBy("v").limit(2), "v")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert incremental.delta(df, mark, "v").count() == 1
            assert incremental.delta(df, mark, "v", inclusive=True).count() == 2
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_incremental_rows_by_date_skip_older_partitions(spark, data, tmp_path):
    path = str(tmp_path / "log")
    log = supplied.run_log(spark, data("0.001")).select("event_id", "run_date", "run_time")
    log.write.partitionBy("run_date").parquet(path)
    new = spark.read.schema(log.schema).parquet(path)
    stored = log.where(F.col("run_date") < F.lit(date(2024, 1, 29)))

    def ids(df):
        return sorted(r.event_id for r in df.collect())

    found = incremental.incremental_rows(new, stored)
    texts = incremental.incremental_rows(*[df.withColumn("run_date", F.col("run_date").cast("string")) for df in (new, stored)])
    assert ids(found) == ids(texts) == ids(new.where(F.col("run_date") >= F.lit(date(2024, 1, 29))))
    empty = stored.limit(0)
    assert incremental.incremental_rows(new, empty).count() == log.count() > new.dropna().count()
    assert incremental.incremental_rows(new, empty, cold_start="load_none").count() == 0
    scan = next(line for line in _plan(incremental.incremental_rows(new, stored)).splitlines() if "FileScan" in line)
    assert "run_date" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_rescan_matches_null_keys(spark):
    fact = spark.createDataFrame([(1, "a", 10), (1, "b", 11), (2, "a", 12), (None, "a", 13), (3, None, 14)], "d int, t string, v int")
    keys = spark.createDataFrame([(1, "a"), (2, "a"), (None, "a"), (2, "a"), (3, None)], "d int, t string")
    for options in ({}, {"partition_column": "d"}):
        assert sorted(r.v for r in incremental.rescan(fact, keys, **options).collect()) == [10, 12, 13, 14], options
        assert incremental.rescan(fact, keys.limit(0), **options).count() == 0
        assert [r.v for r in incremental.rescan(fact, keys.where("d is null"), **options).collect()] == [13]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_delta_reaches_the_reader(spark, data, tmp_path):
    path = str(tmp_path / "lookup")
    supplied.lookup(spark, data("0.001")).write.parquet(path)
    lookup = spark.read.parquet(path)
    found = incremental.delta(lookup, incremental.high_watermark(supplied.loaded(lookup), "created_ts", ["environment"]), "created_ts", ["environment"])
    plan = _plan(found)
    assert "Join" not in plan and "Exchange" not in plan and "GreaterThan" in plan


def test_too_many_environments(spark, monkeypatch):
    monkeypatch.setattr(incremental, "MAX_ENVIRONMENTS", 2)
    rows = spark.createDataFrame([(str(k), T0, k) for k in range(3)], LOOKUP)
    with pytest.raises(ValueError, match="environments"):
        incremental.delta(rows, incremental.high_watermark(rows, "created_ts", ["environment"]), "created_ts", ["environment"])


def test_no_shared_folder_named(monkeypatch):
    class Context:
        folder = None
        getCheckpointDir = lambda self: self.folder
        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        sparkContext = Context()
        conf = {"spark.sql.warehouse.dir": "hdfs://store/warehouse/"}

    assert checkpoint_folder(Session) == Session.sparkContext.folder == "hdfs://store/warehouse/_checkpoints"


def test_long_keys_are_not_broadcast(spark):
    keys = spark.createDataFrame([("x" * 50,), ("y" * 50,)], "k string")
    big = keys.join(settle_small(keys, max_bytes=99), "k")
    small = keys.join(settle_small(keys, max_bytes=100), "k")
    hinted = ["rightHint" in d._jdf.queryExecution().analyzed().toString() or "ResolvedHint" in d._jdf.queryExecution().analyzed().toString() for d in (big, small)]
    assert hinted == [False, True]


def test_rescan_does_not_deal_the_fact_by_key(spark):
    """All rows of a changed date would meet in one task. Nothing is known of the size of the keys before they are counted."""
    fact, keys = spark.range(1000).selectExpr("id % 3 d", "id"), spark.range(1000).selectExpr("id % 2 d")
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = incremental.rescan(fact, keys, "d")
        assert found.count() == 667
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_rescan_opens_touched_partitions_only(spark, data, tmp_path):
    path = str(tmp_path / "fact")
    supplied.lookup(spark, data("0.001")).write.partitionBy("dwh_business_date").parquet(path)
    fact = spark.read.parquet(path)
    keys = fact.where("dwh_business_date >= 20240129").select("dwh_business_date", "row_type").distinct()
    found = incremental.rescan(fact, keys, partition_column="dwh_business_date")
    assert found.count() == fact.where("dwh_business_date >= 20240129").count()
    scan = next(line for line in _plan(found).splitlines() if "FileScan" in line)
    assert "dwh_business_date" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "20240129" in scan


def test_versions_continue(spark):
    new = spark.createDataFrame([("d2", "t1", "x"), ("d1", "t2", "y"), ("d1", "t1", "z")], "run_date string, run_time string, kpid string")
    stored = spark.createDataFrame([(100,), (7,)], "version_no int")
    got = {r.kpid: r.version_no for r in versions.assign_versions(new, stored, tie_breakers=["kpid"]).collect()}
    assert got == {"z": 101, "y": 102, "x": 103}
    fresh = versions.assign_versions(new, stored.limit(0), tie_breakers=["kpid"])
    assert sorted(r.version_no for r in fresh.collect()) == [1, 2, 3]
    assert versions.assign_versions(new.limit(0), stored, tie_breakers=["kpid"]).count() == 0
    with pytest.raises(ValueError):
        versions.assign_versions(new, stored)


def test_versions_equal_row_number_when_most_rows_share_a_stamp(spark, data):
    log = supplied.run_log(spark, data("0.001")).select("event_id", "run_date", "run_ts")
    hot = log.withColumn("run_date", F.when(F.col("event_id") % 3 < 2, F.lit(date(2024, 1, 5))).otherwise(F.col("run_date")))
    order = ["run_date", "run_ts", "event_id"]
    want = hot.select("event_id", F.row_number().over(Window.orderBy(*order)).alias("n"))
    got = versions.numbered(hot, order, "n").select("event_id", "n")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}


def test_supersede(spark):
    schema = "k string, p int, run int, active_flag string"
    stored = spark.createDataFrame([("a", 1, 1, "Y"), ("a", 2, 1, "Y"), (None, 1, 1, "Y"), ("b", 1, 1, "N")], schema)
    incoming = spark.createDataFrame([("a", 1, 2, None), (None, 1, 2, "N"), ("a", 1, 2, None)], schema)
    got = sorted(map(str, map(tuple, history.supersede(stored, incoming, ["k", "p"], "F").collect())))
    assert got == sorted(map(str, [
        ("a", 1, 1, "F"), ("a", 2, 1, "Y"), (None, 1, 1, "F"), ("b", 1, 1, "N"),
        ("a", 1, 2, "Y"), (None, 1, 2, "Y"), ("a", 1, 2, "Y"),
    ]))


SCD = "k string, effective_from date, effective_to date, run int"
D1, D2, D3 = date(2024, 6, 1), date(2024, 6, 2), date(2024, 6, 3)


def test_scd2_close(spark):
    stored = spark.createDataFrame([("a", D1, D2, 1), ("a", D2, None, 1), ("b", D1, None, 1), (None, D1, None, 1)], SCD)
    incoming = spark.createDataFrame([("a", D3, None, 2), ("a", D3, None, 3), (None, D2, None, 2), ("c", D3, None, 1)], SCD)
    got = history.scd2_close(stored, incoming, ["k"], ["run"])
    want = [
        ("a", D1, D2, 1), ("a", D2, D3, 1), ("a", D3, D3, 2), ("a", D3, None, 3), ("b", D1, None, 1),
        (None, D1, D2, 1), (None, D2, None, 2), ("c", D3, None, 1),
    ]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    latest = {(r.k, r.run) for r in history.latest_active(got, ["k"], ["run"]).collect()}
    assert latest == {("a", 3), ("b", 1), (None, 2), ("c", 1)}
    tied = spark.createDataFrame([("a", D3, None, 2), ("a", D3, None, 2)], SCD)
    with pytest.raises(Exception, match="apart"):
        history.scd2_close(stored, tied, ["k"], ["run"]).collect()
    with pytest.raises(ValueError):
        history.latest_run(stored, ["k"], "run")
    with pytest.raises(TypeError):
        history.scd2_close(stored.withColumn("effective_from", F.col("effective_from").cast("timestamp")), incoming, ["k"], ["run"])


def test_latest_active_survives_a_reload_and_looks_back(spark):
    rows = spark.createDataFrame([("a", D1, D2, 1), ("a", D2, None, 1), ("a", D2, None, 2)], SCD)
    once = history.latest_active(rows, ["k"], ["run"]).collect()
    again = history.latest_active(rows.unionByName(rows), ["k"], ["run"]).collect()
    assert [tuple(r) for r in once] == [tuple(r) for r in again] == [("a", D2, None, 2)]
    past = history.latest_active(rows, ["k"], ["run"], F.lit(D1))
    assert [tuple(r) for r in past.collect()] == [("a", D1, D2, 1)]


def test_latest_run_and_latest_execution(spark):
    rows = spark.createDataFrame([(1, "g", 1), (1, "h", 1), (1, "g", 2), (None, "g", 5)], "d int, g string, run_time int")
    assert {tuple(r) for r in history.latest_run(rows, ["d", "g"], tie_breakers=["run_time"]).collect()} == {(1, "h", 1), (1, "g", 2), (None, "g", 5)}
    assert {tuple(r) for r in history.latest_execution(rows, ["d"]).collect()} == {(1, "g", 2), (None, "g", 5)}


def test_split_and_union(spark):
    rows = spark.createDataFrame([(1, "Y"), (2, "N"), (3, None)], "k int, active_flag string")
    actual, amend = history.split_actual_amend(rows, ["k"])
    assert [r.k for r in actual.collect()] == [1] and sorted(r.k for r in amend.collect()) == [2, 3]
    assert {"div_flag", "uuid"} <= set(actual.columns)
    assert sorted(r.active_flag for r in history.bau_union(rows.where("k < 3"), rows.select("k").where("k = 3")).collect()) == ["N", "Y", "Y"]


def test_surrogate_key_keeps_different_keys_apart(spark):
    df = spark.createDataFrame(
        [("a|1:b", "c"), ("a", "1:b|c"), (None, ""), ("", None), ("-", None), (None, None), ("a", "b"), ("ab", "")],
        "x string, y string",
    )
    assert df.select(surrogate_key(["x", "y"]).alias("k")).distinct().count() == 8


def test_compare_copies_and_fingerprint(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "n int, s string")
    assert history.compare_copies(a, a.orderBy(F.desc("n"))).isEmpty()
    b = spark.createDataFrame([("x", 1), (None, 2), ("z", 3), ("q", 4)], "s string, n int")
    got = {tuple(r) for r in history.compare_copies(a, b).collect()}
    assert got == {(1, "x", 2, 1), (4, "q", 0, 1)}
    assert history.fingerprint(a).first() == history.fingerprint(a.repartition(3)).first()
    assert history.fingerprint(a).first() != history.fingerprint(b.select("n", "s")).first()
    with pytest.raises(ValueError):
        history.compare_copies(a, b.drop("s"))
