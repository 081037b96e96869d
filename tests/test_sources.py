"""Readers, writers, table layout and whole jobs."""

from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyproof import sources
from tallyproof.operators import history
from tallyproof.operators.checks import HIERARCHY_COLUMNS
from tallyproof.operators.quality import RESULT_SCHEMA
from tallyproof.plans import jobs, supplied
from tallyproof.sources import versioned
from tallyproof.sources.external import _whole, jdbc_options

STUDENTS = "name,age,grade\nAlice,12,6th\nBob,9,4th\nCharlie,15,8th\nDavid,10,5th\nEve,11,6th\nNoage,,1st\n"


def files(path):
    return [p for p in Path(path).rglob("*.parquet")]


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_csv_filter(spark, tmp_path):
    source, target = tmp_path / "students.csv", str(tmp_path / "out")
    source.write_text(STUDENTS)
    for schema in (None, "name string, age int, grade string"):
        jobs.filter_csv(spark, str(source), target, "age", 10, schema)
        got = sources.read_csv(spark, target)
        assert sorted(r.name for r in got.collect()) == ["Alice", "Charlie", "Eve"]
        assert dict(got.dtypes)["age"] == "int"


def test_literal_rows(spark):
    words = ["Hello", "World", "from", "Spark"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    assert [r.word for r in df.collect()] == words


def test_jdbc_options():
    plain = jdbc_options("jdbc:x:y", "t", properties={"driver": "d"})
    assert plain == {"url": "jdbc:x:y", "dbtable": "t", "driver": "d"}
    split = jdbc_options("u", "t", "id", date(2024, 1, 1), date(2024, 2, 1), 8)
    assert split["partitionColumn"] == "id" and split["lowerBound"] == "2024-01-01" and split["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc_options("u", "t", partition_column="id")
    assert (_whole(Decimal("1.5"), False), _whole(Decimal("1.5"), True), _whole(7, True)) == (1, 2, 7)


def test_a_database_table_through_one_task_must_be_asked_for(spark):
    with pytest.raises(ValueError, match="small"):
        sources.read_jdbc(spark, "jdbc:x:y", "t")


def test_append_goes_by_name(spark):
    spark.sql("DROP TABLE IF EXISTS append_target")
    sources.create_table(spark, "append_target", spark.createDataFrame([], "a int, b string").schema)
    sources.create_table(spark, "append_target", spark.createDataFrame([], "z int").schema)
    sources.append_by_name(spark.createDataFrame([("x", 1)], "b string, a int"), "append_target")
    assert [tuple(r) for r in spark.table("append_target").collect()] == [(1, "x")]
    with pytest.raises(ValueError):
        sources.append_by_name(spark.createDataFrame([(1,)], "a int"), "append_target")
    with pytest.raises(TypeError):
        sources.append_by_name(spark.createDataFrame([("x", "1")], "b string, a string"), "append_target")
    sources.add_columns(spark, "append_target", {"b": "string", "c": "date"})
    assert [tuple(r) for r in spark.table("append_target").collect()] == [(1, "x", None)]


def test_reload_by_sql(spark):
    spark.sql("DROP TABLE IF EXISTS lookup_target")
    sources.create_table(spark, "lookup_target", spark.createDataFrame([], "a int, b string").schema)
    for n in (1, 2):
        spark.createDataFrame([("x", n)], "b string, a int").createOrReplaceTempView("lookup_new")
        sources.reload_by_sql(spark, "lookup_target", "lookup_new")
    assert [tuple(r) for r in spark.table("lookup_target").collect()] == [(2, "x")]


def test_overwrite_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    untouched = [f for f in files(path) if "p=b" in str(f)]
    sources.overwrite_partitions(spark.createDataFrame([(3, "a"), (4, "c")], "v int, p string"), path, ["p"])
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(3, "a"), (2, "b"), (4, "c")}
    assert all(f.exists() for f in untouched)


def test_rewrite_reads_what_it_replaces(spark, tmp_path):
    root = str(tmp_path / "t")
    first = sources.publish(spark.range(10), root)
    sources.staged_rewrite(spark, root, lambda t: t.where("id < 5").unionByName(t))
    assert sources.read_current(spark, root).count() == 15
    assert sources.current_version(spark, root) == first + 1


def test_failed_validation_leaves_the_table_alone(spark, tmp_path):
    root = str(tmp_path / "t")
    sources.publish(spark.range(3), root)
    with pytest.raises(ValueError):
        sources.staged_rewrite(spark, root, lambda t: t.limit(1), validate=lambda t: t.count() == 3)
    assert sources.read_current(spark, root).count() == 3
    sources.staged_rewrite(spark, root, lambda t: t)
    assert sources.current_version(spark, root) == 3


def test_no_table_yet(spark, tmp_path):
    root = str(tmp_path / "none")
    assert sources.current_version(spark, root) is None
    assert sources.retain_versions(spark, root) == []
    for call in (sources.read_current, sources.compact):
        with pytest.raises(FileNotFoundError):
            call(spark, root)


def test_compaction(spark, data, tmp_path):
    root = str(tmp_path / "t")
    df = supplied.table(spark, data("0.001"), "lineitem").repartition(40)
    sources.publish(df, root)
    sources.compact(spark, root)
    before, after = (files(tmp_path / "t" / f"version-0000000{n}") for n in (1, 2))
    assert (len(before), len(after)) == (40, 1)
    assert history.compare_copies(df, sources.read_current(spark, root)).isEmpty()
    size = after[0].stat().st_size
    sources.compact(spark, root, target_file_bytes=size // 3)
    assert 3 <= len(files(tmp_path / "t" / "version-00000003")) <= 5
    assert history.compare_copies(df, sources.read_current(spark, root)).isEmpty()


def test_compaction_splits_a_hot_partition(spark, data, tmp_path):
    root = str(tmp_path / "t")
    lines = supplied.table(spark, data("0.001"), "lineitem")
    hot = lines.withColumn("p", F.when(F.col("l_orderkey") % 100 == 0, F.lit(None)).otherwise(F.lit("Y"))).repartition(12)
    sources.publish(hot, root, ["p"])
    sizes = {r.p: r.n_bytes for r in versioned.file_sizes(spark, f"{root}/version-00000001", ["p"]).collect()}
    sources.compact(spark, root, ["p"], target_file_bytes=sizes["Y"] // 6)
    written = files(tmp_path / "t" / "version-00000002")
    assert 3 <= len([f for f in written if "p=Y" in str(f)]) <= 7
    assert len([f for f in written if "p=__HIVE_DEFAULT" in str(f)]) <= 2
    assert history.compare_copies(hot, sources.read_current(spark, root)).isEmpty()
    sources.compact(spark, root, ["p"], target_file_bytes=sizes["Y"] // 6)
    assert sources.current_version(spark, root) == 2  # nothing left to do
    assert history.compare_copies(hot, sources.read_current(spark, root)).isEmpty()


def test_full_refresh_of_a_small_table_is_one_file(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in (5, 7):
        sources.full_refresh(spark.range(n).repartition(4), root)
    assert sources.read_current(spark, root).count() == 7
    assert len(files(tmp_path / "t" / "version-00000002")) == 1


def test_a_marker_being_written_and_a_version_in_between(spark, tmp_path):
    root = str(tmp_path / "t")
    sources.publish(spark.range(3), root)
    spark.range(9).write.parquet(f"{root}/version-00000002")
    (tmp_path / "t" / "version-00000002" / "_PUBLISHED").touch()
    assert sources.current_version(spark, root) == 1 and sources.read_current(spark, root).count() == 3

    def slow(table):
        sources.publish(spark.range(5), root)
        return table

    with pytest.raises(RuntimeError, match="came between"):
        sources.staged_rewrite(spark, root, slow)
    assert sources.read_current(spark, root).count() == 5


def test_retention(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in range(4):
        sources.publish(spark.range(n + 1), root)
    with pytest.raises(ValueError):
        sources.publish(spark.range(1), root, validate=lambda t: False)
    sources.publish(spark.range(9), root)
    assert sources.retain_versions(spark, root, keep=2) == [1, 2, 3, 5]
    assert sources.read_current(spark, root).count() == 9
    assert sources.retain_versions(spark, root, keep=2) == []
    with pytest.raises(ValueError):
        sources.retain_versions(spark, root, keep=0)


def test_backup_and_compact(spark, tmp_path):
    root, backup = str(tmp_path / "t"), str(tmp_path / "b")
    sources.publish(spark.range(100).repartition(10), root)
    jobs.back_up_and_compact(spark, root, backup)
    assert rows(sources.read_current(spark, backup)) == rows(sources.read_current(spark, root)) == rows(spark.range(100))
    assert len(files(tmp_path / "t" / "version-00000002")) == 1
    assert jobs.copy_confirmed(sources.read_current(spark, root), sources.read_current(spark, backup))
    assert not jobs.copy_confirmed(spark.range(100), spark.range(99))


def test_historical_load(spark, tmp_path):
    root = str(tmp_path / "t")
    jobs.load_history(spark.createDataFrame([(1, "N"), (2, "Y")], "k int, active_flag string"), root, ["active_flag"])
    assert {tuple(r) for r in sources.read_current(spark, root).collect()} == {(1, "N"), (2, "Y")}


def stamps(path, part):
    return {f: f.stat().st_mtime_ns for f in files(path) if part in str(f)}


def test_daily_load_writes_touched_partitions_only(spark, tmp_path):
    path, by = str(tmp_path / "t"), ["active_flag", "d"]
    old = spark.createDataFrame([(1, 1, "N"), (2, 1, "Y"), (3, 2, "Y"), (4, None, "Y")], "k int, d int, active_flag string")
    sources.overwrite_partitions(old, path, by)
    before = {part: stamps(path, part) for part in ("active_flag=N", "d=1")}
    jobs.load_day(spark, path, spark.createDataFrame([(5, 2), (6, 3), (7, None)], "k int, d int"), by)
    assert {(r.k, r.d, r.active_flag) for r in spark.read.parquet(path).collect()} == {
        (1, 1, "N"), (2, 1, "Y"), (3, 2, "Y"), (4, None, "Y"), (5, 2, "Y"), (6, 3, "Y"), (7, None, "Y")}
    assert all(stamps(path, part) == files_ for part, files_ in before.items())


def test_split_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "N"), (2, "Y")], "k int, active_flag string")
    actual, amend = str(tmp_path / "actual"), str(tmp_path / "amend")
    jobs.split_table(df, ["k"], actual, amend)
    assert [r.k for r in sources.read_current(spark, actual).collect()] == [2]
    assert [r.k for r in sources.read_current(spark, amend).collect()] == [1]


def test_rerun_keeps_one_active_row_per_key(spark, tmp_path):
    path, by = str(tmp_path / "t"), ["d", "active_flag"]
    sources.overwrite_partitions(spark.createDataFrame([(2, "z", 0, "Y")], "d int, g string, run int, active_flag string"), path, by)
    before = stamps(path, "d=2")
    for run in (1, 2, 3):
        jobs.record_run(spark, path, spark.createDataFrame([(1, "a", run), (1, None, run)], "d int, g string, run int"), ["d", "g"], by)
    table = spark.read.parquet(path)
    assert {(r.g, r.run) for r in table.where("active_flag = 'Y' and d = 1").collect()} == {("a", 3), (None, 3)}
    assert table.count() == 7 and stamps(path, "d=2") == before
    with pytest.raises(ValueError):
        jobs.record_run(spark, path, table.drop("active_flag"), ["g"], by)


@pytest.fixture
def breaks(spark, data):
    spark.sql("DROP TABLE IF EXISTS dq_out")
    sources.create_table(spark, "dq_out", RESULT_SCHEMA)
    sf = data("0.001")
    supplied.fact(spark, sf).createOrReplaceTempView("breaks_fact")
    supplied.fact_view(spark, sf).createOrReplaceTempView("breaks_view")
    supplied.source_status(spark, sf).createOrReplaceTempView("breaks_status")
    return ("breaks_fact", "breaks_view", "breaks_status", "dq_out")


def test_breaks_job_appends_every_run(spark, breaks):
    for hour in (5, 6):
        assert jobs.run_breaks(spark, *breaks, business_date=19980101, now=datetime(2024, 6, 2, hour), theme="T")
    out = spark.table("dq_out")
    grains = spark.table("breaks_fact").where("dwh_business_date = 19980101").select("instance", "row_type", "cluster_type").distinct().count()
    assert out.count() == 2 * grains
    latest = history.latest_execution(out, ["dwh_business_date"])
    assert latest.count() == grains and {r.run_time for r in latest.collect()} == {datetime(2024, 6, 2, 6)}
    assert {(r.theme, r.issue_object) for r in out.collect()} == {("T", "breaks_fact")}


def test_breaks_job_without_rows_writes_nothing(spark, breaks):
    assert not jobs.run_breaks(spark, *breaks, now=datetime(2024, 6, 2))
    assert spark.table("dq_out").count() == 0
    assert jobs.default_business_date(datetime(2024, 3, 1, 0, 5)) == 20240229


def test_breaks_job_with_a_missing_grain_writes_nothing(spark, breaks):
    spark.table("breaks_view").where("instance <> 'INST_C'").createOrReplaceTempView("partial_view")
    fact, _, status, out = breaks
    with pytest.raises(Exception, match="missing from the view"):
        jobs.run_breaks(spark, fact, "partial_view", status, out, business_date=19980101)
    assert spark.table("dq_out").count() == 0
    assert len(HIERARCHY_COLUMNS) == 16


def test_breaks_command_line(spark, breaks):
    fact, view, status, out = breaks
    jobs.main(["--fact", fact, "--view", view, "--status", status, "--result", out, "--business-date", "19990101"])
    assert spark.table("dq_out").select("dwh_business_date").distinct().first()[0] == 19990101


def test_breaks_job_with_an_active_flag(spark, breaks):
    fact, view, status, _ = breaks
    spark.sql("DROP TABLE IF EXISTS dq_flagged")
    sources.create_table(spark, "dq_flagged", T.StructType([*RESULT_SCHEMA.fields, T.StructField("active_flag", T.StringType())]), ["dwh_business_date"])
    for day, hour in ((19980101, 5), (19970101, 5), (19980101, 6)):
        assert jobs.run_breaks(spark, fact, view, status, "dq_flagged", business_date=day, now=datetime(2024, 6, 2, hour))
    flags = {tuple(r) for r in spark.table("dq_flagged").selectExpr("dwh_business_date", "hour(run_time)", "active_flag").distinct().collect()}
    assert flags == {(19980101, 5, "N"), (19980101, 6, "Y"), (19970101, 5, "Y")}


def test_incremental_cycle(spark, data):
    """Watermarks in the middle of a day, all environments, one of them new, NULL keys: the target becomes the source, again and again."""
    for name in ("inc_target", "inc_lookup", "inc_fact"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    sf = data("0.001")
    supplied.lookup(spark, sf).createOrReplaceTempView("inc_lookup_v")
    facts = supplied.event_fact(spark, sf)
    facts.createOrReplaceTempView("inc_fact_v")
    supplied.loaded(facts).write.partitionBy("dwh_business_date").saveAsTable("inc_target")
    before = {tuple(r) for r in spark.table("inc_target").select(*facts.columns).where("environment = 'NY'").collect()}
    jobs.run_incremental(spark, "inc_lookup_v", "inc_fact_v", "inc_target", "created_ts", only="NJ")
    now = spark.table("inc_target").select(*facts.columns)
    assert {tuple(r) for r in now.where("environment = 'NY'").collect()} == before
    assert history.compare_copies(now.where("environment = 'NJ'"), facts.where("environment = 'NJ'")).isEmpty()
    for _ in range(2):
        jobs.run_incremental(spark, "inc_lookup_v", "inc_fact_v", "inc_target", "created_ts")
        assert history.compare_copies(spark.table("inc_target").select(*facts.columns), facts).isEmpty()
    facts.write.saveAsTable("inc_fact")
    with pytest.raises(ValueError, match="partitioned"):
        jobs.run_incremental(spark, "inc_lookup_v", "inc_fact_v", "inc_fact", "created_ts")
