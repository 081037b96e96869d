"""Late runs, repeatable loads, compaction and partition switching: what is left after each, and after a crash on the way."""

import random
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyproof import sources
from tallyproof.operators import history, incremental
from tallyproof.plans import jobs
from tallyproof.sources import changes, compaction, switching, versioned

SCD = "k string, effective_from date, effective_to date, run int"
START = date(2024, 1, 1)


def day(n):
    return None if n is None else START + timedelta(days=n)


def history_rows(spark, rows):
    return spark.createDataFrame([(k, day(a), day(b), run) for k, a, b, run in rows], SCD)


def swept(rows, days=80):
    """Day by day: which run holds for a key, by the latest start and then the last run; then its intervals."""
    out = []
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key and r[1] is not None]
        held = [max((r for r in own if r[1] <= d and (r[2] is None or r[2] > d)), key=lambda r: (r[1], r[3]), default=None) for d in range(days)]
        for r in own:
            at = [d for d in range(days) if held[d] == r]
            begins = [d for d in at if d - 1 not in at]
            ends = [d + 1 for d in at if d + 1 not in at]
            out += [(key, b, None if e == days else e, r[3]) for b, e in zip(begins, ends, strict=True)] or [(key, r[1], r[1], r[3])]
        out += [r for r in rows if r[0] == key and r[1] is None]
    return sorted(out, key=str)


def numbered(df):
    return sorted([(r.k, r.effective_from and (r.effective_from - START).days, r.effective_to and (r.effective_to - START).days, r.run) for r in df.collect()], key=str)


def test_a_late_run_inside_closed_time(spark):
    stored = history_rows(spark, [("a", 0, 50, 1), ("a", 50, None, 2), ("b", 0, None, 1)])
    late = history_rows(spark, [("a", 20, None, 3)]).drop("effective_to")
    got = history.scd2_split(stored, late, ["k"], ["run"])
    assert numbered(got) == [("a", 0, 20, 1), ("a", 20, 50, 3), ("a", 50, None, 2), ("b", 0, None, 1)]
    corrected = history.scd2_split(got, history_rows(spark, [("a", 5, 10, 4), ("a", 60, 70, 5)]), ["k"], ["run"])
    assert [r for r in numbered(corrected) if r[0] == "a"] == [("a", 0, 5, 1), ("a", 10, 20, 1), ("a", 20, 50, 3), ("a", 5, 10, 4), ("a", 50, 60, 2), ("a", 60, 70, 5), ("a", 70, None, 2)]


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_any_date(spark, seed):
    rng = random.Random(seed)

    def made(n, first):
        rows = []
        for run in range(first, first + n):
            a = rng.randrange(60)
            rows.append((rng.choice(["a", "b", None, "c"]), rng.choice([a, a, None]) if rng.random() < 0.1 else a, rng.choice([None, a, a + rng.randrange(1, 19)]), run))
        return rows

    stored, incoming = made(25, 0), made(15, 100)
    stored = [r for r in swept(stored) if r[0] != "untouched"] + [("untouched", 3, 9, 1), ("untouched", 5, 7, 2)]
    got = numbered(history.scd2_split(history_rows(spark, stored), history_rows(spark, incoming), ["k"], ["run"]))
    touched = {r[0] for r in incoming}
    want = swept([r for r in stored if r[0] in touched] + incoming) + [r for r in stored if r[0] not in touched]
    assert got == sorted(want, key=str)
    for key in touched:
        spans = sorted([(a, 10**6 if b is None else b) for k, a, b, _ in got if k == key and a is not None and a != b])
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_split_without_news_or_with_a_tie(spark):
    stored = history_rows(spark, [("a", 0, 5, 1)])
    assert numbered(history.scd2_split(stored, stored.limit(0), ["k"], ["run"])) == [("a", 0, 5, 1)]
    assert numbered(history.scd2_split(stored.limit(0), stored, ["k"], ["run"])) == [("a", 0, 5, 1)]
    for until in (None, 7):
        with pytest.raises(Exception, match="apart"):
            history.scd2_split(stored, history_rows(spark, [("a", 3, until, 2), ("a", 3, until, 2)]), ["k"], ["run"]).collect()
    with pytest.raises(TypeError):
        history.scd2_split(stored, stored.withColumn("effective_from", F.lit("2024-01-01")), ["k"], ["run"])


def files(path, part=""):
    return sorted(p for p in Path(path).rglob("*.parquet") if part in str(p) and "_changes" not in str(p))


def stamps(path, part):
    return {f: f.stat().st_mtime_ns for f in files(path, part)}


BY = ["active_flag", "d"]
DAY = "k int, d string"


@pytest.fixture
def loaded(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, batch_id string, active_flag string, d string"
    sources.overwrite_partitions(spark.createDataFrame([(1, None, "N", "a b/c"), (2, "one", "Y", "x"), (3, None, "Y", "y")], schema), path, BY)
    return path


def held(spark, path):
    schema = "k int, batch_id string, active_flag string, d string"
    return sorted([(r.k, r.batch_id, r.active_flag, r.d) for r in spark.read.schema(schema).parquet(path).collect()], key=str)


def test_a_repeated_batch_replaces_its_own_rows(spark, loaded):
    base = [(1, None, "N", "a b/c"), (2, "one", "Y", "x"), (3, None, "Y", "y")]
    rows = spark.createDataFrame([(10, "x"), (11, "a+b %c"), (12, None)], DAY)
    before = stamps(loaded, "active_flag=N") | stamps(loaded, "d=y")
    for _ in range(2):
        jobs.load_day(spark, loaded, rows, BY, batch="two")
        assert held(spark, loaded) == sorted([*base, (10, "two", "Y", "x"), (11, "two", "Y", "a+b %c"), (12, "two", "Y", None)], key=str)
    # Repeated with rows elsewhere: they leave the partitions where they were, even with no other rows there.
    jobs.load_day(spark, loaded, spark.createDataFrame([(20, "z")], DAY), BY, batch="two")
    jobs.load_day(spark, loaded, spark.createDataFrame([(30, "z"), (31, "x")], DAY), BY, batch="three")
    assert held(spark, loaded) == sorted([*base, (20, "two", "Y", "z"), (30, "three", "Y", "z"), (31, "three", "Y", "x")], key=str)
    assert not list(Path(loaded).glob("active_flag=Y/d=a+b*")) and not list(Path(loaded).glob("active_flag=Y/d=__HIVE*"))
    # Repeated without any row.
    jobs.load_day(spark, loaded, spark.createDataFrame([], DAY), BY, batch="two")
    assert held(spark, loaded) == sorted([*base, (30, "three", "Y", "z"), (31, "three", "Y", "x")], key=str)
    assert before == stamps(loaded, "active_flag=N") | stamps(loaded, "d=y")
    with pytest.raises(ValueError):
        jobs.load_day(spark, loaded, rows, BY, batch="a/b")


@pytest.mark.parametrize("moved", [0, 1, 2, None])
def test_a_load_that_died_is_finished_by_the_next(spark, loaded, monkeypatch, moved):
    rows = spark.createDataFrame([(10, "x"), (11, "v"), (12, "w")], DAY)
    jobs.load_day(spark, loaded, spark.createDataFrame([(9, "gone")], DAY), BY, batch="two")
    real, steps = changes._fs, []

    class Died(Exception):
        pass

    def dying(spark, path):
        if "/rows/" in str(path):
            steps.append(path)
            if len(steps) > moved:
                raise Died
        return real(spark, path)

    if moved is None:  # before anything is decided
        monkeypatch.setattr(changes, "_write_text", lambda *a: (_ for _ in ()).throw(Died()))
    else:
        decided = changes._carry_out

        def carry_out(*args):
            monkeypatch.setattr(changes, "_fs", dying)
            return decided(*args)

        monkeypatch.setattr(changes, "_carry_out", carry_out)
    with pytest.raises(Died):
        jobs.load_day(spark, loaded, rows, BY, batch="two")
    monkeypatch.undo()
    base = [(1, None, "N", "a b/c"), (2, "one", "Y", "x"), (3, None, "Y", "y")]
    if moved is None:
        assert sources.finish_changes(spark, loaded) == 0 and held(spark, loaded) == sorted([*base, (9, "two", "Y", "gone")], key=str)
    jobs.load_day(spark, loaded, spark.createDataFrame([(40, "y")], DAY), BY, batch="four")
    now = [(10, "two", "Y", "x"), (11, "two", "Y", "v"), (12, "two", "Y", "w")] if moved is not None else [(9, "two", "Y", "gone")]
    assert held(spark, loaded) == sorted([*base, (40, "four", "Y", "y"), *now], key=str)
    jobs.load_day(spark, loaded, rows, BY, batch="two")
    assert held(spark, loaded) == sorted([*base, (40, "four", "Y", "y"), (10, "two", "Y", "x"), (11, "two", "Y", "v"), (12, "two", "Y", "w")], key=str)


def test_rerun_over_a_partition_that_loses_all_rows(spark, loaded):
    changes.rewrite_partitions(spark, loaded, BY, spark.createDataFrame([("x",), ("y",)], "d string"), lambda t: t.where("k = 3"))
    assert held(spark, loaded) == [(1, None, "N", "a b/c"), (3, None, "Y", "y")]
    assert [p.name for p in Path(loaded, "_changes").iterdir() if not p.name.startswith(".")] == []


def test_compaction_of_what_needs_it(spark, tmp_path):
    path, by = str(tmp_path / "t"), ["d"]
    rows = spark.range(20_000).selectExpr("id", "uuid() AS u")
    rows.withColumn("d", F.lit("small x/y")).repartition(30).write.partitionBy("d").parquet(path)
    rows.withColumn("d", F.lit("fine")).coalesce(1).write.mode("append").partitionBy("d").parquet(path)
    rows.unionByName(rows).unionByName(rows).unionByName(rows).withColumn("d", F.lit("hot")).coalesce(1).write.mode("append").partitionBy("d").parquet(path)
    before, content = stamps(path, "d=fine"), spark.read.parquet(path).orderBy("d", "id", "u").collect()
    target = next(iter(before)).stat().st_size
    poor = compaction.wanting(compaction.data_files(spark, path, by), target).collect()
    assert {(r.directory, r.n_files > 1) for r in poor} == {("d=small x%2Fy", True), ("d=hot", False)}
    assert sources.compact_partitions(spark, path, by, target) == 2
    assert stamps(path, "d=fine") == before
    assert 1 <= len(files(path, "d=small")) <= 3 and 3 <= len(files(path, "d=hot")) <= 8
    assert spark.read.parquet(path).orderBy("d", "id", "u").collect() == content
    assert sources.compact_partitions(spark, path, by, target) == 0


def test_small_files_are_read_together_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).withColumn("d", F.col("id") % 3).repartition(20).write.partitionBy("d").parquet(path)
    poor = compaction.wanting(compaction.data_files(spark, path, ["d"])).collect()
    reads = compaction.packed_reads(spark, path, spark.read.parquet(path).schema, poor)
    assert "Exchange" not in reads._jdf.queryExecution().executedPlan().toString()
    assert len(poor) == 3 and reads.count() == 1000 and 3 <= reads.rdd.getNumPartitions() <= 6


def test_nothing_is_replaced_by_a_compaction_that_lost_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(100).withColumn("d", F.lit(1)).repartition(8).write.partitionBy("d").parquet(path)
    before = stamps(path, "")

    class Lossy(history.Watched):
        def __init__(self, df):
            super().__init__(df)
            self.frame = self.frame.where("id < 99")

    monkeypatch.setattr(compaction, "Watched", Lossy)
    with pytest.raises(ValueError, match="nothing was changed"):
        sources.compact_partitions(spark, path, ["d"])
    assert stamps(path, "") == before and spark.read.parquet(path).count() == 100


def test_a_backup_reads_the_table_once(spark, tmp_path, monkeypatch):
    root, backup = str(tmp_path / "t"), str(tmp_path / "b")
    sources.publish(spark.range(100).repartition(10), root)
    taken = []
    monkeypatch.setattr(history, "fingerprint", lambda df, f=history.fingerprint: (taken.append(df), f(df))[1])
    sources.back_up(spark, root, backup)
    sources.compact(spark, root)
    assert len(taken) == 2  # the copy and the compacted table; the original is only read to be written

    class Lossy(history.Watched):
        def __init__(self, df):
            super().__init__(df)
            self.frame = self.frame.where("id < 99")

    monkeypatch.setattr(versioned, "Watched", Lossy)
    with pytest.raises(ValueError, match="validation"):
        sources.back_up(spark, root, str(tmp_path / "c"))


@pytest.fixture
def catalog(spark):
    spark.sql("DROP TABLE IF EXISTS switched")
    spark.createDataFrame([(1, "a b/c", 1), (2, None, 1), (3, "x", 2), (4, "it's", 3)], "v int, g string, d int").write.partitionBy("d", "g").saveAsTable("switched")
    return "switched"


def rows_of(spark, table):
    return sorted([(r.v, r.g, r.d) for r in spark.table(table).collect()], key=str)


def test_partitions_are_switched(spark, catalog):
    touched = spark.createDataFrame([(1,), (3,), (5,)], "d int")
    more = spark.createDataFrame([(10, "it's", 3), (11, "new", 5), (12, None, 1)], "v int, g string, d int")
    for _ in range(2):
        sources.rewrite_table_partitions(spark, catalog, touched, lambda t: t.where("v = 2").unionByName(more))
        assert rows_of(spark, catalog) == sorted([(2, None, 1), (3, "x", 2), (10, "it's", 3), (11, "new", 5), (12, None, 1)], key=str)
    with pytest.raises(ValueError, match="outside"):
        sources.rewrite_table_partitions(spark, catalog, touched, lambda t: t.withColumn("d", F.lit(7)))
    with pytest.raises(ValueError, match="not partitioned"):
        sources.rewrite_table_partitions(spark, catalog, touched.withColumnRenamed("d", "v"), lambda t: t)


def test_another_writer_is_noticed(spark, catalog):
    def slow(table):
        spark.createDataFrame([(99, 2, "x")], "v int, d int, g string").write.mode("append").insertInto(catalog)
        return table

    before = rows_of(spark, catalog)
    with pytest.raises(RuntimeError, match="another writer"):
        sources.rewrite_table_partitions(spark, catalog, spark.createDataFrame([(2,)], "d int"), slow)
    assert rows_of(spark, catalog) == sorted([*before, (99, "x", 2)], key=str)


@pytest.mark.parametrize("steps", [0, 1, 3])
def test_a_switch_that_died_is_finished_by_the_next(spark, catalog, monkeypatch, steps):
    class Died(Exception):
        pass

    done = []

    def dying(name):
        done.append(name)
        if len(done) > steps:
            raise Died
        return real(name)

    real = switching._spec
    touched = spark.createDataFrame([(1,), (2,)], "d int")
    decided = switching._switch

    def switch(*args):
        monkeypatch.setattr(switching, "_spec", dying)
        return decided(*args)

    monkeypatch.setattr(switching, "_switch", switch)
    with pytest.raises(Died):
        sources.rewrite_table_partitions(spark, catalog, touched, lambda t: t.withColumn("v", F.col("v") + 100).where("v <> 103"))
    monkeypatch.undo()
    sources.rewrite_table_partitions(spark, catalog, spark.createDataFrame([(3,)], "d int"), lambda t: t)
    assert rows_of(spark, catalog) == sorted([(101, "a b/c", 1), (102, None, 1), (4, "it's", 3)], key=str)


def test_rescans_open_scattered_dates_only(spark, tmp_path):
    path = str(tmp_path / "fact")
    days = [20200100 + d for d in range(1, 41)]
    spark.createDataFrame([(d, v) for d in days for v in range(3)], "d int, v int").write.partitionBy("d").parquet(path)
    fact = spark.read.parquet(path)

    def opened(df):
        df.collect()
        scan = df._jdf.queryExecution().executedPlan().toString()
        return scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]

    keys = spark.createDataFrame([(20200101,), (20200140,), (None,)], "d int")
    found = incremental.rescan(fact, keys, partition_column="d")
    assert sorted(r.d for r in found.collect()) == [20200101] * 3 + [20200140] * 3
    assert "20200101" in opened(found) and fact.where(incremental.within_range(keys, "d")).select("d").distinct().count() == 2
    many = spark.createDataFrame([(d,) for d in days if d % 10 in (1, 2)], "d int")
    ranged = fact.where(incremental.within_range(many, "d", most=4))
    assert sorted({r.d for r in ranged.collect()}) == [d for d in days if d % 10 in (1, 2)]
    merged = fact.where(incremental.within_range(many, "d", most=2))
    assert {r.d for r in merged.collect()} >= {r[0] for r in many.collect()} and merged.select("d").distinct().count() < 40
    texts = many.select(F.col("d").cast("string"))
    assert fact.where(incremental.within_range(texts, "d", most=2)).count() >= ranged.count()


def test_equal_copies_shuffle_digests_only(spark):
    a = spark.range(200_000).selectExpr("id", "cast(id % 1000 AS string) s", "cast(id AS double) x")
    assert history._differing_buckets(a, a.repartition(3)) == []
    same = history.compare_copies(a, a.orderBy(F.desc("id")))
    assert same.isEmpty() and "Range" not in same._jdf.queryExecution().optimizedPlan().toString()  # no row is looked at again
    other = a.withColumn("x", F.when(F.col("id") == 77, F.lit(None)).otherwise(F.col("x")))
    assert len(history._differing_buckets(a, other)) in (1, 2)
    assert sorted((r.id, r.x, r.count_a, r.count_b) for r in history.compare_copies(a, other).collect() if r.x is None) == [(77, None, 0, 1)]
    assert history.compare_copies(a, other).count() == 2
    typed = a.withColumn("id", F.col("id").cast("int"))
    assert history.compare_copies(a, typed).isEmpty()


def test_a_recheck_reads_changed_partitions_only(spark, data, tmp_path):
    from tallyproof.operators import quality
    from tallyproof.plans import supplied
    from tallyproof.plans.registry import RUN_TS

    path, store = str(tmp_path / "fact"), str(tmp_path / "store")
    by = ["dwh_business_date"]
    fact = supplied.fact(spark, data("0.001"))
    fact.write.partitionBy(*by).parquet(path)
    read = []

    def count(rows):
        read.append({r[0] for r in rows.select(*by).distinct().collect()})
        return quality.fact_counters(rows)

    days = {r[0] for r in fact.select(*by).distinct().collect()}

    def matches():
        return history.compare_copies(sources.recheck(spark, path, by, store, count), quality.fact_counters(spark.read.parquet(path))).isEmpty()

    assert matches() and read == [days]
    assert matches() and read == [days]  # nothing has changed, nothing is read
    spark.read.parquet(path).where("dwh_business_date = 19950101 AND k % 2 = 0").write.mode("append").partitionBy(*by).parquet(path)
    (tmp_path / "fact" / "dwh_business_date=19970101").rename(tmp_path / "gone")
    assert matches() and read == [days, {19950101}]
    on_fact = sources.recheck(spark, path, by, store, count)
    view = supplied.fact_view(spark, data("0.001"), base=spark.read.parquet(path))
    status = supplied.source_status(spark, data("0.001"))
    assert history.compare_copies(quality.judged(on_fact, quality.view_counters(view), status, RUN_TS), quality.dq_result(spark.read.parquet(path), view, status, RUN_TS)).isEmpty()
    assert len(read) == 2 and versioned.current_version(spark, store) == 2


def test_a_watermark_reads_the_newest_partitions(spark, data, tmp_path):
    from tallyproof.plans import supplied

    path, by = str(tmp_path / "t"), ["environment", "dwh_business_date"]
    target = supplied.loaded(supplied.lookup(spark, data("0.001")))
    target.write.partitionBy(*by).parquet(path)
    found = sources.partitioned_watermark(spark, path, by, "created_ts", "dwh_business_date", ["environment"])
    want = incremental.high_watermark(target, "created_ts", ["environment"])
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert len(found.inputFiles()) < len(spark.read.parquet(path).inputFiles()) / 5
    whole = sources.partitioned_watermark(spark, path, by, "created_ts", "dwh_business_date")
    assert whole.first()[0] == target.agg(F.max("created_ts")).first()[0]
    # A newest day without a stamp, and rows without a day: the answer is still that of the whole table.
    rows = spark.createDataFrame([("NY", 20300101, 1), ("NJ", None, 2)], "environment string, dwh_business_date int, event_id long")
    rows.withColumn("created_ts", F.when(F.col("environment") == "NJ", F.lit("2031-01-01").cast("timestamp_ntz"))).write.mode("append").partitionBy(*by).parquet(path)
    found = sources.partitioned_watermark(spark, path, by, "created_ts", "dwh_business_date", ["environment"])
    want = incremental.high_watermark(spark.read.parquet(path), "created_ts", ["environment"])
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    with pytest.raises(ValueError):
        sources.partitioned_watermark(spark, path, by, "created_ts", "created_ts")
