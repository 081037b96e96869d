"""The queries that the repository registers, by name. Each takes (spark, folder of tables)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyproof.functions import settle, surrogate_key, zero_pad
from tallyproof.operators import (
    contracts,
    counters,
    dayflags,
    history,
    incremental,
    quality,
    recon,
    versions,
)
from tallyproof.operators.checks import BREAK_CHECKS, DUPLICATE_KEYS, Check, reading, strict_hierarchy
from tallyproof.plans import supplied

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = datetime(2024, 6, 2, 6, 30, 0)
TODAY = date(2024, 6, 2)
ONE_YEAR = 1998


def _only(label: str) -> list[Check]:
    return [c for c in BREAK_CHECKS if c.label == label]


def filter_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplied.table(spark, sf_dir, "part").where(F.col("p_size") > 10).select("p_partkey", "p_size")


def grain_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.grain_distinct(supplied.fact(spark, sf_dir))


def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.source_counts(supplied.source_status(spark, sf_dir))


def dq_fact_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    on_fact = reading(BREAK_CHECKS, "fact")
    return counters.counters(supplied.fact(spark, sf_dir), on_fact, duplicate_keys=DUPLICATE_KEYS)


def dq_view_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.counters(supplied.fact_view(spark, sf_dir), reading(BREAK_CHECKS, "view"))


def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.duplicate_counts(supplied.fact(spark, sf_dir), DUPLICATE_KEYS)


def dq_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_grain = counters.counters(supplied.fact(spark, sf_dir), [])
    return quality.completeness(per_grain, source_counts(spark, sf_dir))


def dq_fx_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.counters(supplied.fact_view(spark, sf_dir), _only("FX_Rate"))


def dq_ownership_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.counters(supplied.fact_view(spark, sf_dir), _only("Ownership_Hierarchy"))


def dq_ownership_hierarchy_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    strict = [c for c in strict_hierarchy("ownership_code") if c.rule == "hierarchy"]
    return counters.counters(supplied.fact_view(spark, sf_dir), strict)


def dq_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every business date in one plan."""
    fact = supplied.fact(spark, sf_dir)
    view = supplied.fact_view(spark, sf_dir, base=fact)
    return quality.dq_result(fact, view, supplied.source_status(spark, sf_dir), RUN_TS)


def dq_result_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily run: one business date."""
    fact = supplied.fact(spark, sf_dir, ONE_YEAR)
    return quality.dq_result(
        fact,
        supplied.fact_view(spark, sf_dir, base=fact),
        supplied.source_status(spark, sf_dir, ONE_YEAR),
        RUN_TS,
        business_date=ONE_YEAR * 10000 + 101,
    )


def dq_result_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of every date with the active flag, after one date was checked again two hours later."""
    first = dq_result(spark, sf_dir).withColumn(history.ACTIVE, F.lit("Y"))
    again = dq_result(spark, sf_dir).where("dwh_business_date = 19970101").withColumn("run_time", F.col("run_time") + F.expr("INTERVAL 2 HOURS"))
    return history.supersede(first, again, ["dwh_business_date"])


def dq_result_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of every date from counters that were kept, and fresh ones of the dates that have changed since.

    Since the counters were taken, two dates have got a third of their rows and one has lost some that were booked twice.
    """
    now = supplied.fact(spark, sf_dir)
    late = "dwh_business_date IN (19940101, 19970101) AND k % 3 = 0"
    then = now.where(f"NOT ({late})").unionByName(now.where("dwh_business_date = 19950101 AND k % 7 = 1"))
    changed = counters.changed_parts(then, now, "dwh_business_date")
    fresh = incremental.rescan(now, changed, "dwh_business_date")
    sides = []
    for count, old, new in (
        (quality.fact_counters, then, fresh),
        (quality.view_counters, supplied.fact_view(spark, sf_dir, base=then), supplied.fact_view(spark, sf_dir, base=fresh)),
    ):
        sides.append(incremental.replaced(count(old), count(new), changed))
    return quality.judged(*sides, supplied.source_status(spark, sf_dir), RUN_TS)


def count_table_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the count table for every check that failed."""
    booked = recon.count_by_grain(supplied.fact(spark, sf_dir), "bi_count")
    return recon.failures(dq_result(spark, sf_dir), booked, TODAY)


def onfly_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.route_on_fly(dq_result(spark, sf_dir), quality.default_routing(), "dashboard")


def onfly_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.route_on_fly(dq_result(spark, sf_dir), quality.default_routing(), "count_table")


def cob_prev_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dayflags.previous_failures(supplied.cob_data(spark, sf_dir))


def cob_status_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dayflags.flag_changes(supplied.cob_data(spark, sf_dir))


def cob_status_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dayflags.flag_history(supplied.cob_data(spark, sf_dir))


def _logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplied.run_log(spark, sf_dir).select("event_id", "run_date", "run_time", "check_name")


def _stored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _logged(spark, sf_dir).where(F.col("run_date") < F.lit(date(2024, 1, 20)))


def last_load_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.last_load_ts(_stored_log(spark, sf_dir))


def incremental_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.incremental_rows(_logged(spark, sf_dir), _stored_log(spark, sf_dir))


def version_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = supplied.run_log(spark, sf_dir)
    stored = log.select((F.col("event_id") % 101).alias("version_no"))
    hour = F.date_trunc("hour", "run_ts").alias("run_ts")  # many ties: the event decides
    new = log.select("event_id", "run_date", hour, "check_name")
    return versions.assign_versions(new, stored, ("run_date", "run_ts"), ("event_id",))


def high_watermark_per_env(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.high_watermark(supplied.loaded(supplied.lookup(spark, sf_dir)), "created_ts", ["environment"])


def lookup_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = high_watermark_per_env(spark, sf_dir)
    return incremental.delta(supplied.lookup(spark, sf_dir), marks, "created_ts", ["environment"])


def incremental_scan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.scan_keys(lookup_delta(spark, sf_dir), ["environment", "dwh_business_date", "row_type"])


def incremental_rescan(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = incremental_scan_keys(spark, sf_dir)
    return incremental.rescan(supplied.event_fact(spark, sf_dir), keys, partition_column="dwh_business_date")


def incremental_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target after one cycle of the load."""
    facts = supplied.event_fact(spark, sf_dir)
    target = supplied.loaded(facts)
    rows, slices = incremental.cycle(supplied.lookup(spark, sf_dir), facts, target, "created_ts")
    return incremental.replaced(target, rows, slices)


def kpi_theme_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.col("o_orderstatus")
    theme = F.when(state == "F", F.lit("Breaks")).when(state == "O", F.lit("AM")).otherwise(F.lit("MM"))
    kpis = supplied.table(spark, sf_dir, "orders").select("o_orderkey", theme.alias("theme"), "o_totalprice")
    return recon.theme_filter(kpis, "Breaks")


def recon_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recon.recon_counts(supplied.gru_counts(spark, sf_dir), supplied.bi_counts(spark, sf_dir))


def recon_status_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recon.status_colour(recon_counts(spark, sf_dir))


def recon_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recon.count_table(recon_counts(spark, sf_dir), TODAY, carry=["gru_created_date"])


def recon_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    suite = [
        Check("Duplicate", None, "fact", "duplicate"),
        Check("Source_Status", None, "fact", "blank", ("gru_status",)),
        Check("Load_Date", None, "fact", "blank", ("bi_created_date",)),
    ]
    return counters.counters(
        recon_counts(spark, sf_dir), suite, ("dwh_business_date", "row_type", "cluster_type"),
        duplicate_keys=("dwh_business_date", "instance", "row_type"),
    )


def status_domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load states written into the count table as they are, next to the proper ones."""
    proper = recon_result(spark, sf_dir).select("status")
    raw = supplied.source_status(spark, sf_dir).select("status")
    return contracts.domain_violations(proper.unionByName(raw), "status", contracts.COUNT_STATES)


def cluster_domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows whose cluster was lost or left combined in some instances."""
    spoilt = (
        F.when(F.col("instance").isNull(), F.lit(None))
        .when(F.trim("instance") == "", F.lit("NY/NJ"))
        .otherwise(F.col("cluster_type"))
    )
    rows = supplied.fact(spark, sf_dir).select(spoilt.alias("cluster_type"))
    return contracts.domain_violations(rows, "cluster_type", contracts.CLUSTERS)


def update_date_on_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order states as stored, against those that the order's lines now imply."""
    stored = supplied.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderstatus").alias("status"),
        F.lit("has lines").alias("comments"),
        F.to_date("o_orderdate").alias("update_date"),
    )
    low, high = F.min("l_linestatus"), F.max("l_linestatus")
    incoming = (
        supplied.table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.when(low == high, low).otherwise(F.lit("P")).alias("status"),
            F.when(F.count(F.lit(1)) > 1, F.lit("has lines")).alias("comments"),
        )
    )
    return recon.stamp_updates(stored, incoming, ["o_orderkey"], ["status", "comments"], TODAY)


def active_flag_supersede(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = supplied.runs(spark, sf_dir).withColumn("active_flag", F.lit("Y"))
    rerun = F.col("o_orderstatus") == "P"
    return history.supersede(runs.where(~rerun), runs.where(rerun), ["o_custkey", "period"])


def scd2_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = supplied.effective_rows(spark, sf_dir)
    arriving = F.col("o_orderstatus") == "P"
    return history.scd2_close(
        rows.where(~arriving), rows.where(arriving), ["o_custkey"], ["run_time", "o_orderkey"]
    )


def scd2_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history of finished orders, each good for 30 days, after runs of any date: open ones, and some that are limited to 60 days."""
    rows = supplied.effective_rows(spark, sf_dir)
    finished = F.col("o_orderstatus") == "F"
    by = (["o_custkey"], ["run_time", "o_orderkey"])
    # A stored history is a table: it is read several times and not to be built anew each time.
    stored = settle(history.scd2_split(rows.where("false"), rows.where(finished), *by))
    limited = F.when(F.col("o_orderstatus") == "P", F.date_add("effective_from", 60))
    return history.scd2_split(stored, rows.where(~finished).withColumn("effective_to", limited), *by)


def latest_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = supplied.effective_rows(spark, sf_dir)
    return history.latest_active(rows, ["o_custkey"], ["run_time", "o_orderkey"])


def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = supplied.runs(spark, sf_dir)
    return history.latest_run(runs, ["o_custkey", "period"], tie_breakers=["o_orderkey"])


def latest_execution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.latest_execution(supplied.runs(spark, sf_dir), ["o_custkey"], "run_date")


def split_actual_amend(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.col("o_orderstatus")
    flag = F.when(state == "O", F.lit("Y")).when(state == "F", F.lit("N"))
    runs = supplied.runs(spark, sf_dir).withColumn("active_flag", flag)
    actual, amend = history.split_actual_amend(runs, ["o_orderkey", "o_custkey"])
    return actual.withColumn("goes_to", F.lit("actual")).unionByName(
        amend.withColumn("goes_to", F.lit("amend"))
    )


def bau_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = supplied.runs(spark, sf_dir)
    done = F.col("o_orderstatus") == "F"
    return history.bau_union(runs.where(done).withColumn("active_flag", F.lit("N")), runs.where(~done))


def daily_load_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table loaded by batches, after new batches and a repeated one that lost half of its rows."""
    runs = supplied.runs(spark, sf_dir).withColumn("batch_id", F.concat_ws("-", "o_orderstatus", "period"))
    stored = runs.where("o_orderstatus <> 'P'").withColumn("active_flag", F.lit("N"))
    again = runs.where("o_orderstatus = 'P' OR (o_orderstatus = 'F' AND period = 1996 AND o_custkey % 2 = 0)")
    return history.replace_batches(stored, again)


def table_copy_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem, with some lines twice, against a copy that lost the tax of some suppliers and has some lines three times."""
    lines = supplied.table(spark, sf_dir, "lineitem")
    again = lines.where("l_suppkey % 50 IN (3, 5)")
    spoilt = F.when(F.col("l_suppkey") % 50 == 3, F.lit(0.0)).otherwise(F.col("l_tax"))
    copy = lines.unionByName(again).unionByName(lines.where("l_suppkey % 50 = 5")).withColumn("l_tax", spoilt)
    return history.compare_copies(lines.unionByName(again), copy)


CONTRACT = T.StructType([
    T.StructField("dwh_business_date", T.IntegerType(), False),
    T.StructField("instance", T.StringType(), False),
    T.StructField("row_type", T.StringType(), False),
    T.StructField("cluster_type", T.StringType(), False),
    T.StructField("server", T.StringType(), True),
    T.StructField("item_id", T.LongType(), False),
    T.StructField("lvid", T.IntegerType(), True),
    T.StructField("corr_acc_no", T.LongType(), True),
    T.StructField("statement_date", T.DateType(), False),
])


def schema_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f.name for f in CONTRACT.fields if f.name != "server"]
    rows = supplied.fact(spark, sf_dir).select(*names, "agent_code")
    return contracts.schema_contract(rows, CONTRACT)


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ["dwh_business_date", "instance", "row_type", "item_id"]
    return supplied.fact(spark, sf_dir).select(*key, surrogate_key(key).alias("uuid"))


def scalar_lpad(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = supplied.table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", zero_pad(F.col("l_partkey"), 3).alias("padded"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        filter_gt, grain_distinct, source_counts, dq_fact_counters, dq_view_counters, dq_duplicates,
        dq_completeness, dq_fx_rate, dq_ownership_hierarchy, dq_ownership_hierarchy_strict, dq_result,
        dq_result_daily, dq_result_rerun, dq_result_incremental, count_table_failures, onfly_dashboard, onfly_routing, cob_prev_failures, cob_status_change,
        cob_status_history, last_load_ts, incremental_rows, version_assign, high_watermark_per_env,
        lookup_delta, incremental_scan_keys, incremental_rescan, incremental_cycle, kpi_theme_filter, recon_counts,
        recon_status_view, recon_result, recon_counters, status_domain_violations,
        cluster_domain_violations, update_date_on_change, active_flag_supersede, scd2_close, scd2_late,
        latest_active, latest_run, latest_execution, split_actual_amend, bau_union, daily_load_rerun, table_copy_compare,
        schema_contract_violations, scalar_lpad,
    )
}
QUERIES["surrogate_key"] = surrogate_keys
