"""Source-to-warehouse reconciliation of row counts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from tallyproof.functions import null_safe
from tallyproof.operators.checks import BREAK_CHECKS, GRAIN, Check
from tallyproof.operators.contracts import COUNT_STATES
from tallyproof.operators.quality import DATE


def as_date(business_date: Column) -> Column:
    """Business date held as the number yyyyMMdd, as a DATE."""
    return F.to_date(business_date.cast("string"), "yyyyMMdd")


def count_by_grain(
    df: DataFrame, name: str, grain: Sequence[str] = GRAIN, carry: Sequence[Column] = ()
) -> DataFrame:
    """Rows per grain, with further aggregates carried along. Reduce raw tables with this first."""
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias(name), *carry)


def recon_counts(
    source: DataFrame,
    target: DataFrame,
    grain: Sequence[str] = GRAIN,
    source_count: str = "gru_count",
    target_count: str = "bi_count",
) -> DataFrame:
    """Both counts side by side for every grain that either side knows.

    Inputs hold one row per grain; further columns of either (load status, created and updated
    stamps) are carried through. A side that lacks the grain counts 0. ``bi_status`` looks at the
    counts alone: equal is ``success``, anything else ``fail``.
    """
    joined = source.alias("s").join(target.alias("t"), null_safe("s", "t", grain), "full_outer")
    counts = {source_count: "s", target_count: "t"}
    # Where one side is absent its key is NULL, and so is a NULL key that matched: coalesce fits both.
    keys = [F.coalesce(f"s.{g}", f"t.{g}").alias(g) for g in grain]
    numbers = [F.coalesce(f"{a}.{n}", F.lit(0).cast("bigint")).alias(n) for n, a in counts.items()]
    carried = [
        F.col(f"{a}.{c}").alias(c)
        for a, df in (("s", source), ("t", target))
        for c in df.columns
        if c not in (*grain, source_count, target_count)
    ]
    both = joined.select(*keys, *numbers, *carried)
    equal = F.col(source_count) == F.col(target_count)
    return both.withColumn("bi_status", F.when(equal, F.lit("success")).otherwise(F.lit("fail")))


def _recopied_later(source_status: str, source_updated: str, date_col: str) -> Column:
    """The source copied its snapshot on another day than the business date."""
    copied = F.lower(F.trim(source_status)) == "snapshot copied"
    return copied & (F.to_date(source_updated) != as_date(F.col(date_col)))


def status_colour(
    recon: DataFrame,
    source_status: str = "gru_status",
    source_updated: str = "gru_updated_date",
    target_created: str = "bi_created_date",
    date_col: str = DATE,
) -> DataFrame:
    """Reconciliation view: ``bi_status`` renamed to ``status``, and a colour.

    red     counts differ, or the source load failed
    purple  counts agree; the source copied its snapshot on another day
    amber   counts agree; the warehouse loaded on another day
    green   everything else
    """
    source_failed = F.lower(F.trim(source_status)).isin("failed", "fail")
    loaded_later = F.to_date(target_created) != as_date(F.col(date_col))
    colour = (
        F.when((F.col("status") != "success") | source_failed, F.lit("red"))
        .when(_recopied_later(source_status, source_updated, date_col), F.lit("purple"))
        .when(loaded_later, F.lit("amber"))
        .otherwise(F.lit("green"))
    )
    return recon.withColumnRenamed("bi_status", "status").withColumn("colour", colour)


def count_table(
    recon: DataFrame,
    today: date,
    theme: str = "Breaks",
    kpi_id: str = "",
    issue_object: str = "fact",
    carry: Sequence[str] = (),
    source_count: str = "gru_count",
    target_count: str = "bi_count",
    source_status: str = "gru_status",
    source_updated: str = "gru_updated_date",
) -> DataFrame:
    """Rows for the count table, each in one of the four allowed states.

    A mismatch is ``Data missing`` while the warehouse holds fewer rows than the source, and a
    ``Reload`` when it holds more: those rows no longer exist at the source and must be loaded again.
    Agreeing counts are a ``Refill`` if the source copied its snapshot on another day, else all good.
    ``carry`` adds columns of ``recon`` (such as the lookup's created stamp) after the fixed eleven.
    """
    good, missing, reload, refill = (F.lit(s) for s in COUNT_STATES)
    state = (
        F.when(F.col(target_count) < F.col(source_count), missing)
        .when(F.col(target_count) > F.col(source_count), reload)
        .when(_recopied_later(source_status, source_updated, DATE), refill)
        .otherwise(good)
    )
    return recon.select(
        F.lit(theme).alias("theme"),
        F.lit(kpi_id).alias("kpi_id"),
        F.lit(issue_object).alias("issue_object"),
        as_date(F.col(DATE)).alias(DATE),
        "instance",
        "row_type",
        F.col(source_count).alias("gru_counts"),
        F.col(target_count).alias("bi_counts"),
        "cluster_type",
        state.alias("status"),
        F.lit(today).cast("date").alias("update_date"),
        *carry,
    )


#: Contract of the count table for :func:`tallyproof.operators.contracts.schema_contract`. Counts are
#: BIGINT, because a grain of a large table can exceed INT, and the row type is text as in the fact.
COUNT_SCHEMA = T.StructType([
    T.StructField("theme", T.StringType(), False),
    T.StructField("kpi_id", T.StringType(), True),
    T.StructField("issue_object", T.StringType(), False),
    T.StructField("dwh_business_date", T.DateType(), False),
    T.StructField("instance", T.StringType(), True),
    T.StructField("row_type", T.StringType(), True),
    T.StructField("gru_counts", T.LongType(), False),
    T.StructField("bi_counts", T.LongType(), False),
    T.StructField("cluster_type", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("update_date", T.DateType(), False),
])


def failures(result: DataFrame, booked: DataFrame, today: date, checks: Sequence[Check] = BREAK_CHECKS, target_count: str = "bi_count") -> DataFrame:
    """Count-table rows for the checks that failed, one per grain and check, of :data:`COUNT_SCHEMA`.

    ``result`` is the wide check result and ``booked`` the warehouse's rows per grain. ``kpi_id`` names the check's column.
    Duplicates are a ``Reload``, since the grain has to be loaded again; empty fields are ``Data missing``. Constant
    checks have no records.
    """
    _, missing, reload, _ = COUNT_STATES
    names = {c.result: c.rule for c in checks if c.result and c.rule not in ("constant", "completeness")}
    long = result.unpivot(["theme", "issue_object", *GRAIN, "completeness_count"], list(names), "kpi_id", "colour").where("colour = 'Red'")
    repeated = F.col("l.kpi_id").isin([n for n, rule in names.items() if rule == "duplicate"])
    return long.alias("l").join(booked.alias("b"), null_safe("l", "b", GRAIN), "left").select(
        "l.theme", "l.kpi_id", "l.issue_object",
        as_date(F.col(f"l.{DATE}")).alias(DATE),
        "l.instance", "l.row_type",
        F.col("l.completeness_count").cast("bigint").alias("gru_counts"),
        F.coalesce(F.col(f"b.{target_count}"), F.lit(0).cast("bigint")).alias("bi_counts"),
        "l.cluster_type",
        F.when(repeated, F.lit(reload)).otherwise(F.lit(missing)).alias("status"),
        F.lit(today).cast("date").alias("update_date"),
    )


def theme_filter(df: DataFrame, theme: str, column: str = "theme") -> DataFrame:
    """Rows of one theme."""
    return df.where(F.col(column) == theme)


def stamp_updates(
    stored: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    watched: Sequence[str],
    today: date,
    stamp: str = "update_date",
) -> DataFrame:
    """Bring ``incoming`` into ``stored`` and date the rows whose watched columns changed.

    Both inputs hold one row per key. A changed or new row gets ``today``; an unchanged row keeps its
    date; a stored row without a counterpart is kept as it is. A change from or to NULL is a change.
    """
    old = stored.withColumn("_old", F.lit(True)).alias("o")
    new = incoming.withColumn("_new", F.lit(True)).alias("n")
    joined = old.join(new, null_safe("o", "n", keys), "full_outer")
    arrived = F.col("n._new").isNotNull()
    differs = F.col("o._old").isNull()
    for c in watched:
        differs = differs | ~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    out = []
    for c in stored.columns:
        if c == stamp:
            out.append(F.when(arrived & differs, F.lit(today).cast("date")).otherwise(F.col(f"o.{c}")).alias(c))
        elif c in incoming.columns:
            out.append(F.when(arrived, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            out.append(F.col(f"o.{c}").alias(c))
    return joined.select(*out)
