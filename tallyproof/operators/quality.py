"""The data-quality result: counters turned into colours, a verdict and a comment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyproof.functions import null_safe, traffic_light
from tallyproof.operators.checks import BREAK_CHECKS, DUPLICATE_KEYS, GRAIN, Check, reading
from tallyproof.operators.counters import ROWS, counters, source_counts

DATE = "dwh_business_date"
NOT_APPLICABLE = "N/A"


def _result_schema(checks: Sequence[Check]) -> T.StructType:
    fields = [(n, T.StringType()) for n in ("theme", "kpi_id", "issue_object")]
    fields += [(DATE, T.IntegerType())]
    fields += [(n, T.StringType()) for n in ("instance", "row_type", "cluster_type")]
    fields += [("completeness_count", T.IntegerType())]
    fields += [(c.result, T.StringType()) for c in checks if c.result]
    fields += [(n, T.StringType()) for n in ("comments", "current_status")]
    fields += [("run_time", T.TimestampType()), ("run_date", T.StringType()), ("crtd_by", T.StringType())]
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


#: The 34 columns of the result table, in table order.
RESULT_SCHEMA = _result_schema(BREAK_CHECKS)


def on_date(df: DataFrame, business_date: int | None, date_col: str = DATE) -> DataFrame:
    """One business-date partition, or every date when none is named."""
    return df if business_date is None else df.where(F.col(date_col) == business_date)


def completeness(
    per_grain: DataFrame, source: DataFrame, count: str = ROWS, by: Sequence[str] = (DATE, "cluster_type")
) -> DataFrame:
    """Attach the source count of each ``by`` (date and cluster), 0 where the source has none, and its colour.

    Green means the warehouse holds at least as many rows in this grain as the source finished loads
    for the cluster. Both inputs are aggregates, so the join moves grains and never fact rows.
    """
    joined = per_grain.alias("t").join(
        source.alias("s"), null_safe("t", "s", by), "left"
    )
    expected = F.coalesce(F.col("s.source_count"), F.lit(0))
    colour = F.when(F.col(f"t.{count}") >= expected, F.lit("Green")).otherwise(F.lit("Red"))
    return joined.select("t.*", expected.alias("source_count"), colour.alias("completeness_status"))


def _as_int(count: Column) -> Column:
    """A BIGINT as INT; raises beyond its range, whether or not the session is in ANSI mode."""
    fits = F.assert_true(count.between(-(2**31), 2**31 - 1), F.lit("a source count exceeds the INT of the result table"))
    return F.when(fits.isNull(), count.cast("int"))


def verdict(statuses: Sequence[tuple[str, Column]]) -> tuple[Column, Column]:
    """(comments, current_status) from labelled colours, labels in reporting order."""
    failed = F.concat_ws(", ", *[F.when(colour == "Red", F.lit(label)) for label, colour in statuses])
    comments = F.when(failed == "", F.lit("All checks passed")).otherwise(
        F.concat(F.lit("Failed checks: "), failed)
    )
    return comments, F.when(failed == "", F.lit("No_Issue")).otherwise(F.lit("Open"))


def dq_result(
    fact: DataFrame,
    view: DataFrame,
    status: DataFrame,
    run_ts: datetime,
    business_date: int | None = None,
    checks: Sequence[Check] = BREAK_CHECKS,
    theme: str = "Breaks",
    issue_object: str = "fact",
    created_by: str = "tallyproof",
    on_missing_view: str = "error",
    grain: Sequence[str] = GRAIN,
    duplicate_keys: Sequence[str] = DUPLICATE_KEYS,
    load_keys: Sequence[str] = (DATE, "cluster_type"),
) -> DataFrame:
    """One result row per grain of ``fact``: business date, instance, row type and cluster unless ``grain`` names others.

    The first column of ``grain`` is the business date. ``duplicate_keys`` say what makes rows duplicates, and
    ``load_keys``, a part of the grain, at which level the source's finished loads are counted.

    Give ``business_date`` for the daily run; leave it out to (re)check every date in one plan.
    A grain that ``view`` lacks stops the job before anything is written (``on_missing_view="error"``)
    or turns its view checks Red (``"red"``). The run clock is an argument, so reruns are repeatable.
    """
    if on_missing_view not in ("error", "red"):
        raise ValueError("on_missing_view must be 'error' or 'red'")
    fact, view, status = (on_date(df, business_date, grain[0]) for df in (fact, view, status))
    on_fact = fact_counters(fact, checks, grain, duplicate_keys)
    on_view = view_counters(view, checks, grain)
    return judged(on_fact, on_view, status, run_ts, checks, theme, issue_object, created_by, on_missing_view, grain, load_keys)


def fact_counters(
    fact: DataFrame, checks: Sequence[Check] = BREAK_CHECKS, grain: Sequence[str] = GRAIN, duplicate_keys: Sequence[str] = DUPLICATE_KEYS
) -> DataFrame:
    """Rows and counters of the fact's checks per grain."""
    return counters(fact, reading(checks, "fact"), grain, duplicate_keys)


def view_counters(view: DataFrame, checks: Sequence[Check] = BREAK_CHECKS, grain: Sequence[str] = GRAIN) -> DataFrame:
    """Rows and counters of the view's checks per grain."""
    return counters(view, reading(checks, "view"), grain)


def judged(
    on_fact: DataFrame,
    on_view: DataFrame,
    status: DataFrame,
    run_ts: datetime,
    checks: Sequence[Check] = BREAK_CHECKS,
    theme: str = "Breaks",
    issue_object: str = "fact",
    created_by: str = "tallyproof",
    on_missing_view: str = "error",
    grain: Sequence[str] = GRAIN,
    load_keys: Sequence[str] = (DATE, "cluster_type"),
) -> DataFrame:
    """The result rows of :func:`dq_result` from counters, fresh ones or those that are kept (``sources.recheck``).

    Counters of business dates add up to those of the table: a date's rows are counted alone, as the keys of duplicates hold
    the date. So a recheck counts only dates that changed and judges all.
    """
    if on_missing_view not in ("error", "red"):
        raise ValueError("on_missing_view must be 'error' or 'red'")
    on_view = on_view.withColumnRenamed(ROWS, "_view_rows")
    grains = completeness(on_fact, source_counts(status, by=load_keys), by=load_keys).alias("f").join(
        on_view.alias("v"), null_safe("f", "v", grain), "left"
    )
    if on_missing_view == "error":
        present = F.assert_true(
            F.col("v._view_rows").isNotNull(), F.lit("a grain of the fact is missing from the view")
        )
        grains = grains.where(present.isNull())

    colours: dict[str, Column] = {}
    for check in checks:
        if check.rule == "completeness":
            colours[check.label] = F.col("f.completeness_status")
        elif check.rule != "constant":
            side = "f" if check.reads == "fact" else "v"
            colours[check.label] = traffic_light(F.col(f"{side}.{check.counter}"))
    comments, current_status = verdict(list(colours.items()))

    shown = [
        (F.lit(NOT_APPLICABLE) if c.rule == "constant" else colours[c.label]).alias(c.result)
        for c in checks
        if c.result
    ]
    return grains.select(
        F.lit(theme).alias("theme"),
        F.lit("").alias("kpi_id"),
        F.lit(issue_object).alias("issue_object"),
        *[F.col(f"f.{g}").alias(g) for g in grain],
        # A count that does not fit the table's INT stops the job: neither a wrapped number nor a NULL would be true.
        _as_int(F.col("source_count")).alias("completeness_count"),
        *shown,
        comments.alias("comments"),
        current_status.alias("current_status"),
        F.lit(run_ts).cast("timestamp").alias("run_time"),
        F.lit(run_ts.strftime("%Y-%m-%d")).alias("run_date"),
        F.lit(created_by).alias("crtd_by"),
    )


# Fields that the dashboard shows, and fields for which no check may be reported.
DASHBOARD_FIELDS = (
    "LVID_Region", "LVID_Description", "LVID_Country", "Rec_Type", "Rec_Type_2",
    "Currency", "Value_Date", "Instance", "Statement_Date",
)
UNCHECKED_FIELDS = ("Action_Date", "SOE_ID", "User_Hierarchy")


def default_routing(checks: Sequence[Check] = BREAK_CHECKS) -> dict[str, str]:
    """Result column -> on-the-fly flag: ``Yes``, ``No`` or ``N/A``."""
    def flag(label: str) -> str:
        if label in UNCHECKED_FIELDS:
            return NOT_APPLICABLE
        return "Yes" if label in DASHBOARD_FIELDS else "No"
    return {c.result: flag(c.label) for c in checks if c.result}


# Which flags reach which target.
_REACHES = {"dashboard": ("Yes",), "count_table": ("Yes", "No")}


def route_on_fly(result: DataFrame, routing: Mapping[str, str], target: str) -> DataFrame:
    """Long form of the wide result, holding only the checks that belong to ``target``.

    ``routing`` is configuration with one entry per check, so it becomes the column list of the
    unpivot: no lookup join, and columns that are not routed are never read.
    """
    flags = _REACHES[target]
    names = [c for c in result.columns if routing.get(c) in flags]
    return result.unpivot([*GRAIN], names, "check_name", "check_status")
