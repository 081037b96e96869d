"""Day-over-day flags of the close-of-business table ``(cob_date, dwh_business_date, row_type, flag, status)``."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _last_day(cob: DataFrame) -> date | None:
    """Latest day, looked up now: as a literal it prunes a table that is partitioned by day."""
    return cob.agg(F.max("cob_date")).first()[0]


def _day_before(cob: DataFrame, last: date | None, previous: str) -> date | None:
    if previous not in ("calendar_day", "prior_available"):
        raise ValueError("previous must be 'calendar_day' or 'prior_available'")
    if last is None:
        return None
    if previous == "calendar_day":
        return last - timedelta(days=1)
    return _last_day(cob.where(F.col("cob_date") < last))


def _of_day(cob: DataFrame, day: date | None) -> DataFrame:
    return cob.where(F.lit(False) if day is None else F.col("cob_date") == day)


def _open_failures(cob: DataFrame) -> DataFrame:
    return cob.where((F.col("flag") == "fail") & (F.col("status") == "Y"))


def previous_failures(cob: DataFrame, previous: str = "calendar_day") -> DataFrame:
    """Row types that failed and were open the day before the latest one, each once.

    ``calendar_day`` is yesterday by the calendar, so a Monday finds nothing of Friday;
    ``prior_available`` is the latest earlier day that has data.
    """
    day = _day_before(cob, _last_day(cob), previous)
    return _open_failures(_of_day(cob, day)).select("row_type").distinct()


def _classified(rows: DataFrame, *more: str) -> DataFrame:
    """Stored and new status, and what became of it: no stored status is NEW, another one CHANGED, the same NO CHANGE."""
    old = F.col("status")
    new = F.when(F.col("flag") == "fail", F.lit("Y")).otherwise(F.lit("N"))
    change = F.when(old.isNull(), F.lit("NEW")).when(old != new, F.lit("CHANGED")).otherwise(F.lit("NO CHANGE"))
    return rows.select(
        "cob_date", "dwh_business_date", "row_type", "flag",
        old.alias("old_status"), new.alias("new_status"), change.alias("change_type"), *more,
    )


def flag_changes(cob: DataFrame, previous: str = "calendar_day") -> DataFrame:
    """Stored and new status of every row of the latest day, and whether its row type failed the day before, by row type.

    A failing flag is open (``Y``) and any other flag is not. ``failed_before`` looks at the previous day's open
    failures, one per row type, so a row of the latest day appears once however often its type failed.
    """
    last = _last_day(cob)
    failures = _open_failures(_of_day(cob, _day_before(cob, last, previous))).select("row_type").distinct()
    today = _of_day(cob, last).alias("t").join(
        failures.withColumn("_failed", F.lit(True)).alias("f"), F.col("t.row_type").eqNullSafe(F.col("f.row_type")), "left"
    )
    flagged = _classified(today.select("t.*", F.coalesce("_failed", F.lit(False)).alias("failed_before")), "failed_before")
    return flagged.orderBy("row_type")


def flag_history(cob: DataFrame) -> DataFrame:
    """The same verdict for every row of every day, to backfill a history in one pass."""
    return _classified(cob)
