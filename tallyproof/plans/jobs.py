"""Whole jobs: what a scheduler calls. These write; everything they compose is lazy until then."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.operators import history, incremental
from tallyproof.operators.quality import DATE, dq_result, on_date
from tallyproof.sources import (
    append_by_name,
    back_up,
    compact,
    full_refresh,
    partition_columns,
    read_csv,
    rewrite_partitions,
    rewrite_table_partitions,
    write_csv,
)

log = logging.getLogger(__name__)


def default_business_date(now: datetime) -> int:
    """Yesterday as the number yyyyMMdd."""
    return int((now - timedelta(days=1)).strftime("%Y%m%d"))


def run_breaks(
    spark: SparkSession,
    fact: str,
    view: str,
    status: str,
    result: str,
    business_date: int | None = None,
    now: datetime | None = None,
    **options: str,
) -> bool:
    """Check one business date of the named tables and add the result rows to ``result``.

    Without a date it is yesterday. A date without facts is reported and writes nothing (False).
    A result table with an ``active_flag`` must be partitioned by business date: the new rows are active, earlier rows of
    the date turn inactive, and only that partition is written. Any other result table is appended to.
    ``options`` go to :func:`tallyproof.operators.quality.dq_result` (theme, created_by, …).
    """
    now = now or datetime.now()
    day = default_business_date(now) if business_date is None else business_date
    rows = spark.table(fact)
    if on_date(rows, day).isEmpty():
        log.warning("no rows in %s for business date %s, nothing checked", fact, day)
        return False
    checked = dq_result(
        rows, spark.table(view), spark.table(status), now, day, issue_object=fact, **options
    )
    stored = spark.table(result)
    if history.ACTIVE in stored.columns:
        touched = spark.createDataFrame([(day,)], f"{DATE} int").select(F.col(DATE).cast(stored.schema[DATE].dataType))
        rewrite_table_partitions(spark, result, touched, lambda part: history.supersede(part, checked, [DATE]))
    else:
        append_by_name(checked, result)
    return True


def record_run(
    spark: SparkSession, path: str, run: DataFrame, keys: Sequence[str], partition_by: Sequence[str], inactive: str = "N"
) -> None:
    """Add a run to a result table partitioned by ``partition_by``: its rows become active, earlier rows of its keys do not.

    ``keys`` include the partition columns other than the active flag; only partitions that the run touches are
    read and written.
    """
    touched = run.select(*[c for c in partition_by if c != history.ACTIVE])
    if not touched.columns or not set(touched.columns) <= set(keys):
        raise ValueError("partition the table by columns of the keys, a business date for instance")
    rewrite_partitions(spark, path, partition_by, touched, lambda stored: history.supersede(stored, run, keys, inactive))


def load_history(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> int:
    """One-off load of an existing table into a new one, in as few files as its size allows."""
    return full_refresh(df, root, partition_by)


def load_day(spark: SparkSession, path: str, day: DataFrame, partition_by: Sequence[str], batch: str | None = None) -> None:
    """Daily load: what the touched partitions hold plus the day's rows as active ones, written back to those partitions.

    With a ``batch``, rows carry it as ``batch_id`` and the load can be repeated: what the batch loaded before is replaced, wherever
    it was, and other batches of the day stay. A load that died on its way is finished by the next one. Without a
    batch, a second run adds the rows once more.
    """
    if batch is None:
        rows = day.withColumn(history.ACTIVE, F.lit("Y"))
        rewrite_partitions(spark, path, partition_by, rows.select(*partition_by), lambda table: history.bau_union(table, day))
        return
    if history.BATCH in partition_by:
        raise ValueError("batches must share partitions with others")
    own = day.withColumn(history.BATCH, F.lit(batch))
    rows = own.withColumn(history.ACTIVE, F.lit("Y"))
    # Rows may all be gone from a repeated batch, so that they cannot tell which batch is replaced.
    rewrite_partitions(
        spark, path, partition_by, rows.select(*partition_by),
        lambda table: history.bau_union(table.where(~F.col(history.BATCH).eqNullSafe(F.lit(batch))), own),
        schema=rows.schema, batch=batch,
    )


def split_table(df: DataFrame, keys: Sequence[str], actual_root: str, amend_root: str) -> tuple[int, int]:
    """Write the active rows to one table and all other rows to another."""
    actual, amend = history.split_actual_amend(df, keys)
    return full_refresh(actual, actual_root, [history.ACTIVE]), full_refresh(amend, amend_root, [history.ACTIVE])


def back_up_and_compact(
    spark: SparkSession, root: str, backup_root: str, partition_by: Sequence[str] = ()
) -> int:
    """Copy the table, check the copy, then rewrite the table in few files and check that as well."""
    back_up(spark, root, backup_root, partition_by)
    return compact(spark, root, partition_by)


def copy_confirmed(original: DataFrame, copy: DataFrame) -> bool:
    """Whether a migrated copy holds exactly the original's rows. Dropping the original is up to the caller."""
    return history.compare_copies(original, copy).isEmpty()


def run_incremental(
    spark: SparkSession,
    lookup: str,
    fact: str,
    target: str,
    created_ts: str,
    environment: str = "environment",
    keys: Sequence[str] = ("dwh_business_date", "row_type"),
    only: str | None = None,
) -> None:
    """One cycle: watermark of the target, newer lookup rows, their keys, rescan of the fact, replacement in the target.

    Each environment has its own watermark; ``only`` processes a single one. The touched slices (an environment's rows of a
    key) are scanned whole and take the place of what the target has of them, so that a cycle can be repeated. The target
    is partitioned by ``keys[0]``, and only touched partitions are written; one that is left without rows is dropped. Partitions are
    written aside, checked and then switched; a cycle that died on its way is finished by the next one, and one that another writer
    crossed stops.
    """
    looked_up, loaded, facts = spark.table(lookup), spark.table(target), spark.table(fact)
    columns = loaded.columns
    if keys[0] not in partition_columns(spark, target):
        raise ValueError(f"{target} is not partitioned by {keys[0]}")
    if only is not None:
        looked_up, loaded, facts = (df.where(F.col(environment) == only) for df in (looked_up, loaded, facts))
    rows, slices = incremental.cycle(looked_up, facts, loaded, created_ts, environment, keys)
    if slices.isEmpty():
        return
    rewrite_table_partitions(spark, target, slices.select(keys[0]), lambda part: incremental.replaced(part, rows.select(*columns), slices))


def filter_csv(spark: SparkSession, source: str, target: str, column: str, above: float, schema=None) -> None:
    """Keep the lines of a CSV file whose ``column`` is greater than ``above``; empty values drop out."""
    write_csv(read_csv(spark, source, schema).where(F.col(column) > above), target)


def main(argv: Sequence[str] | None = None) -> None:
    """Command line of the daily check, for spark-submit."""
    parser = argparse.ArgumentParser(description="Check one business date and append the result.")
    for name in ("fact", "view", "status", "result"):
        parser.add_argument(f"--{name}", required=True, help=f"{name} table")
    parser.add_argument("--business-date", type=int, help="yyyyMMdd, yesterday by default")
    parser.add_argument("--theme", default="Breaks")
    parser.add_argument("--on-missing-view", choices=("error", "red"), default="error")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("tallyproof-breaks").getOrCreate()
    run_breaks(
        spark, args.fact, args.view, args.status, args.result, args.business_date,
        theme=args.theme, on_missing_view=args.on_missing_view,
    )


if __name__ == "__main__":
    main()
