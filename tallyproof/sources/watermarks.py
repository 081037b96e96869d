"""High watermarks without reading a whole target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyproof.operators.incremental import high_watermark
from tallyproof.sources.changes import _values, partition_directories


def newest_partitions(spark: SparkSession, path: str, partition_by: Sequence[str], day: str, by: Sequence[str], schema: T.StructType) -> list[str]:
    """Directories of the newest ``day`` of each ``by``, from the listing of directories alone; all of them are partition columns."""
    if day not in partition_by or not set(by) <= set(partition_by):
        raise ValueError(f"{path} must be partitioned by {[day, *by]}")
    listed = _values(spark, partition_directories(spark, path, partition_by), schema, partition_by, with_directory=True)
    newest = listed.where(F.col(day).isNotNull()).groupBy(*by, day).agg(F.collect_set("_directory").alias("found"))
    latest = newest.groupBy(*by).agg(F.max_by("found", day).alias("found"))
    return sorted(r[0] for r in latest.select(F.explode("found")).collect())


def partitioned_watermark(
    spark: SparkSession, path: str, partition_by: Sequence[str], ts_col: str, day: str, by: Sequence[str] = ()
) -> DataFrame:
    """``high_watermark`` of a Parquet directory whose partitions hold the stamps of one ``day`` each.

    The newest stamp then lies in the newest partition that has one, so only the newest partitions are read, found by listing directories.
    Where these hold no stamp for an environment (only NULLs), the whole table is read for it.
    """
    table = spark.read.parquet(path)
    found = newest_partitions(spark, path, partition_by, day, by, table.schema)
    if not found:
        return high_watermark(table, ts_col, by)
    recent = spark.read.schema(table.schema).option("basePath", path).parquet(*[f"{path}/{d}" for d in found])
    marks = high_watermark(recent, ts_col, by)
    stampless = marks.where(F.col(marks.columns[-1]).isNull()).limit(1).count()
    undated = any(f"{day}=__HIVE_DEFAULT_PARTITION__" in d.split("/") for d in partition_directories(spark, path, partition_by))
    return high_watermark(table, ts_col, by) if stampless or undated else marks
