"""Counters kept by partition, so that a recheck reads only partitions whose files have changed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.functions import null_safe, settle
from tallyproof.operators.incremental import within_range
from tallyproof.sources.changes import _values, directory_of
from tallyproof.sources.versioned import current_version, publish, read_current

STATE = ("_directory", "_files", "_print")


def file_prints(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    """(_directory, _files, _print) of each partition: how many files it has, and a sum of hashes of their names, sizes and times.

    A distributed listing that reads no content.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return files.groupBy(directory_of("_metadata.file_path", by).alias("_directory")).agg(
        F.count(F.lit(1)).alias("_files"), F.sum(one).cast("string").alias("_print")
    )


def recheck(
    spark: SparkSession, path: str, by: Sequence[str], store: str, count: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``count`` of a partitioned Parquet table, from what ``store`` keeps of unchanged partitions and a scan of the others.

    ``count`` groups by all of ``by``, so what it says of a partition follows from that partition alone (duplicates
    are counted by keys that hold the partition columns). The store is versioned: a recheck that dies leaves the old one, and
    partitions that are gone leave it. Two rechecks at once are noticed.
    """
    base = current_version(spark, store)
    prints = settle(file_prints(spark, path, by))
    table = spark.read.parquet(path)
    known = None if base is None else read_current(spark, store)
    fresh = prints if known is None else prints.join(known.select(*STATE).distinct(), list(STATE), "left_anti")
    names = [r["_directory"] for r in fresh.select("_directory").collect()]
    if not names and known is not None and known.join(prints, list(STATE), "left_anti").isEmpty():
        return known.drop(*STATE)
    parts = []
    if known is not None:
        parts.append(known.join(prints, list(STATE), "left_semi"))
    if names or known is None:
        wanted = settle(_values(spark, names, table.schema, by))
        rows = table
        for c in by:
            rows = rows.where(within_range(wanted, c))
        rows = rows.alias("t").join(wanted.alias("w"), null_safe("t", "w", by), "left_semi").select("t.*")
        counted = count(rows)
        of = spark.createDataFrame([(n,) for n in names], "_directory string")
        placed = _values(spark, names, table.schema, by, with_directory=True).join(prints.join(of, "_directory"), "_directory")
        joined = counted.alias("c").join(placed.alias("p"), null_safe("c", "p", by))
        parts.append(joined.select("c.*", *[F.col(f"p.{c}") for c in STATE]))
    state = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    publish(state.coalesce(8), store, replaces=base)
    return read_current(spark, store).drop(*STATE)
