"""Compaction of a partitioned Parquet directory, partition by partition."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyproof.operators.history import Watched, written_whole
from tallyproof.sources.changes import directory_of, finish_changes, replace_directories
from tallyproof.sources.versioned import TARGET_FILE_BYTES

SCANS = 64  # partitions that one job rewrites


def data_files(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    """(directory, length) of the Parquet files under ``path``, by a distributed listing that reads no content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(directory_of("_metadata.file_path", by).alias("directory"), "length")


def wanting(files: DataFrame, target_file_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """(directory, n_files, n_bytes, largest) of partitions with over twice the files that their bytes call for, or a file of over twice the target."""
    sizes = files.groupBy("directory").agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"), F.max("length").alias("largest"))
    called_for = F.greatest(F.ceil(F.col("n_bytes") / F.lit(target_file_bytes)), F.lit(1))
    return sizes.where((F.col("n_files") > 2 * called_for) | (F.col("largest") > 2 * target_file_bytes))


def packed_reads(spark: SparkSession, path: str, schema: T.StructType, found: Sequence[Row], target_file_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """The rows of some partitions without a shuffle: the reader packs small files into splits, and about one task for each file that is called for takes them."""
    parts = []
    for row in found:
        rows = spark.read.schema(schema).option("basePath", path).parquet(f"{path}/{row['directory']}")
        # At least two: frames of a single task each would be united into a single task.
        parts.append(rows.coalesce(max(2, -(-row["n_bytes"] // target_file_bytes))))
    return reduce(DataFrame.unionByName, parts)


def _spread(spark: SparkSession, path: str, schema: T.StructType, directory: str, tasks: int) -> DataFrame:
    """The rows of one partition, dealt over tasks by their places in its files, which a repeated task reproduces."""
    rows = spark.read.schema(schema).option("basePath", path).parquet(f"{path}/{directory}")
    return rows.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_place")).repartition(tasks, "_place").drop("_place")


def _contents(spark: SparkSession, path: str, schema: T.StructType, poor: Sequence[Row], target_file_bytes: int) -> Iterator[DataFrame]:
    """What is written, one job after another: partitions of small files some at a time, and those with large files one by one."""
    small = [row for row in poor if row["largest"] <= 2 * target_file_bytes]
    for i in range(0, len(small), SCANS):
        yield packed_reads(spark, path, schema, small[i : i + SCANS], target_file_bytes)
    for row in poor:
        if row["largest"] > 2 * target_file_bytes:
            yield _spread(spark, path, schema, row["directory"], max(1, -(-row["n_bytes"] // target_file_bytes)))


def compact_partitions(spark: SparkSession, path: str, by: Sequence[str], target_file_bytes: int = TARGET_FILE_BYTES) -> int:
    """Rewrite the partitions of a Parquet directory that have too many or too large files; returns how many there were.

    Files of all other partitions stay as they are. Small files are read together and written as files of about ``target_file_bytes``
    without a shuffle; only partitions with a file of over twice the target are shuffled. The rows that went by
    while writing are compared with those that were written before anything is replaced, and a crash on the way is
    repaired by the next call.
    """
    finish_changes(spark, path)
    poor = wanting(data_files(spark, path, by), target_file_bytes).orderBy("directory").collect()
    if not poor:
        return 0
    schema = spark.read.parquet(path).schema
    watched: list[Watched] = []

    def frames() -> Iterator[DataFrame]:
        for content in _contents(spark, path, schema, poor, target_file_bytes):
            watched.append(Watched(content))
            yield watched[-1].frame

    def is_whole(folder: str) -> bool:
        return written_whole(watched, spark.read.schema(schema).parquet(folder))

    replace_directories(spark, path, by, frames(), [r["directory"] for r in poor], check=is_whole)
    return len(poor)
