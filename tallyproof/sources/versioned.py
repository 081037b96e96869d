"""Parquet tables kept as numbered versions, for rewrites that read what they replace.

Overwriting a directory while reading it loses the data. Here a rewrite goes to a new directory
``version-N`` under the table's root and becomes current when a marker file, which holds the schema,
appears in it after it has been checked. Readers take the highest marked version, a job that dies
leaves an unmarked directory that nobody reads, and nothing is renamed, so object stores do as well as
HDFS. One writer at a time per table.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyproof.functions import null_safe, settle
from tallyproof.operators.history import Watched

TARGET_FILE_BYTES = 128 * 1024 * 1024
_MARKER = "_PUBLISHED"
_PREFIX = "version-"


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _versions(spark: SparkSession, root: str) -> list[tuple[int, bool]]:
    """(number, published) of each version directory, ascending. Lists directories, never data files."""
    fs, path = _fs(spark, root)
    if not fs.exists(path):
        return []
    found = []
    for entry in fs.listStatus(path):
        name = entry.getPath().getName()
        if name.startswith(_PREFIX):
            marker = _fs(spark, f"{root}/{name}/{_MARKER}")[1]
            # A marker that is still empty is being written: its version is not yet published.
            found.append((int(name[len(_PREFIX):]), fs.exists(marker) and fs.getFileStatus(marker).getLen() > 0))
    return sorted(found)


def _directory(root: str, number: int) -> str:
    return f"{root}/{_PREFIX}{number:08d}"


def current_version(spark: SparkSession, root: str) -> int | None:
    """Number of the version that readers see, None before the first one."""
    return max((n for n, published in _versions(spark, root) if published), default=None)


def _current_directory(spark: SparkSession, root: str) -> str:
    number = current_version(spark, root)
    if number is None:
        raise FileNotFoundError(f"no published version under {root}")
    return _directory(root, number)


def _read(spark: SparkSession, directory: str) -> DataFrame:
    """A published version with the schema it was written with, partition columns and empty tables included."""
    fs, marker = _fs(spark, f"{directory}/{_MARKER}")
    stream = fs.open(marker)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return spark.read.schema(T.StructType.fromJson(json.loads(text))).parquet(directory)


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The table as last published."""
    return _read(spark, _current_directory(spark, root))


def publish(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = (),
    validate: Callable[[DataFrame], bool] | None = None,
    max_records_per_file: int = 0,
    replaces: int | None = None,
) -> int:
    """Write ``df`` as the next version and make it current if ``validate`` accepts what was written.

    ``replaces`` is the version that ``df`` derives from. If another has been published since, this one is not: it
    would undo the other's changes.
    """
    spark = df.sparkSession
    number = max((n for n, _ in _versions(spark, root)), default=0) + 1
    directory = _directory(root, number)
    writer = df.write.mode("errorifexists").option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(directory)
    if validate is not None and not validate(spark.read.schema(df.schema).parquet(directory)):
        raise ValueError(f"{directory} failed validation and was not published")
    if replaces is not None and current_version(spark, root) != replaces:
        raise RuntimeError(f"version {current_version(spark, root)} came between; {directory} was not published")
    fs, marker = _fs(spark, f"{directory}/{_MARKER}")
    stream = fs.create(marker, True)
    stream.write(bytearray(df.schema.json(), "utf-8"))
    stream.close()
    return number


def staged_rewrite(
    spark: SparkSession,
    root: str,
    change: Callable[[DataFrame], DataFrame],
    partition_by: Sequence[str] = (),
    validate: Callable[[DataFrame], bool] | None = None,
) -> int:
    """Replace the table by ``change(table)``; the version read stays in place until retention."""
    base = current_version(spark, root)
    changed = change(read_current(spark, root))
    if partition_by:
        changed = changed.hint("rebalance", *partition_by)
    return publish(changed, root, partition_by, validate, replaces=base)


def file_sizes(spark: SparkSession, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Number and bytes of Parquet files per partition, by a distributed listing that reads no content."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
        .select(*partition_by, "length")
    )
    return files.groupBy(*partition_by).agg(
        F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes")
    )


def _packed(
    rows: DataFrame, slots: DataFrame, partition_by: Sequence[str], tasks: int
) -> DataFrame:
    """``rows`` distributed so that every partition is spread over its number of ``_slots``.

    A row's slot is drawn from its place in the input file, which a repeated task reproduces, so a
    partition with most of the data goes to many tasks, and a lost executor neither drops nor
    doubles rows.
    """
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    placed = rows.select("*", place.alias("_place"))
    if not partition_by:
        return placed.repartition(tasks, "_place").select(*rows.columns)
    joined = placed.alias("r").join(slots.alias("p"), null_safe("r", "p", partition_by), "left")
    slot = F.pmod("_place", F.coalesce("_slots", F.lit(1)).cast("bigint")).alias("_slot")
    return (
        joined.select("r.*", slot)
        .repartition(tasks, *partition_by, "_slot")
        .select(*rows.columns)
    )


def compact(
    spark: SparkSession,
    root: str,
    partition_by: Sequence[str] = (),
    target_file_bytes: int = TARGET_FILE_BYTES,
) -> int:
    """Rewrite many small files as few near ``target_file_bytes``, and check that no row changed.

    A table in which no partition has over twice the files that its bytes call for, nor files of over twice the target, is
    left as it is; the current version is returned. Otherwise it is written by as many tasks as it needs files.
    """
    base = current_version(spark, root)
    directory = _current_directory(spark, root)
    wanted = F.greatest(F.ceil(F.col("n_bytes") / F.lit(target_file_bytes)), F.lit(1)).cast("int")
    slots = settle(file_sizes(spark, directory, partition_by).select(*partition_by, "n_files", "n_bytes", wanted.alias("_slots")))
    if slots.where((F.col("n_files") > 2 * F.col("_slots")) | (F.col("n_bytes") > F.col("n_files") * (2 * target_file_bytes))).isEmpty():
        return base
    files = slots.agg(F.coalesce(F.sum("_slots"), F.lit(1))).first()[0]
    packed = Watched(_packed(_read(spark, directory), slots.drop("n_files", "n_bytes"), partition_by, files))
    return publish(packed.frame, root, partition_by, packed.agrees, replaces=base)


def full_refresh(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = (),
    target_file_bytes: int = TARGET_FILE_BYTES,
) -> int:
    """Truncate and load: ``df`` becomes the whole table, written once.

    A rebalancing shuffle gathers each partition's rows and splits them near ``target_file_bytes`` by their measured
    size, so a small table ends up in a single file per directory and no task takes more than about one file's worth.
    """
    spark = df.sparkSession
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, str(target_file_bytes))
    try:
        return publish(df.hint("rebalance", *partition_by), root, partition_by)
    finally:
        spark.conf.set(size, before)


def back_up(spark: SparkSession, root: str, backup_root: str, partition_by: Sequence[str] = ()) -> int:
    """Copy the current version to another root and check the copy before publishing it."""
    table = Watched(read_current(spark, root))
    return publish(table.frame, backup_root, partition_by, table.agrees)


def retain_versions(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Delete all but the last ``keep`` published versions, and abandoned ones older than the current.

    Run it when no reader is still on an old version. Returns the numbers deleted.
    """
    if keep < 1:
        raise ValueError("keep at least the current version")
    versions = _versions(spark, root)
    published = [n for n, done in versions if done]
    if not published:
        return []
    kept = set(published[-keep:])
    doomed = [n for n, _ in versions if n not in kept and n < published[-1]]
    for number in doomed:
        fs, path = _fs(spark, _directory(root, number))
        fs.delete(path, True)
    return doomed
