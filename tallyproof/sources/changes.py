"""Replacing partitions of a Parquet directory in steps that can be repeated after a crash.

What partitions are to hold is written aside first, in a folder of the change under ``_changes``, which readers of the
table pass over. A record that names the partitions concerned decides the change: before it exists nothing has
happened; from then on the change is carried out, partition by partition, by whoever comes next. Carrying out
moves directories, and a step that has been done is seen to be done, so it can be repeated. The record stays
afterwards and tells which partitions a batch has rows in. One writer at a time per table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Sequence
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyproof.functions import null_safe, settle
from tallyproof.operators.incremental import within_range

_FOLDER = "_changes"
_RECORD = "_DECIDED"
_DONE = "_DONE"
_NULL = "__HIVE_DEFAULT_PARTITION__"


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name and rename it, so that it is never seen in part."""
    fs, at = _fs(spark, path)
    aside = _fs(spark, f"{path}.writing")[1]
    stream = fs.create(aside, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    fs.delete(at, False)
    if not fs.rename(aside, at):
        raise OSError(f"could not write {path}")


def _read_text(spark: SparkSession, path: str) -> str:
    fs, at = _fs(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs(spark, path)
    return sorted(entry.getPath().getName() for entry in fs.listStatus(at)) if fs.exists(at) else []


def partition_directories(spark: SparkSession, path: str, by: Sequence[str]) -> list[str]:
    """Relative directories of all partitions under ``path``, without looking at data files."""
    found = [""]
    for column in by:
        found = [f"{d}/{name}".lstrip("/") for d in found for name in _names(spark, f"{path}/{d}") if name.startswith(f"{column}=")]
    return found


def directory_of(file: str, by: Sequence[str]) -> Column:
    """The relative partition directory of the file that a column names."""
    # The column holds a URI, in which the escapes of a directory name are escaped once more.
    return F.regexp_extract(F.url_decode(F.replace(F.col(file), F.lit("+"), F.lit("%2B"))), "(" + "/".join(f"{re.escape(c)}=[^/]*" for c in by) + ")/[^/]*$", 1)


def _directories_of(part: DataFrame, by: Sequence[str]) -> list[str]:
    """Relative directories of the files that hold the rows of ``part``: as many as partitions are touched."""
    return [r[0] for r in part.select(directory_of("_file", by)).distinct().collect()]


def _values(spark: SparkSession, directories: Iterable[str], schema: T.StructType, by: Sequence[str], with_directory: bool = False) -> DataFrame:
    """Partition directories as rows of partition values, and ``_directory`` if asked for."""
    rows = []
    for directory in directories:
        texts = [unquote(level.split("=", 1)[1]) for level in directory.split("/")]
        rows.append([*(None if t == _NULL else t for t in texts), directory])
    texts = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in (*by, "_directory")))
    return texts.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in by], *["_directory"] * with_directory)


def finish_changes(spark: SparkSession, path: str) -> int:
    """Carry out the changes of ``path`` that were decided and not finished; returns how many there were."""
    n = 0
    for name in _names(spark, f"{path}/{_FOLDER}"):
        change = f"{path}/{_FOLDER}/{name}"
        if _exists(spark, f"{change}/{_RECORD}") and not _exists(spark, f"{change}/{_DONE}"):
            _carry_out(spark, path, change)
            n += 1
    return n


def _carry_out(spark: SparkSession, path: str, change: str) -> None:
    record = json.loads(_read_text(spark, f"{change}/{_RECORD}"))
    for directory in record["written"]:
        fs, aside = _fs(spark, f"{change}/rows/{directory}")
        if not fs.exists(aside):  # moved before a crash
            continue
        target = _fs(spark, f"{path}/{directory}")[1]
        fs.delete(target, True)
        fs.mkdirs(target.getParent())
        if not fs.rename(aside, target):
            raise OSError(f"could not move {aside} to {target}")
    for directory in record["emptied"]:
        _delete(spark, f"{path}/{directory}")
    _write_text(spark, f"{change}/{_DONE}", "")
    _delete(spark, f"{change}/rows" if record["batch"] is not None else change)


def _records(spark: SparkSession, path: str, batch: str) -> list[str]:
    """Folders of the loads of a batch that were decided."""
    names = [n for n in _names(spark, f"{path}/{_FOLDER}") if n.startswith(f"batch-{batch}.")]
    return [c for c in (f"{path}/{_FOLDER}/{n}" for n in names) if _exists(spark, f"{c}/{_RECORD}")]


def batch_directories(spark: SparkSession, path: str, batch: str) -> list[str]:
    """Partitions in which a batch may have rows, by the records of its loads."""
    found: set[str] = set()
    for change in _records(spark, path, batch):
        found |= set(json.loads(_read_text(spark, f"{change}/{_RECORD}"))["written"])
    return sorted(found)


def replace_directories(
    spark: SparkSession, path: str, by: Sequence[str], contents: Iterable[DataFrame], replaced: Iterable[str],
    batch: str | None = None, check: Callable[[str], bool] | None = None,
) -> None:
    """Put ``contents``, written one after another, in the place of the partition directories ``replaced``; those without new rows go.

    ``check`` is given the folder that was written; nothing is changed unless it accepts it. ``contents`` may have rows in
    other partitions as well, which must not exist yet.
    """
    if batch is not None and not re.fullmatch(r"[\w=-]+", batch):
        raise ValueError("a batch is named by letters, digits, _, = and -")
    change = f"{path}/{_FOLDER}/" + ("once" if batch is None else f"batch-{batch}") + f".{uuid4().hex}"
    for content in contents:
        content.write.mode("append").partitionBy(*by).parquet(f"{change}/rows")
    if check is not None and not check(f"{change}/rows"):
        raise ValueError(f"{change} does not hold the rows that it should, nothing was changed")
    written = partition_directories(spark, f"{change}/rows", by)
    before = [] if batch is None else _records(spark, path, batch)
    _write_text(spark, f"{change}/{_RECORD}", json.dumps({"batch": batch, "written": written, "emptied": sorted(set(replaced) - set(written))}))
    _carry_out(spark, path, change)
    for former in before:  # this record takes their place
        _delete(spark, former)


def rewrite_partitions(
    spark: SparkSession, path: str, by: Sequence[str], touched: DataFrame, change: Callable[[DataFrame], DataFrame],
    schema: T.StructType | None = None, batch: str | None = None,
) -> None:
    """Replace the partitions of a Parquet table that ``touched`` names by ``change`` of their rows.

    ``touched`` holds values of one or more of the partition columns ``by``. Only those partitions are read and
    written, and those that are left without rows go. A change that an earlier run decided and did not finish is finished first. With a
    ``batch``, partitions in which an earlier load of it has rows are touched as well. ``schema`` is that of the table,
    if older files may lack columns.
    """
    finish_changes(spark, path)
    stored = (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    wanted = touched
    former = [] if batch is None else batch_directories(spark, path, batch)
    if former:
        wanted = wanted.unionByName(_values(spark, former, stored.schema, by).select(*wanted.columns))
    wanted = settle(wanted.distinct())
    part = stored.select("*", F.col("_metadata.file_path").alias("_file"))
    for c in wanted.columns:
        part = part.where(within_range(wanted, c))
    part = part.alias("s").join(wanted.alias("w"), null_safe("s", "w", wanted.columns), "left_semi").select("s.*")
    replace_directories(spark, path, by, [change(part.drop("_file")).hint("rebalance", *by)], _directories_of(part, by), batch)
