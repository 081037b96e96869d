"""Replacing partitions of a catalog table by switching their locations.

New partitions are written aside, under ``_parts`` in the table's folder, and checked there. A record then decides the switch: it names
the new location of each partition, and the partitions that go. Each switch is one catalog operation that can be repeated, so a crash
between them is repaired by the next writer; readers see a partition whole, as it was or as it is. What the switch was
based on (locations and files of the partitions concerned) is noted before anything is read and compared before anything
is switched, so that the work of a second writer is not undone.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tallyproof.functions import null_safe, settle
from tallyproof.operators.history import Watched
from tallyproof.operators.incremental import within_range
from tallyproof.sources.changes import _DONE, _NULL, _RECORD, _delete, _exists, _fs, _names, _read_text, _write_text, partition_directories

_FOLDER = "_parts"


def _quoted(value: str) -> str:
    return "null" if value == _NULL else "'" + unquote(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(name: str) -> str:
    """``d=1/g=x`` as the partition specification of a statement."""
    return "PARTITION (" + ", ".join(f"`{c}` = {_quoted(v)}" for c, v in (level.split("=", 1) for level in name.split("/"))) + ")"


def _location(spark: SparkSession, table: str, name: str | None = None) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}" + (f" {_spec(name)}" if name else "")).collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def partition_state(spark: SparkSession, table: str, column: str, values: set[str | None]) -> dict[str, list]:
    """Of each partition whose ``column`` has one of ``values`` (as text): its location, and number, bytes and last change of its files."""
    out = {}
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        levels = dict(level.split("=", 1) for level in row[0].split("/"))
        value = None if levels[column] == _NULL else unquote(levels[column])
        if value in values:
            place = _location(spark, table, row[0])
            fs, at = _fs(spark, place)
            files = [f for f in fs.listStatus(at) if f.isFile()] if fs.exists(at) else []
            out[row[0]] = [place, len(files), sum(f.getLen() for f in files), max((f.getModificationTime() for f in files), default=0)]
    return out


def finish_switches(spark: SparkSession, table: str) -> int:
    """Carry out the switches of a table that were decided and not finished; returns how many there were."""
    root, n = _location(spark, table), 0
    for name in _names(spark, f"{root}/{_FOLDER}"):
        aside = f"{root}/{_FOLDER}/{name}"
        if _exists(spark, f"{aside}/{_RECORD}") and not _exists(spark, f"{aside}/{_DONE}"):
            _switch(spark, table, aside)
            n += 1
    return n


def _switch(spark: SparkSession, table: str, aside: str) -> None:
    record = json.loads(_read_text(spark, f"{aside}/{_RECORD}"))
    for name in record["written"]:
        place = f"{aside}/{name}".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {_spec(name)} LOCATION '{place}'")
        spark.sql(f"ALTER TABLE {table} {_spec(name)} SET LOCATION '{place}'")
    for name in record["emptied"]:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_spec(name)}")
    spark.catalog.refreshTable(table)
    _write_text(spark, f"{aside}/{_DONE}", "")
    for place in record["replaced"]:
        _delete(spark, place)


def rewrite_table_partitions(spark: SparkSession, table: str, touched: DataFrame, change: Callable[[DataFrame], DataFrame]) -> None:
    """Replace the partitions of a catalog table that ``touched`` names by ``change`` of their rows, columns by name.

    ``touched`` has one column, a partition column of the table. Only partitions with these values are read and written; those
    left without rows are dropped, and rows in others are not allowed. Stops before anything is switched if what was written
    is not what went by, or if another writer has changed a touched partition meanwhile.
    """
    (column,) = touched.columns
    by = partition_columns(spark, table)
    if column not in by:
        raise ValueError(f"{table} is not partitioned by {column}")
    finish_switches(spark, table)
    root = _location(spark, table)
    wanted = settle(touched.distinct())
    values = {r[0] for r in wanted.selectExpr(f"cast(`{column}` as string)").collect()}
    base = partition_state(spark, table, column, values)
    stored = spark.table(table)
    part = stored.where(within_range(wanted, column)).alias("t").join(wanted.alias("w"), null_safe("t", "w", [column]), "left_semi").select("t.*")
    content = Watched(change(part).select(*stored.columns).hint("rebalance", *by))
    aside = f"{root}/{_FOLDER}/{uuid4().hex}"
    content.frame.write.partitionBy(*by).parquet(aside)
    if not content.agrees(spark.read.schema(content.original.schema).parquet(aside)):
        raise ValueError(f"{aside} does not hold the rows that it should, nothing was changed")
    written = partition_directories(spark, aside, by)
    if partition_state(spark, table, column, values) != base:
        raise RuntimeError(f"another writer has changed {table}; nothing was switched")
    alien = [n for n in written if n not in base and not _has_value(n, column, values)]
    if alien:
        raise ValueError(f"rows outside of the touched partitions: {alien[:3]}")
    # Only what lies in the table's own folder is deleted.
    replaced = [state[0] for state in base.values() if state[0].startswith(f"{root}/")]
    _write_text(spark, f"{aside}/{_RECORD}", json.dumps({"written": written, "emptied": sorted(set(base) - set(written)), "replaced": replaced}))
    _switch(spark, table, aside)


def _has_value(name: str, column: str, values: set[str | None]) -> bool:
    value = dict(level.split("=", 1) for level in name.split("/"))[column]
    return (None if value == _NULL else unquote(value)) in values
