"""Catalog tables and plain Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str] = ()
) -> None:
    """Create an empty Parquet table unless it exists."""
    if spark.catalog.tableExists(table):
        return
    writer = spark.createDataFrame([], schema).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def add_columns(spark: SparkSession, table: str, columns: dict[str, str]) -> None:
    """Add columns (name -> SQL type) that the table lacks; old rows show NULL in them."""
    have = set(spark.table(table).columns)
    new = ", ".join(f"`{n}` {t}" for n, t in columns.items() if n not in have)
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({new})")


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """Write a new table whose rows are dealt into ``buckets`` by ``keys`` and sorted by them.

    What is grouped or joined by these keys later needs no shuffle: with the keys of duplicates, each check counts them where
    the rows lie. Name all keys, so that a frequent value of one (a missing item) does not fill a bucket.
    """
    dealt = df.repartition(buckets, *keys)  # as the buckets are, so that each becomes one file
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(table)


def append_by_name(df: DataFrame, table: str) -> None:
    """Append to an existing table, matching columns by name.

    The table insert itself goes by position, so the frame is brought into the table's order first;
    a missing, unknown or differently typed column stops the append before anything is written.
    """
    target = df.sparkSession.table(table).schema
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in target.fields}
    if have.keys() != want.keys():
        raise ValueError(f"columns differ: {sorted(have.keys() ^ want.keys())}")
    wrong = [n for n in want if have[n] != want[n]]
    if wrong:
        raise TypeError(f"types differ: {wrong}")
    df.select(*[f.name for f in target.fields]).write.mode("append").insertInto(table)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace exactly the partitions that ``df`` has rows for.

    ``df`` must not read from ``path``. The rebalance hint gathers each partition's rows into few
    files and splits a partition that holds most rows over several tasks.
    """
    (
        df.hint("rebalance", *by)
        .write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy(*by)
        .parquet(path)
    )


def overwrite_table_partitions(df: DataFrame, table: str) -> None:
    """Replace exactly the partitions of a catalog table that ``df`` has rows for, columns by name.

    ``df`` must be settled if it derives from the table. The rebalance hint gathers each partition's rows into few files.
    :func:`tallyproof.sources.rewrite_table_partitions` reads and replaces in safe steps.
    """
    spark = df.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        by = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
        df.select(*spark.table(table).columns).hint("rebalance", *by).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)


def reload_by_sql(spark: SparkSession, table: str, view: str) -> None:
    """Reload a lookup table from a view in SQL, columns by name, files as the scan yields them."""
    spark.sql(f"INSERT OVERWRITE TABLE {table} BY NAME SELECT * FROM {view}")
