"""CSV files and relational databases."""

from __future__ import annotations

import math
from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header line. Name a schema for large files: inferring one reads them once more.

    ``path`` may be on any file system the session is configured for, object stores included.
    """
    reader = spark.read.option("header", True)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Replace the directory ``path`` with CSV part files, each with a header line."""
    df.write.option("header", True).mode("overwrite").csv(path)


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    num_partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for a database table, split into ranges of ``partition_column`` if one is named."""
    options = {"url": url, "dbtable": table, **(properties or {})}
    ranges = {
        "partitionColumn": partition_column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": num_partitions,
    }
    given = [v is not None for v in ranges.values()]
    if any(given) and not all(given):
        raise ValueError("a split read needs partition_column, lower, upper and num_partitions")
    options.update({k: str(v) for k, v in ranges.items() if v is not None})
    return options


def _whole(value: object, up: bool) -> object:
    """Range bounds of a numeric column must be whole numbers, whatever the database calls its type."""
    if isinstance(value, Decimal | float):
        return math.ceil(value) if up else math.floor(value)
    return value


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    num_partitions: int = 16,
    properties: Mapping[str, str] | None = None,
    small: bool = False,
) -> DataFrame:
    """Database table, read in ``num_partitions`` ranges of a numeric, date or timestamp column.

    The range bounds come from one MIN/MAX query that the database answers. Without a partition
    column the table arrives through one task: say that it is ``small``.
    """
    if partition_column is None and not small:
        raise ValueError("name a partition_column, or say that the table is small: it would come through one task")
    reader = spark.read.format("jdbc")
    options = jdbc_options(url, table, properties=properties)
    if partition_column is not None:
        bounds = {k: v for k, v in options.items() if k != "dbtable"}
        bounds["query"] = f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {table}"
        low, high = spark.read.format("jdbc").options(**bounds).load().first()
        if low is not None:
            options = jdbc_options(
                url, table, partition_column, _whole(low, False), _whole(high, True), num_partitions, properties
            )
    return reader.options(**options).load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    max_connections: int = 16,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Write to a database over at most ``max_connections`` connections at a time."""
    options = {**jdbc_options(url, table, properties=properties), "numPartitions": str(max_connections)}
    df.write.format("jdbc").options(**options).mode(mode).save()
