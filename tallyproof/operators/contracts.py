"""Declared rules on tables: allowed values, and schema contracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The states of the count table, numbered 1 to 4.
COUNT_STATES = (
    "All good – no issue in counts",
    "Data missing",
    "Reload – Post data missing (GRU to BI)",
    "Refill because of GRU reload (TLM to GRU Hive)",
)
CLUSTERS = ("NY", "NJ")


def domain_violations(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values of ``column`` outside ``allowed`` (NULL included) with the number of rows that hold them."""
    outside = F.col(column).isNull() | ~F.col(column).isin(*allowed)
    return df.where(outside).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def _uncastable(df: DataFrame, name: str, wanted: T.DataType) -> Column:
    """Values of a column that have no counterpart in another type.

    A failed cast of text to a whole number costs an exception per row, so text that cannot be one is
    told by its looks; the cast then only decides about the range.
    """
    col = F.col(name)
    fails = col.try_cast(wanted).isNull()
    if isinstance(df.schema[name].dataType, T.StringType) and isinstance(wanted, T.IntegralType):
        fails = ~col.rlike(r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$") | fails
    return col.isNotNull() & fails


def schema_contract(
    df: DataFrame, expected: T.StructType, check_values: bool = True
) -> DataFrame:
    """Breaches of ``expected`` as rows ``(column_name, problem, n_rows)``.

    ``missing``, ``extra`` and ``type`` come from the schema alone (``n_rows`` is NULL). ``null``
    counts NULLs in fields declared not nullable, and ``uncastable`` counts values that do not fit a
    differing declared type; both come from one aggregation over the table, whatever its width.
    """
    have = {f.name: f for f in df.schema.fields}
    want = {f.name: f for f in expected.fields}
    found: list[tuple[str, str]] = []
    measures: list[tuple[str, str, object]] = []
    for name, field in want.items():
        if name not in have:
            found.append((name, "missing"))
            continue
        if not field.nullable:
            measures.append((name, "null", F.col(name).isNull()))
        if have[name].dataType != field.dataType:
            found.append((name, "type"))
            measures.append((name, "uncastable", _uncastable(df, name, field.dataType)))
    found += [(name, "extra") for name in have if name not in want]

    layout = "column_name string, problem string, n_rows bigint"
    shape = df.sparkSession.createDataFrame([(n, p, None) for n, p in found], layout)
    if not (check_values and measures):
        return shape
    counted = df.agg(*[F.count_if(pred).alias(f"_{i}") for i, (_, _, pred) in enumerate(measures)])
    rows = F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.lit(p).alias("problem"), F.col(f"_{i}").alias("n_rows"))
        for i, (n, p, _) in enumerate(measures)
    ])
    return shape.unionByName(counted.select(F.inline(rows)).where(F.col("n_rows") > 0))
