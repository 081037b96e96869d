"""Sequential version numbers that continue from the stored maximum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyproof.functions import settle

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row's position in the low 33 bits


def numbered(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Add ``name`` = 1, 2, 3, … in the order of ``order_by`` (ascending, NULLs first).

    A global ``row_number`` window sorts the whole table in one task, and a window per day does so
    for a day that holds most rows. Here the table is range-sorted in parallel and kept by a reliable
    checkpoint, which freezes the partition and position of every row. The partition sizes, one
    number per partition, are summed up and added to the positions.
    """
    place = F.monotonically_increasing_id()
    ordered = settle(
        df.orderBy(*order_by)
        .withColumn("_place", place)
        .withColumn("_part", F.shiftright("_place", _LOCAL_BITS))
        .withColumn("_pos", F.col("_place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
        .drop("_place")
    )
    # One row per partition of the checkpoint: that bounds this window and the broadcast below.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_offset")
    )


def assign_versions(
    new: DataFrame,
    stored: DataFrame,
    order_by: Sequence[str] = ("run_date", "run_time"),
    tie_breakers: Sequence[str] = (),
    version_col: str = "version_no",
) -> DataFrame:
    """Number ``new`` on from the highest version in ``stored`` (from 1 when that is empty).

    ``tie_breakers`` must make the order total, or rows with equal stamps could trade numbers from
    one run to the next. The numbering itself is computed when this is called.
    """
    if not tie_breakers:
        raise ValueError("name tie_breakers: equal stamps would be numbered in no particular order")
    highest = stored.agg(F.coalesce(F.max(version_col), F.lit(0)).cast("bigint")).scalar()
    ranked = numbered(new.drop(version_col), [*order_by, *tie_breakers], "_rank")
    return ranked.withColumn(version_col, highest + F.col("_rank")).drop("_rank")
