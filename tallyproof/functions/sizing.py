"""Materialising a frame once, and broadcasting it only when its size has been counted.

Both helpers write to the session's reliable checkpoint folder, so a lost executor costs a re-read
and never a different answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest frame that is sent to every executor: rows, and bytes of their values as text.
SMALL_ROWS = 200_000
SMALL_BYTES = 64 * 1024 * 1024


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where none is set, one beside the warehouse's tables.

    Driver and executors share the warehouse's file system. A folder of one machine would not do.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` now and cut its lineage with a reliable checkpoint."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def settle_small(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Compute ``df`` once; mark it for broadcast only if it was counted and measured to be small.

    Beyond either bound the frame comes back without a hint, so the join that uses it is a shuffled
    one, with adaptive execution splitting hot partitions.
    """
    settled = settle(df)
    width = sum(
        (F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns), F.lit(0)
    )
    rows, size = settled.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(settled) if rows <= max_rows and size <= max_bytes else settled
