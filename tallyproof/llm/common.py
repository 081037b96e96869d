"""What several corpus operators share: reading tables, folds, intermediate results, connected components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyproof.functions import checkpoint_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the supplied tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts


def give_back() -> None:
    """Return freed memory to the system: Python workers live on and would hold it while others need it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not this C library
        pass


def tidied(f: Callable) -> Callable:
    """A function for ``mapInArrow`` that gives memory back at the end of its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


def tidied_group(f: Callable) -> Callable:
    """A function of one group for ``applyInPandas`` that gives memory back after it."""

    def run(rows):
        try:
            return f(rows)
        finally:
            give_back()

    return run


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 400) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that few texts at a time become Python objects."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def by_bytes(batches: Iterator[pa.RecordBatch], text: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, so that no more become Python objects; a longer text is a batch of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // most
        cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1) != 0) if len(batch) else []
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(i, j - i)


def pack(x: np.ndarray) -> bytes:
    """Whole numbers, compressed: first all lowest bytes, then all the next, which suits small and slowly changing ones."""
    return zstandard.ZstdCompressor(level=3).compress(x.view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    """What ``pack`` was given."""
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def block_numbers() -> Iterator[int]:
    """Numbers for the blocks that a task makes, which no other task of the stage uses; at most 2^14 in a task."""
    first = TaskContext.get().partitionId() << 14
    return iter(range(first, first + (1 << 14)))


def with_fields(schema: StructType, added: str) -> StructType:
    """A schema with more fields, given as DDL."""
    return StructType([*schema.fields, *StructType.fromDDL(added).fields])


def set_aside(docs: DataFrame, *replaced: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` as doc_id, text and all other columns in one, so that no name clashes with an operator's; and the columns to select at the end.

    Columns in ``replaced`` are left out.
    """
    kept = [c for c in docs.columns if c not in replaced]
    others = [c for c in kept if c not in ("doc_id", "text")]
    rest = [F.struct(*[F.col(f"`{c}`") for c in others]).alias("_rest")] if others else []
    return docs.select("doc_id", "text", *rest), [F.col("_rest").getField(c).alias(c) if c in others else F.col(c) for c in kept]


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or one beside the warehouse's tables."""
    return checkpoint_folder(spark)


def settled(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder; later reads survive lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def let_go(spark: SparkSession) -> None:
    """Have shuffle files and checkpoints deleted that nothing refers to any more.

    Spark deletes them when the driver's garbage is collected, which is seldom in a job of few objects and many bytes. What a later
    step needs has been settled by then, so nothing is computed anew.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def within_bound(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """A settled frame of narrow rows, marked for broadcast if it has at most ``rows`` of them; beyond that joins shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: sizes what has to grow with the input."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def pieces(total: int, each: int, least: int = 16) -> int:
    """How many parts of about ``each`` bytes ``total`` bytes make."""
    return max(least, -(-total // each))


def reached(nodes: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links between places i and j of ``nodes``: each linked node and the smallest node that it reaches by them,
    where that is another. So many links become at most one for each node."""
    low = nodes.copy()
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        if (new == low).all():
            moved = np.flatnonzero(low != nodes)
            return nodes[moved], low[moved]
        low = new


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable by links, for every node that has a link.

    Alternating large-star and small-star steps: every step keeps at most one row per link, so a hub with a
    third of all nodes costs no more than its links. Each step is settled, so lineage stays short.
    """
    edges = settled(links.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).where("v < u").distinct())
    while True:
        # Dealt by node once: the minimum and the join with it both use that.
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).repartition("u")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").repartition("u")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = settled(small.where("u > v").distinct())
        # Done when all is stars: every node is a centre or has one, and not both.
        roles = edges.select(F.col("u").alias("n"), F.lit(1).alias("leaf")).unionByName(edges.select(F.col("v").alias("n"), F.lit(0).alias("leaf")))
        if roles.groupBy("n").agg(F.min("leaf").alias("low"), F.sum("leaf").alias("leaves")).where("leaves > 1 or (low = 0 and leaves > 0)").isEmpty():
            break
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)
