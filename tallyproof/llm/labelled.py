"""Labelled rows for the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int, sample_bytes: int) -> list[tuple[int, bytes]]:
    """(label, text) of at most ``per_class`` distinct texts of each label, in an order set by a hash of their ids.

    ``learn`` says which doc_ids may be learned from. Whole texts are taken while they fit into ``sample_bytes`` of a class; one that doesn't fit is
    passed over, and so is any of more than an eighth of that. So both bounds hold on the driver whatever the size of the tables. Equal texts are one
    example, however many rows have them; with labels that differ it counts as 1. NULL labels, ids and texts are no examples.
    """
    marked = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = docs.where(learn & F.col("text").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("same"))
    # Hashes and sizes first: no text is shuffled, and none beyond the bounds is brought together.
    rows = known.select("doc_id", "same", F.octet_length("text").alias("n")).join(marked, "doc_id")
    sizes = rows.groupBy("same").agg(F.max("label").alias("label"), F.max("n").alias("n"), F.min(F.xxhash64("doc_id")).alias("h"))
    label_of: dict[int, int] = {}
    for value in (0, 1):
        size = 0
        for r in sizes.where((F.col("label") == value) & (F.col("n") <= sample_bytes // 8)).orderBy("h", "same").limit(per_class).collect():
            if size + r["n"] <= sample_bytes:
                size += r["n"]
                label_of[r["same"]] = value
    if not label_of:
        return []
    texts = known.where(F.col("same").isin(list(label_of))).groupBy("same").agg(F.min("text").alias("text")).collect()
    return sorted((label_of[r["same"]], r["text"].encode()) for r in texts)
