"""Token ids as Arrow files of equal-length sequences.

Documents are dealt into ranges of their ids, and every range becomes a shard: an Arrow file whose batches hold two
fixed-size-list columns, ``ids`` and ``mask``, and a second file that says where each document lies. Within a shard the ids of
all documents follow each other without gaps; only its last sequence is padded, which its mask shows. Numbers lie in
the files as they lie in memory, so a reader maps a file and sees any sequence without copying or parsing.

A task names its files at random and reports them; the manifest, written by Spark, holds those of the tasks that
counted. A task that ran twice or died leaves files that no reader looks at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.llm.common import by_bytes, pieces, text_bytes, tidied
from tallyproof.llm.tokenizing import Remembered, SpacedParts, byte_level, part_of, parts_of, piece_begins, whole_begins

MANIFEST = "shard int, sequences string, documents string, n_docs long, n_ids long"
DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int64())])
PER_BATCH = 128  # sequences of a batch
INDEXED = 50_000  # documents of a batch of the second file
TOGETHER = 4 << 20  # bytes of text that are encoded together
HELD = 400_000  # words that a worker remembers twice over, in some 200 bytes each


def store(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return arrow_fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return arrow_fs.LocalFileSystem(), path


def schema_of(length: int, kind: np.dtype) -> pa.Schema:
    meta = {"length": str(length), "per_batch": str(PER_BATCH)}
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))], meta)


class _Shard:
    """The two files that a task writes, a batch at a time."""

    def __init__(self, folder: str, shard: int, length: int, kind: np.dtype):
        self.fs, base = store(folder)
        self.fs.create_dir(base, recursive=True)
        self.shard, self.length, self.kind = shard, length, kind
        self.names = [f"{shard:06d}-{uuid4().hex}.{what}.arrow" for what in ("sequences", "documents")]
        self.sinks = [self.fs.open_output_stream(f"{base}/{name}") for name in self.names]
        self.schema = schema_of(length, kind)
        self.files = [pa.ipc.new_file(sink, schema) for sink, schema in zip(self.sinks, (self.schema, DOCUMENTS), strict=True)]
        self.waiting, self.n_waiting, self.n_docs, self.n_ids = [], 0, 0, 0

    def add(self, doc_ids: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Documents with ``sizes`` of the ``ids``, which follow each other."""
        starts = self.n_ids + np.cumsum(sizes) - sizes
        for i in range(0, len(sizes), INDEXED):
            rows = [doc_ids.slice(i, INDEXED), pa.array(starts[i : i + INDEXED]), pa.array(sizes[i : i + INDEXED])]
            self.files[1].write_batch(pa.RecordBatch.from_arrays(rows, schema=DOCUMENTS))
        self.n_docs, self.n_ids = self.n_docs + len(sizes), self.n_ids + len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        full = PER_BATCH * self.length
        if self.n_waiting >= full:
            flat = np.concatenate(self.waiting)
            whole = len(flat) // full * full
            for i in range(0, whole, full):
                self._batch(flat[i : i + full], full)
            self.waiting, self.n_waiting = [flat[whole:]], len(flat) - whole

    def _batch(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        self.files[0].write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> pa.RecordBatch:
        """Pad and write what waits; the row of the manifest."""
        if self.n_waiting:
            flat = np.concatenate(self.waiting)
            self._batch(np.pad(flat, (0, -len(flat) % self.length)), len(flat))
        for file, sink in zip(self.files, self.sinks, strict=True):
            file.close()
            sink.close()
        row = [[self.shard], [self.names[0]], [self.names[1]], [self.n_docs], [self.n_ids]]
        types = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types, strict=True)], ["shard", "sequences", "documents", "n_docs", "n_ids"])


class _Encoder:
    """Texts to ids and an end, with what a worker remembers of earlier texts."""

    def __init__(self, path: str, end_id: int):
        self.tokenizer, cut = byte_level(path, False)
        self.kind = np.dtype(np.uint16 if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else np.uint32)
        self.end = self.kind.type(end_id).tobytes()
        self.begins = piece_begins if cut is parts_of else whole_begins
        self.parts = SpacedParts(path, False, self.kind, pieces=True) if cut is parts_of else None
        self.known = Remembered(self._ids, HELD)

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        texts = [p.decode() for p in pieces]
        if self.parts is not None:
            return self.parts(list(map(part_of, texts)))
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def of(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, with the end."""
        sizes, ids = self.flat(pa.array(texts, pa.string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text has with its end, and the ids of all texts after each other.

        A text is the sequence of its pieces. Arrow numbers the distinct ones, and only these become Python objects.
        """
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[starts[0] : starts[-1]]
        starts = starts - starts[0]
        begins = self.begins(data, starts)
        counts = np.diff(np.searchsorted(begins, starts))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(begins) - 1, [None, pa.py_buffer(begins), pa.py_buffer(data)]).dictionary_encode()
        ids = self.known.of([pieces.dictionary.to_numpy(zero_copy_only=False).tolist()])[0]
        table = pa.array([*ids, self.end], pa.large_binary())
        codes = np.insert(pieces.indices.to_numpy(), np.cumsum(counts), len(ids))
        lengths = np.diff(np.frombuffer(table.buffers()[1], np.int64, len(table) + 1)) // self.kind.itemsize
        sizes = np.add.reduceat(lengths[codes], np.cumsum(counts + 1) - counts - 1)
        return sizes, np.frombuffer(table.take(pa.array(codes)).buffers()[2], self.kind, sizes.sum())


@lru_cache(maxsize=2)
def _encoder(path: str, end_id: int) -> _Encoder:
    return _Encoder(path, end_id)


def _write(folder: str, path: str, end_id: int, length: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = _encoder(path, end_id), None
        for batch in by_bytes(batches, "text", TOGETHER):
            if not len(batch):
                continue
            if shard is None:
                shard = _Shard(folder, TaskContext.get().partitionId(), length, encoder.kind)
            shard.add(batch.column("doc_id"), *encoder.flat(batch.column("text")))
        if shard is not None:
            yield shard.close()

    return write


def write_sequences(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, length: int = 2048, shard_bytes: int = 32 << 20) -> DataFrame:
    """Write the ids of all texts of ``docs`` (doc_id, text; other columns are not looked at) to ``folder`` and return its manifest.

    ``tokenizer`` is a file of the tokenizers library, encoded without special tokens; ``end_id`` follows every document. Documents are in ascending
    order of doc_id; rows of one doc_id follow each other in the order of a hash of their texts, and rows with a NULL id come first.
    NULL and empty texts have the end alone. Equal rows are written as often as they occur. A text of any length goes through its task as
    a whole (some ten bytes of memory for each of its own) and may span many sequences. An empty table has an empty manifest.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("hash"), F.spark_partition_id().alias("origin"))
    # Equal rows may be a large share of all: where they come from deals them to several ranges.
    dealt = rows.repartitionByRange(pieces(text_bytes(docs), shard_bytes), F.asc_nulls_first("doc_id"), "hash", "origin")
    ordered = dealt.sortWithinPartitions(F.asc_nulls_first("doc_id"), "hash").select("doc_id", "text")
    manifest = ordered.mapInArrow(tidied(_write(folder, tokenizer, end_id, length)), MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return read_manifest(docs.sparkSession, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The shards of a folder, with the number of ids in all shards ``before`` each.

    Sums are taken over groups of shards and then over the groups, so no task sees all shards.
    """
    shards = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").withColumn("part", F.expr("shard div 1000"))
    groups = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    ahead = groups.selectExpr("part", "coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0) ahead")
    within = shards.withColumn("inner", F.expr("coalesce(sum(n_ids) over (partition by part order by shard rows between unbounded preceding and 1 preceding), 0)"))
    return within.join(ahead, "part").withColumn("before", F.col("ahead") + F.col("inner")).drop("part", "ahead", "inner")


class SequenceFile:
    """Random access to the sequences of one file. Local files are mapped: ``file[k]`` copies nothing."""

    def __init__(self, path: str):
        at, name = store(path)
        source = pa.memory_map(name) if isinstance(at, arrow_fs.LocalFileSystem) else at.open_input_file(name)
        self.file = pa.ipc.open_file(source)
        meta = self.file.schema.metadata
        self.length, self.per_batch = int(meta[b"length"]), int(meta[b"per_batch"])
        full = self.file.num_record_batches - 1
        self.size = 0 if full < 0 else full * self.per_batch + len(self.file.get_batch(full))

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of the k-th sequence; a mask has a bit for each id."""
        if not 0 <= k < self.size:
            raise IndexError(k)
        at = k % self.per_batch * self.length
        batch = self.file.get_batch(k // self.per_batch)
        ids, mask = (x.flatten().slice(at, self.length) for x in batch.columns)
        return ids.to_numpy(zero_copy_only=True), mask

    def between(self, start: int, stop: int) -> Iterator[np.ndarray]:
        """The ids from place ``start`` up to ``stop`` of the shard, as views of its batches."""
        full = self.per_batch * self.length
        for b in range(start // full, -(-stop // full)):
            ids = self.file.get_batch(b).column(0).flatten().to_numpy(zero_copy_only=True)
            yield ids[max(0, start - b * full) : stop - b * full]


def _read(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sequences = SequenceFile(f"{folder}/{row['sequences']}")
                at, name = store(f"{folder}/{row['documents']}")
                with at.open_input_file(name) as source:
                    index = pa.ipc.open_file(source)
                    for b in range(index.num_record_batches):
                        docs = index.get_batch(b)
                        crcs = []
                        for start, n in zip(docs.column("start").to_pylist(), docs.column("n").to_pylist(), strict=True):
                            crc = 0
                            for ids in sequences.between(start, start + n):
                                crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                            crcs.append(crc)
                        starts = pa.array(row["before"] + docs.column("start").to_numpy())
                        yield pa.RecordBatch.from_arrays([docs.column("doc_id"), starts, docs.column("n"), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return read


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of ``folder``, a task for each shard.

    ``start`` counts the ids of all documents before it, in all shards; ``ids_crc32`` is that of its ids as little-endian 32-bit numbers.
    """
    shards = read_manifest(spark, folder)
    spread = shards.repartition(max(1, shards.count()), "shard")
    return spread.mapInArrow(tidied(_read(folder)), "doc_id long, start long, n_tokens long, ids_crc32 long")
