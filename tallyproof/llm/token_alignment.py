"""Alignment of two tokenizers over a corpus.

Equal texts are brought together first, so each distinct text is tokenised and aligned once and weighs as much as it
has copies. Tasks align blocks of texts: the byte offsets at which tokens of both sides end cut a text into groups, and
every stretch between two ends of either side links the two tokens that cover it. A block asks for the corpus-wide counts of
its pairs of ids, and gets them back as rows; so no task holds the counts of all pairs. Measures of texts are joined to
documents by a SHA-256 of the text.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.common import block_numbers, by_bytes, pack, settled, tidied, unpack, within_bound
from tallyproof.llm.tokenizing import Remembered, SpacedParts, byte_level, byte_level_bytes, parts_of, piece_bytes, sentence_pieces, whole

#: A block: 32 bytes a text in ``keys`` and ``digests``; its parts' codes by text; numbers and links (places in ``pairs``) by part; copies of each pair.
ARRAYS = {"sizes": np.int32, "codes": np.int32, "n_a": np.int32, "n_b": np.int32, "n_groups": np.int32, "n_links": np.int32, "links": np.int32, "pairs": np.int64, "weights": np.int64}
BLOCK = "block long, keys binary, digests binary, " + ", ".join(f"{n} binary" for n in ARRAYS)
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
TEXTS = "key binary, " + ", ".join(f"{n} long" for n in MEASURES) + ", groups_sha256 string"


def align(ids_a: list[list[int]], ids_b: list[list[int]], bytes_a: list[bytes], bytes_b: list[bytes], texts: list[bytes]) -> list[tuple | None]:
    """For each text: numbers of tokens of both sides and of groups, the linked pairs (a << 32 | b) in order, and the groups as text.

    None for a text that the tokens of either side don't spell, or an empty one.
    """
    spelt = [bool(t) and b"".join(map(bytes_a.__getitem__, a)) == t == b"".join(map(bytes_b.__getitem__, b)) for t, a, b in zip(texts, ids_a, ids_b, strict=True)]
    if not all(spelt):
        good = [[x for x, ok in zip(xs, spelt, strict=True) if ok] for xs in (ids_a, ids_b, texts)]
        found = iter(align(good[0], good[1], bytes_a, bytes_b, good[2]))
        return [next(found) if ok else None for ok in spelt]
    if not texts:
        return []
    a, b = (np.array([i for ids in side for i in ids], np.int64) for side in (ids_a, ids_b))
    ends_a, ends_b = (np.cumsum([len(table[i]) for i in ids.tolist()]) for table, ids in ((bytes_a, a), (bytes_b, b)))
    stop = np.cumsum([len(t) for t in texts])
    ends = np.union1d(ends_a, ends_b)
    pairs = a[np.searchsorted(ends_a, ends)] << 32 | b[np.searchsorted(ends_b, ends)]
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    # Tokens by group, those of A first.
    side = np.concatenate([np.searchsorted(common, ends_a) * 2, np.searchsorted(common, ends_b) * 2 + 1])
    order = np.argsort(side, kind="stable")
    side, names = side[order], np.concatenate([a, b])[order].tolist()
    follows = np.append(side[1:] - side[:-1], 2)
    marks = ["," if x == 0 else ";" if y & 1 else "|" for x, y in zip(follows.tolist(), side.tolist(), strict=True)]
    group_at, link_at, a_at, b_at = (np.searchsorted(x, stop, side="right") for x in (common, ends, ends_a, ends_b))
    token_at = a_at + b_at
    named = [f"{n}{m}" for n, m in zip(names, marks, strict=True)]
    out, last = [], (0, 0, 0, 0, 0)
    for now in zip(token_at.tolist(), group_at.tolist(), link_at.tolist(), a_at.tolist(), b_at.tolist(), strict=True):
        groups = "".join(named[last[0] : now[0]])[:-1].encode()
        out.append((now[3] - last[3], now[4] - last[4], now[1] - last[1], pairs[last[2] : now[2]].tobytes(), groups))
        last = now
    return out


class _Aligner:
    """Both tokenizers; what they make of a part of a text, remembered."""

    def __init__(self, path_a: str, path_b: str):
        self.a, cut_a = byte_level(path_a, True)
        self.b, cut_b = sentence_pieces(path_b)
        self.cut = parts_of if cut_a is cut_b is parts_of else whole
        self.bytes_a, self.bytes_b = byte_level_bytes(path_a, True), piece_bytes(path_b)
        self.spaced_a = SpacedParts(path_a, True) if self.cut is parts_of else None
        self.known = Remembered(self._aligned, 200_000)

    def _aligned(self, parts: list[str]) -> list[tuple | None]:
        # B puts a space before what it is given.
        if not parts:
            return []
        if self.spaced_a is None:
            ids_a = [e.ids for e in self.a.encode_batch_fast([f" {p}" for p in parts], add_special_tokens=False)]
        else:
            ids_a = [np.frombuffer(x, np.uint32).tolist() for x in self.spaced_a(parts)]
        ids_b = self.b.encode(parts, num_threads=1)
        return align(ids_a, ids_b, self.bytes_a, self.bytes_b, [f" {p}".encode() for p in parts])

    def of(self, texts: list[str]) -> tuple[list[list[str]], list[list[tuple | None]]]:
        parts = [self.cut(t) for t in texts]
        return parts, self.known.of(parts)


@lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str) -> _Aligner:
    """The aligner of a worker, which remembers words from task to task."""
    return _Aligner(path_a, path_b)


class _Block:
    """Texts and their alignments, up to a size."""

    def __init__(self):
        self.keys, self.digests, self.sizes, self.codes, self.copies = [], [], [], [], []
        self.number: defaultdict[str, int] = defaultdict(count().__next__)
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, key: bytes, copies: int, parts: list[str], found: list[tuple | None]) -> None:
        if None in found:
            return
        codes = [self.number[p] for p in parts]
        if len(self.number) > len(self.parts):
            for code, x in zip(codes, found, strict=True):
                if code == len(self.parts):
                    self.parts.append(x[:4])
        self.keys.append(key)
        self.copies.append(copies)
        self.sizes.append(len(parts))
        self.codes.append(np.array(codes, np.int32))
        self.digests.append(hashlib.sha256(b";".join([x[4] for x in found])).digest())
        self.size += sum(map(len, parts))

    def row(self, name: int) -> pa.RecordBatch:
        codes, sizes = np.concatenate(self.codes), np.array(self.sizes, np.int32)
        numbers = {n: np.array(x, np.int32) for n, x in zip(("n_a", "n_b", "n_groups"), zip(*[p[:3] for p in self.parts], strict=True), strict=True)}
        n_links = np.array([len(p[3]) // 8 for p in self.parts], np.int32)
        pairs, links = np.unique(np.frombuffer(b"".join([p[3] for p in self.parts]), np.int64), return_inverse=True)
        occurs = np.zeros(len(self.parts), np.int64)
        np.add.at(occurs, codes, np.repeat(np.array(self.copies, np.int64), sizes))
        weights = np.zeros(len(pairs), np.int64)
        np.add.at(weights, links, np.repeat(occurs, n_links))
        arrays = {"sizes": sizes, "codes": codes, **numbers, "n_links": n_links, "links": links.astype(np.int32), "pairs": pairs, "weights": weights}
        values = {"block": name, "keys": b"".join(self.keys), "digests": b"".join(self.digests)} | {n: pack(arrays[n]) for n in ARRAYS}
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in values.values()], list(values))


def _align(path_a: str, path_b: str, block_bytes: int):
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, block = block_numbers(), _Block()
        for batch in by_bytes(batches, "text"):
            aligner = _aligner(path_a, path_b)
            parts, found = aligner.of(batch.column("text").to_pylist())
            for row in zip(batch.column("key").to_pylist(), batch.column("copies").to_pylist(), parts, found, strict=True):
                block.add(*row)
            if block.size >= block_bytes:
                yield block.row(next(names))
                block = _Block()
        if block.keys:
            yield block.row(next(names))

    return aligned


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, place, a, b, n): each pair of a block and how many links hold it there."""
    for batch in batches:
        for block, pairs, weights in zip(*(batch.column(n).to_pylist() for n in ("block", "pairs", "weights")), strict=True):
            x, n = unpack(pairs, np.int64), unpack(weights, np.int64)
            columns = [np.full(len(x), block), np.arange(len(x), dtype=np.int32), (x >> 32).astype(np.int32), (x & 0xFFFFFFFF).astype(np.int32), n]
            for i in range(0, len(x), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 50_000]) for c in columns], ["block", "place", "a", "b", "n"])


def _measure(block: pa.Table, replies: pa.Table) -> pa.Table:
    """The measures of a block's texts, from the corpus-wide counts of its pairs."""
    row = block.to_pylist()[0]
    x = {n: unpack(row[n], kind) for n, kind in ARRAYS.items()}
    counts, best = (np.zeros(len(x["pairs"]), np.int64) for _ in range(2))
    place = replies.column("place").to_numpy()
    counts[place], best[place] = replies.column("count").to_numpy(), replies.column("best").to_numpy()
    by_part = {n: x[n].astype(np.int64) for n in ("n_a", "n_b", "n_groups", "n_links")}
    first = np.cumsum(by_part["n_links"]) - by_part["n_links"]
    by_part |= {"n_best": np.add.reduceat(best[x["links"]], first), "count_sum": np.add.reduceat(counts[x["links"]], first)}
    begins = np.cumsum(x["sizes"], dtype=np.int64) - x["sizes"]
    keys, digests = ([row[n][i : i + 32] for i in range(0, len(row[n]), 32)] for n in ("keys", "digests"))
    columns = {"key": pa.array(keys, pa.binary())} | {n: pa.array(np.add.reduceat(by_part[n][x["codes"]], begins)) for n in MEASURES}
    return pa.table(columns | {"groups_sha256": pa.array([d.hex() for d in digests], pa.string())})


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, count, best): the links of each pair of ids, and whether no id of A has more with this id of B."""
    counts = settled(blocks.select("block", "pairs", "weights").mapInArrow(_ask, "block long, place int, a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("count")))
    top = counts.groupBy("b").agg(F.max("count").alias("top"))
    return counts.join(top, "b").select("a", "b", "count", (F.col("count") == F.col("top")).alias("best"))


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = 8 << 20) -> DataFrame:
    """The distinct texts of ``docs``, aligned, in settled blocks. ``path_a`` is a byte-level file of the tokenizers library, ``path_b`` of sentencepiece."""
    texts = docs.where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    rows = texts.select(F.unhex(F.sha2("text", 256)).alias("key"), "copies", "text")
    return settled(rows.mapInArrow(tidied(_align(path_a, path_b, block_bytes)), BLOCK))


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of ``docs`` (doc_id, text; other columns are not looked at).

    Tokens are those of A for a space and the text, and of B for the text. ``count_sum`` adds up the corpus-wide count of the pair of each link; ``n_best``
    counts the links whose pair has the highest count of its B id. ``groups_sha256`` is that of ``a1,a2|b1;a3|b2`` (ids by group). NULL and
    empty texts, and those whose tokens don't spell a space and the text, have zeros and an empty text there. Rows with a NULL or a repeated
    doc_id are rows like any other, and count as copies where their texts are equal. A text is aligned in one task, with some hundred bytes of memory for each of its own.
    """
    blocks = aligned_blocks(docs, path_a, path_b)
    counts = within_bound(settled(pair_counts(blocks)), 1_000_000)  # rows of 21 bytes
    asked = blocks.select("block", "pairs", "weights").mapInArrow(_ask, "block long, place int, a int, b int, n long")
    replies = asked.join(counts, ["a", "b"]).select("block", "place", "count", F.col("best").cast("long").alias("best"))
    measured = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_measure, TEXTS)
    # Rows without a text would all share the NULL key: they get one of their own that no text has.
    key = F.when(F.col("text") != "", F.unhex(F.sha2("text", 256))).otherwise(F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.spark_partition_id()))))
    rows = docs.select("doc_id", key.alias("key")).join(measured, "key", "left")
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in MEASURES], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
