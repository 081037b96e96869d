"""Repeated byte strings by merging Burrows-Wheeler transforms.

All places of a string of ``length`` bytes have to meet. So documents are cut into runs of windows that share
a minimiser (see ``superkmers``), each run goes to the bucket of its minimiser, and a run that its task has
met earlier stays behind as wholly repeated. A bucket collapses equal runs to the earliest; of the rest, only
runs that share a minimiser can share a window. Their strings are dealt into shards, the transform of each
shard is built once, and the transforms are merged by refining how the shards' rows interleave: each round
sorts all rows by one more leading symbol, reading nothing but the transforms in order. Where a boundary
between two rows first shows tells their common prefix, and the intervals without a boundary after
``length`` bytes are the repeated strings. No suffix of one shard is ever compared with one of another.

A symbol is a block of several bytes, which divides the rounds by as much; suffixes at all byte offsets are
rows, so matches start and end at any byte.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.common import pieces, sliced, text_bytes, tidied, tidied_group, with_fields
from tallyproof.llm.superkmers import (
    MULTIPLIERS,
    SENT,
    SPANS,
    Outbox,
    Seen,
    heavy_keys,
    keyed_strings,
    level_keys,
    mixed,
    received,
    runs_of,
    segments,
    sliding_min,
    span_frame,
)

GRAIN = 16  # bytes of a minimiser
PART = 24 << 20  # bytes of text whose strings go to one task as one group; smaller groups pack worse
ALL, EQUAL = 1, 3  # the low byte of a tag: to be compared with all of its minimiser; one window, of which only equal strings are repeats
BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * MULTIPLIERS[0])


def byte_grams(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAIN bytes from every place on."""
    return grams_by_length(data, [GRAIN])[0]


def grams_by_length(data: np.ndarray, lengths: list[int]) -> list[np.ndarray]:
    """A hash of the bytes from every place on, for each of some lengths in order, by doubling."""
    h, have, out = BYTES[data], 1, []
    for length in lengths:
        while have * 2 <= length:
            h = h[:-have] * MULTIPLIERS[have] + h[have:] if len(h) > have else h[:0]
            have *= 2
        more = length - have  # the rest by two that overlap
        out.append(mixed(h if not more else h[:-more] * MULTIPLIERS[have - 1] + h[more:] if len(h) > more else h[:0]))
    return out


def levels(length: int) -> list[int]:
    """Bytes of the minimisers of each level, up to whole windows."""
    return sorted({GRAIN, 64 if length > 64 else 32, length})


def anchors(grams: np.ndarray, starts: np.ndarray, windows: np.ndarray, low: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each run first holds its minimiser, from its start, and whether it holds it again."""
    span = length - GRAIN + 1
    n = len(grams) - span + 1
    lows = sliding_min(grams, span)
    padded = np.concatenate([np.zeros(span - 1, np.uint64), lows, np.zeros(span - 1, np.uint64)])
    highest = ~sliding_min(~padded, span)  # the largest minimum of the windows that hold a gram
    at = np.flatnonzero(grams == highest[: len(grams)])
    values, rank = np.unique(grams[at], return_inverse=True)
    marks = np.sort(rank * np.int64(n + span) + at)
    own = np.searchsorted(values, low) * np.int64(n + span) + starts
    first = np.searchsorted(marks, own)
    return marks[first] - own, np.searchsorted(marks, own + windows + span - 1) - first > 1


def may_share(strings: list[bytes], anchor: list[int], length: int) -> np.ndarray:
    """Of runs with equal minimisers: those that also share enough text on one side of it.

    A shared window holds the minimiser and reaches at least half of the rest beyond it on one side.
    """
    reach = (length - GRAIN + 1) // 2
    sides = [[s[a : a + GRAIN + reach] for s, a in zip(strings, anchor, strict=True)], [s[max(0, a - reach) : a + GRAIN] for s, a in zip(strings, anchor, strict=True)]]
    out = np.zeros(len(strings), bool)
    for side in sides:
        often = Counter(side)
        out |= np.array([len(x) == GRAIN + reach and often[x] > 1 for x in side], bool)
    return out


def _grams(length: int) -> Callable:
    def grams_at(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        return grams_by_length(np.frombuffer(b"".join(texts), np.uint8), levels(length)), np.cumsum([len(t) for t in texts])

    return grams_at


def byte_segments(length: int) -> Callable:
    """Cuts a long text into pieces that share ``length - 1`` bytes, so that each window is in one: (first byte, piece)."""

    def cut(text: bytes, most: int) -> Iterator[tuple[int, bytes]]:
        for at in range(0, max(1, len(text) - length + 1), most):
            yield at, text[at : at + most + length - 1]

    return cut


def _send(length: int, buckets: int, parts: int, heavy: list[np.ndarray]):
    grains = levels(length)
    spans = [length - g + 1 for g in grains]
    top = max([k + 1 for k, x in enumerate(heavy) if len(x)], default=0)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, out = Seen(), Outbox(buckets, parts, b"", level=6)
        for ids, keys, begins, texts in segments(batches, byte_segments(length)):
            data = b"".join(texts)
            ends = np.cumsum([len(t) for t in texts])
            grams = grams_by_length(np.frombuffer(data, np.uint8), grains[: top + 1])
            key, level = level_keys(grams, spans, heavy[:top])
            starts, windows, low = keyed_strings(key, ends, length)
            if not len(starts):
                continue
            tags = (low >> np.uint64(40)).astype(np.uint32) << np.uint32(8) | np.uint32(ALL)
            depth = level[starts]
            plain = depth == 0
            anchor, multi = anchors(grams[0], starts[plain], windows[plain], low[plain], length)
            tags[plain] += (np.where(multi, ALL, anchor << 1) - ALL).astype(np.uint32)
            whole = depth == len(grains) - 1
            tags[whole] |= np.uint32(EQUAL)
            del grams, key, level, depth, plain
            owner = np.searchsorted(ends, starts, side="right")
            first = (np.concatenate([[0], ends[:-1]]) - np.array(begins))[owner]
            of = low % np.uint64(buckets)
            for s, w, b, k, f, t, e in zip(starts.tolist(), windows.tolist(), of.tolist(), owner.tolist(), first.tolist(), tags.tolist(), whole.tolist(), strict=True):
                packed, place = data[s : s + w + length - 1], (ids[k], keys[k], s - f)
                if e and w > 1 and packed.count(packed[:1]) == len(packed):  # one window again and again
                    out.repeats(*place[:2], place[2] + 1, w - 1)
                    packed, w = packed[:length], 1
                if seen.get(packed, place) < place:
                    out.repeats(*place, w)
                    continue
                seen.note(packed, place)
                out.send(b, *place, w, t if not e or w == 1 else t & ~EQUAL | ALL, packed)
            if out.full():
                yield out.flush()
        if out.queue or out.known:
            yield out.flush()

    return send


def _dense(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int32)


def _stable_order(codes: np.ndarray) -> np.ndarray:
    """Stable order of non-negative int32 codes by counting sorts of 16 bits."""
    order = np.argsort((codes & 0xFFFF).astype(np.uint16), kind="stable")
    if len(codes) and codes.max() > 0xFFFF:
        order = order[np.argsort((codes >> 16).astype(np.uint16)[order], kind="stable")]
    return order


def block_codes(data: np.ndarray, block: int) -> np.ndarray:
    """A number for the ``block`` bytes from every place on, equal where the bytes are equal."""
    half, packed = min(block, 5), np.zeros(len(data), np.int64)
    for k in range(half):
        packed[: len(data) - k] |= data[k:].astype(np.int64) << (8 * k)
    codes = _dense(packed)
    while half < block:
        step = min(half, block - half)
        ahead = np.zeros(len(data), np.int64)
        ahead[: len(data) - step] = codes[step:]
        codes, half = _dense(codes * np.int64(len(data)) + ahead), half + step
    return codes


def suffix_order(codes: np.ndarray, left: np.ndarray, block: int) -> np.ndarray:
    """Places of one shard in the order of their suffixes, which end with their string; ends come first."""
    n = len(codes)
    rank = np.where(left < block, np.arange(n), n + codes.astype(np.int64))
    rank = _dense(rank).astype(np.int64)
    step = block
    while rank.max(initial=-1) < n - 1:
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - step)] = rank[step:]
        rank = _dense(rank * n + np.where(left >= step, ahead, 0)).astype(np.int64)
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


def merge_transforms(codes: np.ndarray, left: np.ndarray, into: np.ndarray, cuts: np.ndarray, block: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all shards in the order of their next ``rounds`` symbols, and the symbols that each shares with
    the one before (``rounds`` where it shares all).

    ``left``: bytes to the end of the string; ``into``: bytes from its start; ``cuts``: where shards start and end.
    """
    places = np.concatenate([i + suffix_order(codes[i:j], left[i:j], block) for i, j in zip(cuts[:-1], cuts[1:], strict=True)])
    transform = np.where(into[places] >= block, codes[places - block], -1).astype(np.int32)
    shard = np.repeat(np.arange(len(cuts) - 1, dtype=np.uint16), np.diff(cuts))
    ends = shard[left < block]  # rows that hold no whole symbol: first, and equal to nothing
    interleave, common = shard, np.full(len(codes), rounds, np.int16)
    boundary = np.zeros(len(codes), bool)
    for level in range(rounds):
        symbol = np.empty_like(transform)
        symbol[np.argsort(interleave, kind="stable")] = transform
        group = np.cumsum(boundary, dtype=np.int32)
        inner = np.flatnonzero(symbol >= 0)
        order = inner[_stable_order(symbol[inner])]
        interleave = np.concatenate([ends, interleave[order]])
        symbol, group = symbol[order], group[order]
        boundary = np.ones(len(codes), bool)
        boundary[len(ends) + 1 :] = (symbol[1:] != symbol[:-1]) | (group[1:] != group[:-1])
        common[boundary & (common == rounds)] = level
    merged = np.empty(len(codes), np.int64)
    merged[np.argsort(interleave, kind="stable")] = places
    return merged, common


def repeated_in(strings: list[bytes], length: int, block: int, shard_bytes: int) -> np.ndarray:
    """For strings in document order: whether each of their windows starts earlier too, one after another."""
    sizes = np.array([len(s) for s in strings]) + 1
    data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    begins = np.cumsum(sizes) - sizes
    into = (np.arange(len(data)) - np.repeat(begins, sizes)).astype(np.int32)
    left = (np.repeat(sizes - 1, sizes) - into).astype(np.int32)
    shard = begins // shard_bytes
    cuts = np.append(begins[np.flatnonzero(np.diff(shard, prepend=-1))], len(data))
    merged, common = merge_transforms(block_codes(data, block), left, into, cuts, block, length // block)
    first = np.flatnonzero(common < length // block)
    earliest = np.minimum.reduceat(merged, first)
    repeated = np.zeros(len(data), bool)
    repeated[merged] = np.repeat(earliest, np.diff(np.append(first, len(data)))) < merged
    return repeated[left >= length]


def _repeats(x: dict[str, np.ndarray], data: bytes, length: int, block: int, shard_bytes: int, chunk_bytes: int) -> list[tuple]:
    """Runs of repeated windows among the strings of a bucket, which lie in ``data`` one after another."""
    sizes = x["windows"].astype(np.int64) + length - 1
    ends = np.cumsum(sizes)
    earlier, alone = [], []
    first: set[bytes] = set()
    for i in np.lexsort([x["starts"], x["keys"], x["docs"]]).tolist():
        string = data[ends[i] - sizes[i] : ends[i]]
        (earlier if string in first else alone).append(i)
        first.add(string)
    del first
    out = [tuple(x[n][earlier] for n in ("docs", "keys", "starts", "windows"))]
    tags = x["tags"][alone]
    _, inverse, shared = np.unique(tags >> 8, return_inverse=True, return_counts=True)
    whole = tags & 255 == EQUAL
    multi = (tags & 1 == 1) & ~whole
    _, mixed_in = np.unique(np.concatenate([np.arange(len(shared)), inverse[multi]]), return_counts=True)
    kin = np.flatnonzero((shared[inverse] > 1) & (mixed_in[inverse] == 1) & ~whole)
    own = [alone[i] for i in kin.tolist()]
    close = may_share([data[ends[i] - sizes[i] : ends[i]] for i in own], ((tags[kin] >> 1) & 127).tolist(), length)
    # With a minimiser that some run holds twice, all of its runs are compared.
    wanted = np.concatenate([kin[close], np.flatnonzero((mixed_in[inverse] > 1) & ~whole)])
    wanted = wanted[np.argsort(inverse[wanted], kind="stable")]
    total = np.cumsum(sizes[np.array(alone)[wanted]]) if len(wanted) else wanted
    new = np.flatnonzero(np.diff(inverse[wanted], prepend=-1))
    # Whole minimisers to each chunk, so that a chunk holds all strings that may share a window.
    chunk = np.repeat((total[new] // chunk_bytes), np.diff(np.append(new, len(wanted)))) if len(wanted) else wanted
    for c in np.unique(chunk):
        members = np.sort(wanted[chunk == c])  # positions in ``alone`` follow document order
        own = np.array(alone)[members]
        repeated = repeated_in([data[ends[i] - sizes[i] : ends[i]] for i in own.tolist()], length, block, shard_bytes)
        windows = x["windows"][own]
        string = np.repeat(own, windows)
        offset = np.arange(len(string)) - np.repeat(np.cumsum(windows) - windows, windows)
        hit = np.flatnonzero(repeated)
        at, n = runs_of(string[hit], hit)
        at = hit[at]
        out.append((x["docs"][string[at]], x["keys"][string[at]], x["starts"][string[at]] + offset[at], n))
    return out


def _merge(length: int, block: int, shard_bytes: int, chunk_bytes: int):
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        x, buckets = received(rows)
        out = [(x["docs"], x["keys"], x["starts"], x["windows"])]
        for x, strings in buckets:
            out += _repeats(x, b"".join(strings), length, block, shard_bytes, chunk_bytes)
        return span_frame(out)

    return merge


def repeated_bytes(docs: DataFrame, length: int = 100, block: int = 10, bucket_bytes: int = 3 << 20, shard_bytes: int = 128 << 10) -> DataFrame:
    """(doc_id, text_key, start, windows): runs of places whose next ``length`` bytes also start earlier.

    Earlier: in a smaller doc_id, or in the same document further ahead. ``length`` is a multiple of ``block``.
    ``text_key`` is ``hash(text)``; different texts under one doc_id are documents in the order of
    that key. Rows with a NULL id or text have no places. Windows of a minimiser that fills a bucket are dealt by a
    longer one, and where that does too, by a hash of all their bytes.
    """
    if length % block or not 2 * GRAIN <= length <= 127 + GRAIN:
        raise ValueError(f"length must be a multiple of {block}, from {2 * GRAIN} to {127 + GRAIN}")
    rows = docs.where("doc_id is not null and text is not null").selectExpr("cast(doc_id as long) doc_id", "hash(text) text_key", "text")
    total = text_bytes(docs)
    buckets = pieces(total, bucket_bytes)
    heavy = heavy_keys(rows, total, _grams(length), byte_segments(length), [length - g + 1 for g in levels(length)], length, bucket_bytes)
    sent = rows.mapInArrow(tidied(_send(length, buckets, min(buckets, pieces(total, PART)), heavy)), SENT)
    return sent.groupBy("part").applyInPandas(tidied_group(_merge(length, block, shard_bytes, 1 << 20)), SPANS)


def _cut(length: int, with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            n_bytes, n_removed, n_spans, digests, kept_bytes = [], [], [], [], []
            for text, found in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist(), strict=True):
                data, spans = text or b"", []
                for s, n in sorted((x["start"], x["windows"]) for x in found or ()):
                    if spans and s <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], s + n + length - 1)
                    else:
                        spans.append([s, s + n + length - 1])
                edges = [0, *(e for x in spans for e in x), len(data)]
                kept = b"".join([data[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)])
                n_bytes.append(len(data))
                n_removed.append(len(data) - len(kept))
                n_spans.append(len(spans))
                digests.append(hashlib.sha256(kept).hexdigest())
                kept_bytes.append(None if text is None else kept)
            rest = {n: batch.column(n) for n in batch.schema.names if n != "spans" and (with_text or n != "text")}
            rest |= {n: pa.array(v, pa.int64()) for n, v in (("n_bytes", n_bytes), ("n_removed", n_removed), ("n_spans", n_spans))}
            rest["kept_sha256"] = pa.array(digests, pa.string())
            if with_text:
                rest["kept_bytes"] = pa.array(kept_bytes, pa.binary())
            yield pa.RecordBatch.from_arrays(list(rest.values()), list(rest))

    return cut


def remove_repeated_bytes(docs: DataFrame, length: int = 100, with_text: bool = True) -> DataFrame:
    """The documents without bytes that lie in a string of ``length`` bytes which also starts earlier.

    Adds ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and (``with_text``) ``kept_bytes`` (binary: a cut
    may fall inside a character) to the columns of ``docs``, replacing columns of these names; without
    ``with_text``, ``text`` goes too. A NULL or empty text has no bytes. A row with a NULL doc_id keeps all its
    bytes and takes none. Equal rows (doc_id and text) are one document, and each gets that document's result.
    """
    mine = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes", "spans", "text_key", "_doc", "_key")
    own = docs.drop(*mine)
    spans = (
        repeated_bytes(own, length)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set(F.struct("start", "windows")).alias("spans"))
        .select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "spans")
    )
    joined = own.withColumn("text_key", F.hash("text")).join(spans, F.expr("doc_id = _doc and text_key = _key"), "left").drop("_doc", "_key", "text_key")
    shape = own.schema if with_text else own.drop("text").schema
    added = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_bytes binary" * with_text
    return joined.mapInArrow(tidied(_cut(length, with_text)), with_fields(shape, added))
