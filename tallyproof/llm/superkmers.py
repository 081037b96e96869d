"""Word-level repeats by super-k-mer partitioning.

Every window of ``width`` words has a minimiser: the smallest hash among its runs of ``grain`` words. Equal
windows have equal minimisers, so they meet in the same bucket. Consecutive windows of a document that share
a minimiser travel as one packed string. A task sends a string that it has already seen in a smaller document
no second time, as all its windows are known to repeat; so a passage or copy that a third of all documents
hold reaches its bucket once per task. In its bucket, windows are sorted and runs of equal ones are counted
exactly: hashes only bring them next to each other, words decide.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.common import by_bytes, pieces, sliced, text_bytes, tidied, tidied_group, with_fields

NUMBERS = {"docs": np.int64, "keys": np.int32, "starts": np.int32, "windows": np.int32, "tags": np.uint32}
SENT = "part int, known boolean, data binary"
SPANS = "doc_id long, text_key int, start int, windows int"
HELD = 24 << 20  # bytes of memory of the strings that a task holds before it sends them
OBJECT = 200  # bytes of memory that a held or remembered string takes besides its own, about
CACHED = 80_000  # entries of a task's caches
REMEMBERED = 16 << 20  # bytes of memory of the strings that a task remembers
TEXT = 1 << 20  # bytes of text that are looked at together
PART = 8 << 20  # bytes of text whose strings go to one task as one group, which takes several times that in JVM and worker
WORD = 6  # bytes of a word and the space after it, about
SURVEYED = 64 << 20  # bytes of text of which all are read to find hot keys
SPACE = re.compile(rb"[ \t-\r]")  # where bytes.split() divides
MULTIPLIERS = np.random.default_rng(13).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Hashes(dict):
    """Word to 64-bit hash; forgets everything when large, which costs time only."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, in log2(width) passes."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def runs_of(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of the runs in which positions follow each other and values are equal."""
    if not len(at):
        return at, at
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (values[1:] != values[:-1])]))
    return new, np.diff(np.append(new, len(at)))


def grams_of(hashes: np.ndarray, grain: int) -> np.ndarray:
    """One hash per run of ``grain`` words."""
    n = max(0, len(hashes) - grain + 1)
    grams = np.zeros(n, np.uint64)
    for k in range(grain if n else 0):
        grams += hashes[k : n + k] * MULTIPLIERS[k]
    return mixed(grams)


def strings_of(grams: np.ndarray, ends: np.ndarray, width: int, grain: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows and minimiser of each super-k-mer in documents that end at ``ends``."""
    n = len(grams) + grain - width
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    return keyed_strings(sliding_min(grams, width - grain + 1)[:n], ends, width)


def level_keys(grams: list[np.ndarray], spans: list[int], heavy: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The key of the window at each place, and its level: the minimum over ``spans[0]`` of its ``grams[0]``, unless that is among
    ``heavy[0]``; then the next level's, and so on. The last level has no heavy keys."""
    n = max(0, len(grams[0]) - spans[0] + 1)
    level = np.zeros(n, np.int8)
    if not n:
        return np.zeros(0, np.uint64), level
    key = sliding_min(grams[0], spans[0])[:n]
    open_ = np.arange(n)
    for k, known in enumerate(heavy):
        at = np.searchsorted(known, key[open_])
        open_ = open_[known[np.minimum(at, len(known) - 1)] == key[open_]] if len(known) else open_[:0]
        if not len(open_):
            break
        key[open_] = sliding_min(grams[k + 1], spans[k + 1])[open_]
        level[open_] = k + 1
    return key, level


def keyed_strings(key: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows and key of each run of windows that share a key, in documents that end at ``ends``."""
    n = len(key)
    last = np.repeat(ends, np.diff(np.concatenate([[0], ends])))[:n]
    at = np.flatnonzero(np.arange(n) + width <= last)
    first, windows = runs_of(key[at], at)
    return at[first], windows, key[at[first]]


def _tally(grams_at: Callable, cut: Callable, spans: list[int], width: int):
    """(level, key, n): different windows by key on every level but the last; a key comes once per task."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in spans[:-1]]

        def merged(parts: list) -> list:
            value, inverse = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
            return [(value, np.bincount(inverse, np.concatenate([n for _, n in parts]), len(value)))]

        for _, _, _, texts in segments(batches, cut):
            grams, ends = grams_at(texts)
            windows = grams[-1]
            last = np.repeat(ends, np.diff(np.concatenate([[0], ends])))[: len(windows)]
            own = np.flatnonzero(np.arange(len(windows)) + width <= last)
            own = own[np.unique(windows[own], return_index=True)[1]]  # copies are not sent again
            if not len(own):
                continue
            for k, span in enumerate(spans[:-1]):
                value, n = np.unique(sliding_min(grams[k], span)[own], return_counts=True)
                held[k].append((value, n.astype(float)))
                if len(held[k]) > 8:
                    held[k] = merged(held[k])
        for k, parts in enumerate(held):
            if parts:
                [(value, n)] = merged(parts)
                rows = [np.full(len(value), k, np.int32), value.view(np.int64), n.astype(np.int64)]
                for i in range(0, len(value), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 50_000]) for x in rows], ["level", "key", "n"])

    return tally


def heavy_keys(rows: DataFrame, total: int, grams_at: Callable, cut: Callable, spans: list[int], width: int, most: int) -> list[np.ndarray]:
    """The keys of each level but the last that more than ``most`` windows share, copies that are read together apart.

    They only say where windows go, so any choice leaves the result exact; so those of large inputs are found on a
    sixteenth of the documents, where a key of ``most`` windows still has thousands.
    """
    part = 16 if total > SURVEYED else 1
    some = rows.where(f"pmod(xxhash64(doc_id, text_key, 5), {part}) = 0") if part > 1 else rows
    counted = some.mapInArrow(tidied(_tally(grams_at, cut, spans, width)), "level int, key long, n long")
    found = counted.groupBy("level", "key").agg(F.sum("n").alias("n")).where(F.col("n") > max(1, most // part)).select("level", "key").toArrow()
    level, key = found["level"].to_numpy(), found["key"].to_numpy().view(np.uint64)
    return [np.sort(key[level == k]) for k in range(len(spans) - 1)]


def _planes(x: np.ndarray) -> bytes:
    """Differences, first all their lowest bytes, then all the next: numbers in order pack well so."""
    return np.diff(x, prepend=x.dtype.type(0)).view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes()


def _numbers(data: bytes, kind: type) -> np.ndarray:
    """What ``_planes`` was given."""
    width = np.dtype(kind).itemsize
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()
    return np.cumsum(steps, dtype=kind)


class Outbox:
    """What a task sends: strings by bucket, and runs of windows that it already knows to repeat.

    Buckets travel in parts of several: one row for a part, in which strings are in the order of their buckets. So what a
    row costs besides its strings does not follow the number of buckets.
    """

    def __init__(self, buckets: int, parts: int, joint: bytes, level: int = 3):
        self.parts, self.each, self.joint, self.flushed = parts, -(-buckets // parts), joint, 0
        self.queue: list[tuple] = []
        self.known: list[tuple] = []
        self.held = 0
        self.pack = zstandard.ZstdCompressor(level=level)

    def send(self, bucket: int, doc: int, key: int, start: int, windows: int, tag: int, packed: bytes) -> None:
        self.queue.append((bucket, doc, key, start, windows, tag, packed))
        self.held += len(packed) + OBJECT

    def repeats(self, doc: int, key: int, start: int, windows: int) -> None:
        """Note a run of repeated windows; runs that follow each other become one."""
        if self.known and self.known[-1][:2] == (doc, key) and sum(self.known[-1][2:]) == start:
            start, windows = self.known[-1][2], self.known[-1][3] + windows
            self.known.pop()
            self.held -= OBJECT
        self.known.append((doc, key, start, windows))
        self.held += OBJECT

    def full(self) -> bool:
        return self.held > HELD

    def _data(self, columns: dict[str, np.ndarray], buckets: np.ndarray, packed: list[bytes]) -> bytes:
        """Some strings in the order of their buckets: numbers, then the bucket, strings and bytes of each run, then the strings."""
        cuts = np.flatnonzero(np.diff(buckets, prepend=-1, append=-1))
        runs = [self.joint.join(packed[i:j]) for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        about = [np.array([len(buckets), len(runs)], np.int32), buckets[cuts[:-1]].astype(np.int32), np.diff(cuts).astype(np.int32), np.array([len(r) for r in runs], np.int32)]
        return self.pack.compress(b"".join([*(x.tobytes() for x in about), *(_planes(columns[n]) for n in NUMBERS), *runs]))

    def flush(self) -> pa.RecordBatch:
        rows: list[tuple[int, bool, bytes]] = []
        if self.queue:
            of, *numbers, packed = zip(*self.queue, strict=True)
            of = np.array(of)
            order = np.argsort(of, kind="stable")
            of, packed = of[order], [packed[k] for k in order.tolist()]
            columns = {n: np.array(x, t)[order] for x, (n, t) in zip(numbers, NUMBERS.items(), strict=True)}
            cuts = np.flatnonzero(np.diff(of // self.each, prepend=-1, append=-1))
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                rows.append((int(of[i]) // self.each, False, self._data({n: x[i:j] for n, x in columns.items()}, of[i:j] % self.each, packed[i:j])))
        if self.known:
            columns = {n: np.array(x, NUMBERS[n]) for n, x in zip(NUMBERS, zip(*self.known, strict=True), strict=False)}
            columns["tags"] = np.zeros(len(self.known), NUMBERS["tags"])
            rows.append(((self.known[0][0] * 31 + self.flushed) % self.parts, True, self._data(columns, np.zeros(len(self.known), int), [])))
        self.queue, self.known, self.held, self.flushed = [], [], 0, self.flushed + 1
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.bool_(), pa.binary()), strict=True)], ["part", "known", "data"])


def _opened(data: bytes) -> tuple[dict[str, np.ndarray], list[tuple[int, int, int]], bytes]:
    """Numbers, (bucket, strings, bytes) of each run, and the strings of a row that an Outbox made."""
    data = zstandard.ZstdDecompressor().decompress(data)
    n, runs = np.frombuffer(data, np.int32, 2).tolist()
    about = np.frombuffer(data, np.int32, 3 * runs, 8).reshape(3, runs)
    at, numbers = 8 + 12 * runs, {}
    for name, kind in NUMBERS.items():
        size = n * np.dtype(kind).itemsize
        numbers[name] = _numbers(data[at : at + size], kind)
        at += size
    return numbers, list(zip(*about.tolist(), strict=True)), data[at:]


def received(rows: pd.DataFrame) -> tuple[dict[str, np.ndarray], Iterator[tuple[dict[str, np.ndarray], list[bytes]]]]:
    """Of the rows of a part: runs that are known to repeat; and bucket by bucket, the strings' numbers and the strings, joined."""
    known = [_opened(x)[0] for x in rows.loc[rows["known"], "data"]]
    by_bucket: defaultdict[int, list] = defaultdict(list)
    for data in rows.loc[~rows["known"], "data"]:
        numbers, runs, strings = _opened(data)
        i = at = 0
        for bucket, n, size in runs:
            by_bucket[bucket].append(({k: x[i : i + n] for k, x in numbers.items()}, strings[at : at + size]))
            i, at = i + n, at + size

    def buckets() -> Iterator[tuple[dict[str, np.ndarray], list[bytes]]]:
        for bucket in sorted(by_bucket):
            found = by_bucket.pop(bucket)
            yield _together([x for x, _ in found]), [strings for _, strings in found]

    return _together(known), buckets()


def _together(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {n: np.concatenate([x[n] for x in parts]) if parts else np.zeros(0, t) for n, t in NUMBERS.items()}


def span_frame(parts: list[tuple]) -> pd.DataFrame:
    """SPANS from tuples of arrays."""
    return pd.DataFrame({n: np.concatenate([np.asarray(x[i]) for x in parts]) for i, n in enumerate(("doc_id", "text_key", "start", "windows"))})


def _read(texts: list[bytes], hashes: _Hashes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All words of some texts, where each text ends among them, and their hashes."""
    flat: list[bytes] = []
    ends = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        flat += text.split()
        ends[k] = len(flat)
    return flat, ends, np.fromiter(map(hashes.__getitem__, flat), np.uint64, len(flat))


def _grams(grains: list[int]) -> Callable:
    hashes = _Hashes()

    def grams_at(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        _, ends, values = _read(texts, hashes)
        return [grams_of(values, g) for g in grains], ends

    return grams_at


def word_segments(width: int) -> Callable:
    """Cuts a long text into pieces that share ``width - 1`` words, so that each window is in one: (first word, piece)."""

    def cut(text: bytes, most: int) -> Iterator[tuple[int, bytes]]:
        at, first, carried = 0, 0, []
        while at < len(text):
            found = SPACE.search(text, at + most)
            end = found.start() if found else len(text)
            words = text[at:end].split()
            joined = [*carried, *words]
            yield first - len(carried), b" ".join(joined)
            first, at = first + len(words), end
            carried = joined[max(0, len(joined) - width + 1) :]

    return cut


class Seen(dict):
    """Strings that a task has sent, with where the earliest was; forgets everything when large, which costs time only."""

    def __init__(self):
        super().__init__()
        self.held = 0

    def note(self, packed: bytes, place) -> None:
        self.held += len(packed) + OBJECT
        if len(self) > CACHED or self.held > REMEMBERED:
            self.clear()
            self.held = len(packed) + OBJECT
        self[packed] = place


def _send(width: int, grains: list[int], buckets: int, parts: int, heavy: list[np.ndarray]):
    spans = [width - g + 1 for g in grains]
    last = max([k + 1 for k, x in enumerate(heavy) if len(x)], default=0)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen, out = _Hashes(), Seen(), Outbox(buckets, parts, b" ")
        for ids, keys, begins, texts in segments(batches, word_segments(width)):
            flat, ends, values = _read(texts, hashes)
            key, _ = level_keys([grams_of(values, g) for g in grains[: last + 1]], spans, heavy[:last])
            starts, windows, low = keyed_strings(key, ends, width)
            owner = np.searchsorted(ends, starts, side="right")
            first = (np.concatenate([[0], ends[:-1]]) - np.array(begins))[owner]
            of = low % np.uint64(buckets)
            for s, w, b, k, f in zip(starts.tolist(), windows.tolist(), of.tolist(), owner.tolist(), first.tolist(), strict=True):
                packed, doc = b" ".join(flat[s : s + w + width - 1]), ids[k]
                if seen.get(packed, doc) < doc:
                    out.repeats(doc, keys[k], s - f, w)
                    continue
                seen.note(packed, doc)
                out.send(b, doc, keys[k], s - f, w, 0, packed)
            if out.full():
                yield out.flush()
        if out.queue or out.known:
            yield out.flush()

    return send


def segments(batches: Iterator[pa.RecordBatch], cut: Callable, most: int = TEXT) -> Iterator[tuple[list, list, list, list]]:
    """(ids, keys, first places, texts) of the rows, in parts of about ``most`` bytes of text; ``cut`` divides longer texts."""
    for batch in by_bytes(batches, "text", most):
        ids, keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()
        short = [k for k, text in enumerate(texts) if len(text) <= most]
        if short:
            yield [ids[k] for k in short], [keys[k] for k in short], [0] * len(short), [texts[k] for k in short]
        for k, text in enumerate(texts):
            if len(text) > most:
                for first, piece in cut(text, most):
                    yield [ids[k]], [keys[k]], [first], [piece]


def text_parts(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[tuple[list, list, list]]:
    """The rows of a batch in parts of about ``most`` bytes of text (a longer text is a part of its own)."""
    ids, keys, texts, size = [], [], [], 0
    for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
        ids.append(doc)
        keys.append(key)
        texts.append(text)
        size += len(text)
        if size > most:
            yield ids, keys, texts
            ids, keys, texts, size = [], [], [], 0
    if ids:
        yield ids, keys, texts


def smallest_owner(ids: np.ndarray, at: np.ndarray, width: int, owners: np.ndarray) -> np.ndarray:
    """For the windows of ``width`` ids that start at ``at``: the smallest owner of an equal window."""
    key = np.zeros(len(at), np.uint64)
    for k in range(width):
        key += mixed(ids[at + k].astype(np.uint64) + np.uint64(1)) * MULTIPLIERS[k]
    order = np.argsort(key)
    sorted_key, sorted_at = key[order], at[order]
    differs = sorted_key[1:] != sorted_key[:-1]
    near = np.flatnonzero(~differs)
    same = np.ones(len(near), bool)
    for k in range(width):
        same &= ids[sorted_at[near] + k] == ids[sorted_at[near + 1] + k]
    if not same.all():  # two different windows with one hash: sort by the words themselves
        order = np.lexsort([ids[at + k] for k in reversed(range(width))])
        sorted_at = at[order]
        differs = np.zeros(len(at) - 1, bool)
        for k in range(width):
            differs |= ids[sorted_at[1:] + k] != ids[sorted_at[:-1] + k]
    first = np.concatenate([[0], np.flatnonzero(differs) + 1]) if len(at) else at
    out = np.empty(len(at), np.int64)
    if len(at):
        low = np.minimum.reduceat(owners[order], first)
        out[order] = np.repeat(low, np.diff(np.append(first, len(at))))
    return out


def _count(width: int):
    def counted(rows: pd.DataFrame) -> pd.DataFrame:
        x, buckets = received(rows)
        out = [(x["docs"], x["keys"], x["starts"], x["windows"])]
        for x, packed in buckets:
            docs, keys, starts, windows = x["docs"], x["keys"], x["starts"], x["windows"]
            number: defaultdict[bytes, int] = defaultdict(count().__next__)
            sizes = windows.astype(np.int64) + width - 1
            ids, filled = np.empty(int(sizes.sum()), np.int32), 0
            for strings in packed:
                words = strings.split()
                ids[filled : filled + len(words)] = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
                filled += len(words)
            del number
            base = np.cumsum(sizes) - sizes
            string = np.repeat(np.arange(len(windows)), windows)
            offset = np.arange(len(string)) - np.repeat(np.cumsum(windows) - windows, windows)
            owners = docs[string]
            repeated = smallest_owner(ids, base[string] + offset, width, owners) < owners
            hit = np.flatnonzero(repeated)
            first, n = runs_of(string[hit], hit)
            at = hit[first]
            out.append((docs[string[at]], keys[string[at]], (starts[string[at]] + offset[at]).astype(np.int32), n.astype(np.int32)))
        return span_frame(out)

    return counted


def repeated_windows(docs: DataFrame, width: int = 13, grain: int = 2, bucket_bytes: int = 3 << 20) -> DataFrame:
    """(doc_id, text_key, start, windows): runs of windows that also start in a document with a smaller id.

    ``text_key`` is ``hash(text)`` and tells rows that share a doc_id apart. Rows with a NULL id or text
    have no windows. Bucket count follows the bytes of text. Windows of a minimiser that fills a bucket are dealt
    by a longer one, and where that does too, by a hash of all their words.
    """
    rows = docs.where("doc_id is not null and text is not null").selectExpr("cast(doc_id as long) doc_id", "hash(text) text_key", "text")
    total = text_bytes(docs)
    buckets = pieces(total, bucket_bytes)
    grains = sorted({min(grain, width), (grain + width) // 2, width})
    heavy = heavy_keys(rows, total, _grams(grains), word_segments(width), [width - g + 1 for g in grains], width, bucket_bytes // WORD)
    sent = rows.mapInArrow(tidied(_send(width, grains, buckets, min(buckets, pieces(total, PART)), heavy)), SENT)
    return sent.groupBy("part").applyInPandas(tidied_group(_count(width)), SPANS)


def _cut(width: int, with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            n_words, n_removed, digests, kept_texts = [], [], [], []
            spans = batch.column("spans").to_pylist()
            for text, found in zip(batch.column("text").cast(pa.binary()).to_pylist(), spans, strict=True):
                words = (text or b"").split()
                gone = np.zeros(len(words) + 1, np.int32)
                for x in found or ():
                    gone[x["start"]] += 1
                    gone[x["start"] + x["windows"] + width - 1] -= 1
                gone = np.cumsum(gone[:-1]) > 0 if len(words) else gone[:0].astype(bool)
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]) if found else b" ".join(words)
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(None if text is None else kept.decode() if gone.any() else text.decode())
            rest = {n: batch.column(n) for n in batch.schema.names if n != "spans" and (with_text or n != "text")}
            rest |= {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
            if with_text:
                rest["kept_text"] = pa.array(kept_texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(rest.values()), list(rest))

    return cut


def remove_repeats(docs: DataFrame, width: int = 13, with_text: bool = True) -> DataFrame:
    """The documents without words that lie in a window of ``width`` words found in a smaller doc_id.

    Adds ``n_words``, ``n_removed``, ``kept_sha256`` (of the kept words joined by one space) and (``with_text``)
    ``kept_text`` (those words, or the text as it was if it keeps all) to the columns of ``docs``, replacing columns of these names; without ``with_text``, ``text`` goes too. Words are runs of
    other than ASCII white space, and windows are judged on the input. A NULL or empty text has no words. A
    row with a NULL doc_id keeps all words and takes words from nobody. Rows that share a doc_id don't
    take words from each other; each is judged by its own text.
    """
    mine = ("n_words", "n_removed", "kept_sha256", "kept_text", "spans", "text_key", "_doc", "_key")
    own = docs.drop(*mine)
    spans = (
        repeated_windows(own, width)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set(F.struct("start", "windows")).alias("spans"))
        .select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "spans")
    )
    joined = own.withColumn("text_key", F.hash("text")).join(spans, F.expr("doc_id = _doc and text_key = _key"), "left").drop("_doc", "_key", "text_key")
    shape = own.schema if with_text else own.drop("text").schema
    added = "n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return joined.mapInArrow(tidied(_cut(width, with_text)), with_fields(shape, added))
