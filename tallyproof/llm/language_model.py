"""Log-likelihoods of whole documents by a gated recurrent language model, beside a word-count base.

Documents become blocks: a block holds its own words once and its texts as numbers. Word counts are
joined to the words of each block, not to every token: each block sends each bucket of words one packed list, and gets
the corpus counts of that list back. The recurrent model knows the words that are most frequent in the training texts; all other
words are in one of TAILS groups by their endings, and within a group a word has its share of the counts. It is learned from all
training texts: a short start on a bounded part gives weights, from which every partition learns on all of its own texts, and
the average of the partitions' weights, by tokens, is the model.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.llm import gru
from tallyproof.llm.common import pieces, settled, text_bytes
from tallyproof.llm.superkmers import _numbers, _planes

TAILS = 64
KNOWN = 1024  # words of the model, the end of a text among them
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BLOCK = "block string, docs binary, missing binary, held binary, sizes binary, ids binary, words binary, seen binary"
START_TOKENS = 400_000


def _open(x: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(x)


def _pack(x: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x)


def _blocks(block_bytes: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            docs, held, texts = zip(*rows, strict=True)
            number: defaultdict[bytes, int] = defaultdict(count().__next__)
            end = number[b""]
            sizes, parts = [], []
            for text in texts:
                words = text.translate(LOWER).split()
                words.append(b"")
                sizes.append(len(words))
                parts.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
            ids = np.concatenate(parts)
            often = np.bincount(ids, minlength=len(number))
            order = np.argsort(-often, kind="stable")  # small numbers for frequent words
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order))
            ids = rank[ids]
            learn = ~np.repeat(np.array(held), sizes)
            seen = np.bincount(ids[learn], minlength=len(order)).astype(np.int32)
            names = list(number)
            words = b"\n".join([names[i] for i in order.tolist()])
            assert end == 0
            known = np.array([0 if d is None else d for d in docs], np.int64)
            missing = np.array([d is None for d in docs], np.uint8)
            columns = [known.tobytes(), missing.tobytes(), np.array(held, np.uint8).tobytes(), np.array(sizes, np.int32).tobytes(), _pack(_planes(ids)), _pack(words), _pack(_planes(seen))]
            name = xxhash.xxh3_128_hexdigest(b"".join(columns))
            return pa.RecordBatch.from_arrays([pa.array([name])] + [pa.array([c], pa.binary()) for c in columns], [f.split()[0] for f in BLOCK.split(", ")])

        for batch in batches:
            for doc, held, text in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                rows.append((doc, held, text))
                size += len(text)
                if size >= block_bytes or len(rows) >= 100_000:
                    yield flush()
                    rows, size = [], 0
        if rows:
            yield flush()

    return blocks


def _buckets(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of words by bucket, and where each bucket starts in it."""
    of = np.fromiter(map(xxhash.xxh32_intdigest, words), np.int64, len(words)) % buckets
    order = np.argsort(of, kind="stable")
    return order, np.searchsorted(of[order], np.arange(buckets + 1))


def tail_of(word: bytes) -> int:
    """The group of a word that the model doesn't know: by its last bytes."""
    return xxhash.xxh32_intdigest(word[-3:]) % TAILS


def _ask(buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, words, seen in zip(*(batch.column(n).to_pylist() for n in ("block", "words", "seen")), strict=True):
                words, seen = _open(words).split(b"\n"), _numbers(_open(seen), np.int32)
                order, cuts = _buckets(words, buckets)
                rows = [(b, cuts[b], cuts[b + 1]) for b in range(buckets) if cuts[b] < cuts[b + 1]]
                lists = [order[i:j] for _, i, j in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([b for b, _, _ in rows], pa.int32()),
                        pa.array([name] * len(rows)),
                        pa.array([_pack(b"\n".join([words[k] for k in o.tolist()])) for o in lists], pa.binary()),
                        pa.array([_pack(_planes(seen[o])) for o in lists], pa.binary()),
                    ],
                    ["bucket", "block", "words", "seen"],
                )

    return ask


ANSWER = "block string, bucket int, totals binary, distinct long, tokens long, top array<struct<word: binary, n: long>>, tails array<double>"


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of the words of one bucket, for each block that asked; and a row on the bucket itself."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    lists = []
    for words in rows["words"]:
        words = _open(words).split(b"\n")
        lists.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
    totals = np.zeros(len(number), np.int64)
    for own, seen in zip(lists, rows["seen"], strict=True):
        totals[own] += _numbers(_open(seen), np.int32)  # a list holds a word once
    names = list(number)
    tails = np.bincount(np.fromiter(map(tail_of, names), np.int64, len(names)), np.where(totals > 0, totals + 0.5, 0), TAILS)
    top = np.lexsort([np.array(names, object).argsort().argsort(), -totals])[:KNOWN]
    out = [(b, int(k), _pack(_planes(totals[own])), None, None, None, None) for b, k, own in zip(rows["block"], rows["bucket"], lists, strict=True)]
    out.append((None, int(rows["bucket"].iloc[0]), None, int((totals > 0).sum()), int(totals.sum()), [{"word": names[i], "n": int(totals[i])} for i in top.tolist() if totals[i]], tails.tolist()))
    return pd.DataFrame(out, columns=[c.split()[0] for c in ("block", "bucket", "totals", "distinct", "tokens", "top", "tails")])


class Vocabulary:
    """Words that the model knows, and what a word outside has of its group's share."""

    def __init__(self, top: list[tuple[bytes, int]], tails: np.ndarray, tokens: int, distinct: int):
        self.numbers = {w: k for k, (w, _) in enumerate(top)}
        self.tokens, self.distinct = tokens, distinct
        self.mass = tails + 0.5  # room for a word that no training text has
        for w, n in top:
            self.mass[tail_of(w)] -= n + 0.5
        self.size = KNOWN + TAILS
        self.counts = np.zeros(self.size)
        self.counts[: len(top)] = [n for _, n in top]
        self.counts[KNOWN:] = self.mass

    def look_up(self, words: list[bytes]) -> np.ndarray:
        """Model numbers of words."""
        known = self.numbers
        return np.fromiter((known[w] if w in known else KNOWN + tail_of(w) for w in words), np.int32, len(words))


def _texts(row: dict, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """A block's sizes, model numbers, own numbers, and words."""
    words = _open(row["words"]).split(b"\n")
    ids = _numbers(_open(row["ids"]), np.int32)
    return np.frombuffer(row["sizes"], np.int32), vocabulary.look_up(words)[ids], ids, words


def _training_words(row: dict, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Model numbers of a block's training texts, and which are the first of their text."""
    sizes, words, _, _ = _texts(row, vocabulary)
    learn = np.repeat(np.frombuffer(row["held"], np.uint8) == 0, sizes)
    starts = np.zeros(len(words), bool)
    starts[np.cumsum(sizes) - sizes] = True
    return words[learn], starts[learn]


def _learn(p: gru.Params, vocabulary: Vocabulary, rate: float):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, adam, tokens = {n: v.copy() for n, v in p.items()}, gru.Adam(p), 0
        for batch in batches:
            for row in batch.to_pylist():
                words, starts = _training_words(row, vocabulary)
                if len(words):
                    # The rate falls with what has been learned, so that partitions end close to each other.
                    gru.train(own, words, starts, adam, rate / (1 + tokens / 2_000_000))
                    tokens += len(words)
        if tokens:
            yield pa.RecordBatch.from_arrays([pa.array([tokens], pa.int64()), pa.array([gru.flat(own).tolist()], pa.list_(pa.float32()))], ["tokens", "weights"])

    return learn


def learned(blocks: DataFrame, vocabulary: Vocabulary, rate: float = 0.004) -> gru.Params:
    """The model from all training texts of ``blocks``."""
    p = gru.initial(vocabulary.counts)
    name = blocks.agg(F.min("block")).first()[0]
    if name is None:
        return p
    first = blocks.where(F.col("block") == name).limit(1).collect()
    words, starts = _training_words(first[0].asDict(), vocabulary)
    words, starts = words[:START_TOKENS], starts[:START_TOKENS]
    adam = gru.Adam(p)
    for part in range(3):
        gru.train(p, words, starts, adam, 0.01 / (1 + part), lanes=128)
    weights = blocks.mapInArrow(_learn(p, vocabulary, rate), "tokens long, weights array<float>")
    # A mean for every weight, summed where the partitions are: what comes back has the size of one model.
    each = weights.select("tokens", F.posexplode("weights").alias("k", "w")).groupBy("k").agg((F.sum(F.col("tokens") * F.col("w")) / F.sum("tokens")).alias("w"))
    rows = each.collect()
    if not rows:
        return p
    values = np.zeros(len(rows), np.float32)
    values[[r["k"] for r in rows]] = [r["w"] for r in rows]
    return gru.shaped(values, vocabulary.size)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(p: gru.Params, vocabulary: Vocabulary, buckets: int):
    n, v = vocabulary.tokens, vocabulary.distinct

    def score(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        answers = answers.sort_values("bucket")
        for row in block.drop_duplicates("block").to_dict("records"):  # equal blocks are answered alike, below
            sizes, numbers, ids, words = _texts(row, vocabulary)
            order, _ = _buckets(words, buckets)
            totals = np.empty(len(words), np.int64)
            given = answers[answers["block"] == row["block"]].drop_duplicates("bucket")
            totals[order] = np.concatenate([_numbers(_open(x), np.int64) for x in given["totals"]])
            base = np.log10((totals + 0.5) / (n + 0.5 * (v + 1)))
            tail = np.array([0.0 if w in vocabulary.numbers else np.log10((t + 0.5) / vocabulary.mass[tail_of(w)]) for w, t in zip(words, totals.tolist(), strict=True)])
            begins = np.cumsum(sizes) - sizes
            logs = gru.log_likelihoods(p, numbers, sizes) / np.log(10) + tail[ids]
            frame = pd.DataFrame(
                {
                    "doc_id": pd.array(np.frombuffer(row["docs"], np.int64), "Int64"),
                    "held_out": np.frombuffer(row["held"], np.uint8) > 0,
                    "n_tokens": sizes.astype(np.int64),
                    "n_known": np.add.reduceat((totals > 0)[ids].astype(np.int64), begins),
                    "train_tokens": n,
                    "base_score": np.add.reduceat(base[ids], begins),
                    "score": np.add.reduceat(logs, begins),
                }
            )
            frame.loc[np.frombuffer(row["missing"], np.uint8) > 0, "doc_id"] = pd.NA
            out += [frame] * int((block["block"] == row["block"]).sum())
        return pd.concat(out) if out else pd.DataFrame(columns=[c.split()[0] for c in SCORES.split(", ")])

    return score


def score_documents(docs: DataFrame, held_out: Column, block_bytes: int = 12 << 20, bucket_bytes: int = 16 << 20) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs`` (doc_id, text).

    Words are runs of other than ASCII white space with A-Z in lower case; a text's last token is its end. Counts and the
    model come from the rows for which ``held_out`` is false. ``base_score`` sums log10((c + 0.5) / (N + 0.5 * (V + 1))) over tokens;
    ``score`` is the recurrent model's log10 probability of the whole text. A NULL text is an empty one. Rows are scored
    one by one, whatever their doc_id. Without training rows both are uniform guesses.
    """
    buckets = pieces(text_bytes(docs), bucket_bytes, 8)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = settled(rows.mapInArrow(_blocks(block_bytes), BLOCK))
    asked = blocks.select("block", "words", "seen").mapInArrow(_ask(buckets), "bucket int, block string, words binary, seen binary")
    answers = settled(asked.groupBy("bucket").applyInPandas(_answer, ANSWER))
    about = answers.where("block is null")
    sums = about.agg(F.sum("distinct"), F.sum("tokens")).first()
    top = about.select(F.explode("top").alias("t")).orderBy(F.desc("t.n"), "t.word").limit(KNOWN - 1).collect()
    tails = np.zeros(TAILS)
    for r in about.select(F.posexplode("tails").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).collect():
        tails[r["k"]] = r["x"]
    vocabulary = Vocabulary([(bytes(r["t"]["word"]), r["t"]["n"]) for r in top], tails, sums[1] or 0, sums[0] or 0)
    model = learned(blocks, vocabulary)
    replies = answers.where("block is not null").select("block", "bucket", "totals")
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(_score(model, vocabulary, buckets), SCORES)
