"""Collocations by set-oriented mining of occurrence relations.

The relation of length k holds, sorted, every place at which a frequent phrase of k words starts. It is kept in blocks of
documents. To extend it, a block merge-joins it with its own words by piece and adjacent position, counts the extended
phrases, and asks for their counts in the whole corpus; equal phrases of all blocks meet in one part, are summed there,
and the frequent ones get numbers that go back to the blocks. So a block sends each of its phrases once, however often it
occurs there, packed by part, and only occurrences of frequent phrases are extended: a phrase cannot be more frequent than its parts.

Places count words and leave a gap after each piece, so one number stands for piece and position, and two words
are neighbours in a piece exactly where their places are.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyproof.llm.common import block_numbers, by_bytes, let_go, pack, pieces, settled, tidied, unpack
from tallyproof.llm.superkmers import MULTIPLIERS, mixed

#: Lower-cases A-Z, turns a tab into a space, and what ends a piece into a byte that no UTF-8 text holds.
GAP = b"\xff"
READ = bytes.maketrans(bytes(range(ord("A"), ord("Z") + 1)) + b"\t.,;:!?\n\x0b\x0c\r", bytes(range(ord("a"), ord("z") + 1)) + b" " + GAP * 10)

#: Places of words and their codes in ``words``; langs, one after another with their numbers of words.
READ_BLOCK = "block long, places binary, codes binary, langs array<string>, sizes array<int>, words binary, counts binary"
#: Places of phrases and their codes; the ``size`` phrases are ``heads`` (of one word less) and ``tails``, sorted; places of frequent words and their codes in ``word_ids``.
BLOCK = "block long, size int, places binary, codes binary, heads binary, tails binary, word_places binary, word_codes binary, word_ids binary"
#: The phrases of a block that meet others in a part, with their codes and how often they occur in the block.
ASKED = "part int, block long, codes binary, heads binary, tails binary, counts binary"
#: For a block, the codes and ids of its frequent phrases; without a block, the frequent phrases of a part.
ANSWERS = "block long, codes binary, ids binary, heads binary, tails binary, f binary"
#: Products and sums may pass 64 bits; div on decimals is exact.
SCORE = "cast(cast(2000000 as decimal(7, 0)) * cast(a as decimal(20, 0)) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0))) as long)"
MEETING = 1 << 20  # phrases of blocks that meet in one part, about
PARTS = 64  # into which the phrases of a lang are dealt before they are ranked
SHIFT = 28  # where a block has a phrase: the number of the block, and below it the code that the phrase has there


class _Words:
    """Words of some texts by lang, as codes in order of first occurrence."""

    def __init__(self):
        self.next = count(1)
        self.by_lang: dict[str, defaultdict[bytes, int]] = {}
        self.codes: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, texts: list[str]) -> None:
        number = self.by_lang.get(lang)
        if number is None:
            number = self.by_lang[lang] = defaultdict(self.next.__next__)
            number[GAP] = 0
        data = GAP.join([t.encode() for t in texts]).translate(READ)
        found = data.replace(GAP, b" \xff ").split()
        found.append(GAP)
        self.codes.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
        self.size += len(data)

    def row(self, name: int) -> pa.RecordBatch:
        codes = np.concatenate(self.codes)
        places = np.flatnonzero(codes).astype(np.int32)
        codes = codes[places] - 1
        langs = {lang: sorted((c, w) for w, c in number.items() if c) for lang, number in self.by_lang.items()}
        # Codes lang by lang, so that a lang's words follow each other.
        order = np.array([c - 1 for found in langs.values() for c, _ in found], np.int64)
        renamed = np.empty(len(order), np.int32)
        renamed[order] = np.arange(len(order), dtype=np.int32)
        codes = renamed[codes]
        words = b" ".join([w for found in langs.values() for _, w in found])
        values = {
            "block": pa.array([name]),
            "places": pa.array([pack(np.diff(places, prepend=np.int32(0)))]),
            "codes": pa.array([pack(codes)]),
            "langs": pa.array([list(langs)], pa.list_(pa.string())),
            "sizes": pa.array([[len(found) for found in langs.values()]], pa.list_(pa.int32())),
            "words": pa.array([pack(np.frombuffer(words, np.uint8))]),
            "counts": pa.array([pack(np.bincount(codes, minlength=len(order)).astype(np.int32))]),
        }
        return pa.RecordBatch.from_arrays(list(values.values()), list(values))


def _read(block_bytes: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, block = block_numbers(), _Words()
        for batch in by_bytes(batches, "text"):
            by_lang = defaultdict(list)
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                by_lang[lang].append(text)
            for lang, texts in by_lang.items():
                block.add(lang, texts)
            if block.size >= block_bytes:
                yield block.row(next(names))
                block = _Words()
        if block.size:
            yield block.row(next(names))

    return read


def _sliced(columns: dict[str, np.ndarray | pa.Array], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    size = len(next(iter(columns.values())))
    for i in range(0, size, rows):
        yield pa.RecordBatch.from_arrays([c.slice(i, rows) if isinstance(c, pa.Array) else pa.array(c[i : i + rows]) for c in columns.values()], list(columns))


def _at(block: int, n: int) -> np.ndarray:
    return (block << SHIFT) + np.arange(n)


def _ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(at, lang, word, n): each word of a block and how often it occurs there."""
    for batch in batches:
        for row in batch.to_pylist():
            counts = unpack(row["counts"], np.int32)
            words = pa.array(unpack(row["words"], np.uint8).tobytes().split(b" ") if len(counts) else [], pa.binary())
            langs = pa.array(row["langs"], pa.string()).take(pa.array(np.repeat(np.arange(len(row["sizes"])), row["sizes"])))
            yield from _sliced({"at": _at(row["block"], len(counts)), "lang": langs, "word": words.cast(pa.string()), "n": counts})


def _steps(x: np.ndarray) -> bytes:
    """Numbers in ascending order, packed; ``_summed`` undoes it."""
    return pack(np.diff(x, prepend=x.dtype.type(0)))


def _summed(data: bytes, kind: type) -> np.ndarray:
    return np.cumsum(unpack(data, kind), dtype=kind)


def _ask_phrases(parts: int):
    """ASKED: a row for each part in which a block has phrases."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                heads, tails = _summed(row["heads"], np.int64), unpack(row["tails"], np.int64)
                counts = np.bincount(unpack(row["codes"], np.int32), minlength=len(heads)).astype(np.int32)
                of = (mixed(heads.astype(np.uint64) * MULTIPLIERS[0] + tails.astype(np.uint64) * MULTIPLIERS[1]) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(of, kind="stable").astype(np.int32)
                ends = np.cumsum(np.bincount(of, minlength=parts)).tolist()
                own = [(k, order[i:j]) for k, (i, j) in enumerate(zip([0, *ends], ends, strict=False)) if i < j]
                columns = {
                    "part": pa.array([k for k, _ in own], pa.int32()),
                    "block": pa.array([row["block"]] * len(own), pa.int64()),
                    "codes": pa.array([_steps(at) for _, at in own], pa.binary()),
                    "heads": pa.array([_steps(heads[at]) for _, at in own], pa.binary()),
                    "tails": pa.array([pack(tails[at]) for _, at in own], pa.binary()),
                    "counts": pa.array([pack(counts[at]) for _, at in own], pa.binary()),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return ask


def _by_phrase(heads: np.ndarray, tails: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of phrases, and where in it each different one begins."""
    if max(heads.max(), tails.max()) < 1 << 31:
        order = np.argsort(heads << 32 | tails, kind="stable")
    else:
        order = np.lexsort((tails, heads))
    heads, tails = heads[order], tails[order]
    return order, np.flatnonzero(np.concatenate([[True], (heads[1:] != heads[:-1]) | (tails[1:] != tails[:-1])]))


def _meet(parts: int, least: int, reply: bool):
    """ANSWERS to the rows of a part: phrases that occur ``least`` times in all blocks together get an id that no other part gives."""

    def meet(asked: pa.Table) -> pa.Table:
        part, blocks = asked.column("part")[0].as_py(), asked.column("block").to_pylist()
        codes, heads, tails, counts = (
            [f(x.as_py(), t) for x in asked.column(n)] for n, f, t in (("codes", _summed, np.int32), ("heads", _summed, np.int64), ("tails", unpack, np.int64), ("counts", unpack, np.int32))
        )
        heads, tails = np.concatenate(heads), np.concatenate(tails)
        order, new = _by_phrase(heads, tails)
        f = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), new)
        frequent = f >= least
        ids = np.where(frequent, (np.cumsum(frequent) - 1) * parts + part, -1)
        own = np.empty(len(order), np.int64)
        own[order] = np.repeat(ids, np.diff(np.append(new, len(order))))
        first = order[new][frequent]
        rows = [{"block": None, "ids": _steps(ids[frequent]), "heads": _steps(heads[first]), "tails": pack(tails[first]), "f": pack(f[frequent])}]
        at = 0
        for block, code in zip(blocks, codes if reply else [], strict=reply):
            mine = own[at : at + len(code)]
            at += len(code)
            known = mine >= 0
            if known.any():
                rows.append({"block": block, "codes": _steps(code[known]), "ids": _steps(mine[known])})
        kinds = {"block": pa.int64()} | dict.fromkeys(("codes", "ids", "heads", "tails", "f"), pa.binary())
        return pa.table({n: pa.array([r.get(n) for r in rows], t) for n, t in kinds.items()})

    return meet


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, f, head, tail): the frequent phrases of parts."""
    for batch in batches:
        for row in batch.to_pylist():
            yield from _sliced({"id": _summed(row["ids"], np.int64), "f": unpack(row["f"], np.int64), "head": _summed(row["heads"], np.int64), "tail": unpack(row["tails"], np.int64)})


def _extend(length: int):
    """The relation of ``length`` words of a block from that of one word less and the ids of its frequent phrases."""

    def extend(block: pa.Table, frequent: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        places, codes = np.cumsum(unpack(row["places"], np.int32), dtype=np.int32), unpack(row["codes"], np.int32)
        ids = np.full(int(codes.max(initial=-1)) + 1, -1, np.int64)
        if length == 2:
            ids[frequent.column("code").to_numpy()] = frequent.column("id").to_numpy()
        else:
            for found in frequent.to_pylist():
                ids[_summed(found["codes"], np.int32)] = _summed(found["ids"], np.int64)
        heads = ids[codes]
        places, heads = places[heads >= 0], heads[heads >= 0]
        if length == 2:
            word_places, (word_ids, word_codes) = places, np.unique(heads, return_inverse=True)
        else:
            word_places = np.cumsum(unpack(row["word_places"], np.int32), dtype=np.int32)
            word_codes, word_ids = unpack(row["word_codes"], np.int32), unpack(row["word_ids"], np.int64)
        # Both sides are sorted by place: the word that follows a phrase, if it is in the same piece and frequent.
        at = np.searchsorted(word_places, places + (length - 1))
        at[at == len(word_places)] = 0
        met = word_places[at] == places + (length - 1) if len(word_places) else np.zeros(0, bool)
        places, heads, tail_code = places[met], heads[met], word_codes[at[met]]
        head, head_code = np.unique(heads, return_inverse=True)
        both, codes = np.unique(head_code * np.int64(max(1, len(word_ids))) + tail_code, return_inverse=True)
        values = {
            "places": np.diff(places, prepend=np.int32(0)),
            "codes": codes.astype(np.int32),
            "heads": np.diff(head[both // max(1, len(word_ids))], prepend=np.int64(0)),
            "tails": word_ids[both % max(1, len(word_ids))],
            "word_places": np.diff(word_places, prepend=np.int32(0)),
            "word_codes": word_codes.astype(np.int32),
            "word_ids": word_ids,
        }
        return pa.table({"block": pa.array([row["block"]]), "size": pa.array([len(both)], pa.int32())} | {n: pa.array([pack(x)], pa.binary()) for n, x in values.items()})

    return extend


def _frequent_words(asked: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """((block, code, id) where a block has a word that occurs ``least`` times in all blocks together, (id, f, lang, word) of these words).

    A word has at most one row for each block, so no group is larger than the number of blocks. Ids are small numbers, which
    travel well: the place in a settled frame.
    """
    whole = Window.partitionBy("lang", "word")
    counted = asked.select("at", "lang", "word", F.sum("n").over(whole).alias("f"), F.min("at").over(whole).alias("first"))
    # One row of a word is enough to tell which it is.
    met = settled(counted.where(F.col("f") >= least).select("at", "first", *[F.expr(f"if(at = first, {c}, null)").alias(c) for c in ("f", "lang", "word")]))
    owners = settled(met.where("at = first").select("first", "f", "lang", "word", F.monotonically_increasing_id().alias("row")))
    parts = (owners.agg(F.max(F.shiftright("row", 33))).first()[0] or 0) + 1
    numbered = owners.withColumn("id", F.expr(f"(row & {(1 << 33) - 1}) * {parts} + shiftright(row, 33)"))
    replies = met.select("at", "first").join(numbered.select("first", "id"), "first")
    return replies.select(F.shiftright("at", SHIFT).alias("block"), F.expr(f"cast(at & {(1 << SHIFT) - 1} as int)").alias("code"), "id"), numbered.select("id", "f", "lang", "word")


def frequent_phrases(docs: DataFrame, longest: int = 4, least: int = 30, block_bytes: int = 16 << 20) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, length, f) of all phrases of up to ``longest`` words that occur ``least`` times, (lang, n) of all words of a lang).

    ``docs`` has ``text`` and ``lang``; phrases are joined by a space.
    """
    rows = docs.where("text is not null").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    blocks = settled(rows.mapInArrow(tidied(_read(block_bytes)), READ_BLOCK))
    words = blocks.select("block", "langs", "sizes", "words", "counts").mapInArrow(_ask_words, "at long, lang string, word string, n int")
    totals = settled(words.groupBy("lang").agg(F.sum("n").alias("n")))
    replies, singles = _frequent_words(words, least)
    del words
    let_go(docs.sparkSession)
    singles = singles.withColumnRenamed("word", "phrase")
    found = [singles]
    carried = ["block", "places", "codes"]
    for length in range(2, longest + 1):
        blocks = settled(blocks.select(*carried).groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_extend(length), BLOCK))
        del replies
        let_go(docs.sparkSession)
        carried = ["block", "places", "codes", "word_places", "word_codes", "word_ids"]
        parts = pieces(blocks.agg(F.sum("size")).first()[0] or 0, MEETING)
        asked = blocks.select("block", "codes", "heads", "tails").mapInArrow(tidied(_ask_phrases(parts)), ASKED)
        answers = settled(asked.groupBy("part").applyInArrow(_meet(parts, least, length < longest), ANSWERS))
        replies = answers.where("block is not null").select("block", "codes", "ids")
        phrases = answers.where("block is null").mapInArrow(_phrases, "id long, f long, head long, tail long")
        del asked, answers
        let_go(docs.sparkSession)
        heads = found[-1].select(F.col("id").alias("head"), "lang", F.col("phrase").alias("begin"))
        tails = singles.select(F.col("id").alias("tail"), F.col("phrase").alias("end"))
        named = phrases.join(heads, "head").join(tails, "tail")
        found.append(settled(named.select("id", "lang", F.concat_ws(" ", "begin", "end").alias("phrase"), "f")))
    every = [x.select("lang", "phrase", F.lit(k + 1).alias("length"), "f") for k, x in enumerate(found)]
    out = every[0]
    for x in every[1:]:
        out = out.unionByName(x)
    return out, totals


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, top: int = 2000, block_bytes: int = 16 << 20) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two to ``longest`` words of each lang.

    Texts are cut into pieces at ``.,;:!?`` and line ends, and pieces into words at spaces and tabs, with A-Z in lower case. ``a`` is how often the
    phrase occurs, ``l`` and ``r`` its parts at the cut with the lowest score, floor(2000000 * a / (l + r)); of equal ones the first. ``n`` counts all words of
    the lang. Phrases inside a longer one that occurs at least 0.8 times as often are left out. Ranks go by score and ``a`` descending, then by the phrase's bytes.
    A NULL lang is ``und``; NULL and empty texts have no words; equal rows count each. Other columns are not looked at.
    A text goes through one task, with some fifty bytes of memory for each of its own.
    """
    phrases, totals = frequent_phrases(docs, longest, least, block_bytes)
    f = phrases.select("lang", "phrase", "f")
    longer = phrases.where("length > 1").select("lang", "phrase", "length", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = longer.select("*", F.explode(F.expr("sequence(1, length - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "length", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("first"), F.expr("array_join(slice(w, k + 1, length - k), ' ')").alias("rest"))
    cuts = cuts.join(f.withColumnsRenamed({"phrase": "first", "f": "l"}), ["lang", "first"]).join(f.withColumnsRenamed({"phrase": "rest", "f": "r"}), ["lang", "rest"])
    lowest = cuts.select("lang", "phrase", "length", "a", F.struct(F.expr(SCORE).alias("score"), "k", "l", "r").alias("cut")).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("cut").alias("cut"))
    parts = longer.where("length > 2").select("lang", "a", "w", "length", F.explode(F.expr("sequence(2, length - 1)")).alias("size"))
    parts = parts.select("lang", "a", "w", "size", F.explode(F.expr("sequence(1, length - size + 1)")).alias("at"))
    inside = parts.groupBy("lang", F.expr("array_join(slice(w, at, size), ' ')").alias("phrase")).agg(F.max("a").alias("most"))
    kept = lowest.join(inside, ["lang", "phrase"], "left").where("most is null or 100 * cast(most as decimal(20, 0)) < 80 * cast(a as decimal(20, 0))")
    # A lang may hold most phrases: the best of each of its parts first, so that no task ranks all of them.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    scored = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.expr(f"pmod(xxhash64(phrase), {PARTS})").alias("part"))
    some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
