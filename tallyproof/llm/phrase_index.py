"""Benchmark passages in training texts by a distributed positional inverted index.

Every test window is looked up by its rarest word. The index holds postings (word, document, position) of those
words only, each with the words around it, so it stays small beside the corpus. A posting less the word's offset in the window is
where the window would start; the list of the rarest word is intersected with those of the other words of the window
in the posting's surroundings: at their offsets for a phrase, anywhere near for a proximity match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.common import set_aside, settled, within_bound

OTHER = r"[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"  # what stands between words, in either case
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def cased_words_of(text: str) -> Column:
    """Runs of ASCII letters and digits and of all non-ASCII characters, as written; none for NULL."""
    return F.expr(f"array_remove(split(coalesce({text}, ''), '{OTHER}'), '')")


def lowered(word: str) -> str:
    """SQL for a word with A-Z in lower case. Only words with other letters need the slow way, which leaves those alone."""
    return f"CASE WHEN octet_length({word}) = length({word}) THEN lower({word}) ELSE translate({word}, '{UPPER}', '{LOWER}') END"


def words_of(text: str) -> Column:
    """The words of a text with A-Z in lower case."""
    return F.expr(f"array_remove(split(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{OTHER}'), '')")


def test_windows(items: DataFrame, width: int) -> DataFrame:
    """(item_id, q, words): windows of ``width`` words of every item; a shorter item is one window."""
    arrays = items.select("item_id", words_of("text").alias("w")).where("size(w) > 0")
    starts = F.expr(f"explode(sequence(0, greatest(size(w) - {width}, 0)))").alias("q")
    return arrays.select("item_id", "w", starts).selectExpr("item_id", "q", f"slice(w, q + 1, {width}) AS words")


def rarest_words(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """Different ``windows`` with ``word`` and ``offset``: the word of each that is rarest in the corpus (the first such)."""
    placed = windows.select("item_id", "q", "words", F.posexplode("words").alias("offset", "word"))
    wanted = within_bound(settled(placed.select("word").distinct()))
    # Outer: else the reader would also split every text just to see whether it has words.
    said = docs.select(F.explode_outer(cased_words_of("text")).alias("w")).selectExpr(f"{lowered('w')} AS word")
    counts = said.join(wanted, "word", "left_semi").groupBy("word").count()
    found = placed.join(counts, "word", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    # A window with a word that no text has cannot occur.
    first = found.groupBy("item_id", "q", "words").agg(F.min(F.struct("count", "offset", "word")).alias("m")).where("m.count > 0")
    return first.selectExpr("item_id", "q", "words", "m.word AS word", "m.offset AS offset")


def postings(docs: DataFrame, wanted: DataFrame, reach: int) -> DataFrame:
    """(word, doc_id, text_key, p, around, from): each place of a wanted word with up to ``reach`` words to either side."""
    words = docs.select("doc_id", F.xxhash64("text").alias("text_key"), cased_words_of("text").alias("w"))
    places = words.select("doc_id", "text_key", "w", F.posexplode_outer("w").alias("p", "x")).selectExpr("doc_id", "text_key", "w", "p", f"{lowered('x')} AS word")
    begin = f"greatest(p - {reach}, 0)"
    found = places.join(wanted, "word", "left_semi").selectExpr("word", "doc_id", "text_key", "p", f"slice(w, {begin} + 1, {2 * reach + 1}) AS near", f"{begin} AS begin")
    return found.selectExpr("word", "doc_id", "text_key", "p", f"transform(near, x -> {lowered('x')}) AS around", "begin")


def matches(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """(doc_id, text_key, item_id, q, start, n, phrase): windows found in documents.

    ``phrase``: all words stand at ``start`` in order. Otherwise it is a proximity match: all words of the window stand within
    ``width`` - 1 words to either side of its rarest word, in any order.
    """
    windows = settled(rarest_words(test_windows(items, width).distinct(), docs))
    wanted = within_bound(settled(windows.select("word").distinct()))
    index = settled(postings(docs, wanted, width - 1))
    starts = "p - offset >= 0 AND slice(around, p - offset - begin + 1, size(words)) = words"
    found = index.join(windows, "word").withColumn("phrase", F.expr(f"CASE WHEN p - offset >= 0 THEN {starts} ELSE false END"))
    near = found.where("phrase OR size(array_except(words, around)) = 0")
    return near.selectExpr("doc_id", "text_key", "item_id", "q", "p - offset AS start", "size(words) AS n", "phrase")


def contamination(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside an occurring window), ``item_ids`` (those items, in the order of
    their text form), ``n_items`` and ``contaminated``.

    Columns of ``docs`` with these names are replaced. A NULL or empty text has no words; items with a NULL id or
    without words match nothing, and a repeated item_id is one item with several texts. Rows that share a doc_id
    are told apart by their text. A row with a NULL doc_id is matched like any other.
    """
    mine = ("n_words", "n_hit", "item_ids", "n_items", "contaminated")
    own, columns = set_aside(docs, *mine)
    hits = matches(own, items.where("item_id is not null"), width).where("phrase")
    # Spans of one document, merged from left to right: a span adds what lies beyond the furthest end so far.
    covered = """aggregate(array_sort(spans), struct(0 AS upto, 0 AS n),
      (a, s) -> struct(greatest(a.upto, s.start + s.n) AS upto, a.n + greatest(0, s.start + s.n - greatest(a.upto, s.start)) AS n), a -> a.n)"""
    by_doc = hits.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "n")).alias("spans"), F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    by_doc = by_doc.selectExpr("doc_id AS _doc", "text_key AS _key", f"cast({covered} as long) AS _hit", "array_sort(ids) AS _ids")
    base = own.withColumn("text_key", F.xxhash64("text")).withColumn("n_words", F.size(cased_words_of("text")).cast("long"))
    joined = base.join(by_doc, F.expr("doc_id <=> _doc AND text_key = _key"), "left")
    none = F.expr("cast(array() as array<string>)")
    out = joined.withColumns({"n_hit": F.coalesce("_hit", F.lit(0).cast("long")), "item_ids": F.coalesce("_ids", none)})
    out = out.withColumns({"n_items": F.size("item_ids").cast("long"), "contaminated": F.col("n_hit") > 0})
    return out.select(*columns, *mine)
