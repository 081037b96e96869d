"""Run history: active flags, effective dates, latest rows, and comparing copies."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyproof.functions import null_safe, settle, surrogate_key

ACTIVE = "active_flag"
FROM = "effective_from"
TO = "effective_to"
BATCH = "batch_id"


def supersede(
    stored: DataFrame, incoming: DataFrame, keys: Sequence[str], inactive: str = "N"
) -> DataFrame:
    """Stored rows and incoming rows together, after a rerun of ``keys``.

    Incoming rows are always active. Every stored row whose key is among the incoming ones becomes
    ``inactive``; other stored rows keep their flag. Adaptive execution broadcasts the distinct incoming keys if
    they turn out few. To rewrite only the partitions concerned, pass ``stored`` through
    :func:`tallyproof.operators.incremental.rescan` with the partition column first.
    """
    rerun = incoming.select(*keys).distinct().withColumn("_rerun", F.lit(True))
    old = stored.alias("s").join(rerun.alias("r"), null_safe("s", "r", keys), "left")
    flag = F.when(F.col("r._rerun"), F.lit(inactive)).otherwise(F.col(f"s.{ACTIVE}"))
    kept = old.select(*[(flag if c == ACTIVE else F.col(f"s.{c}")).alias(c) for c in stored.columns])
    return kept.unionByName(incoming.withColumn(ACTIVE, F.lit("Y")))


def scd2_close(
    stored: DataFrame, incoming: DataFrame, keys: Sequence[str], run_order: Sequence[str]
) -> DataFrame:
    """Merge ``incoming`` into an effective-dated history and close what it replaces.

    A row holds from ``effective_from`` (a DATE) until ``effective_to``, NULL while it is the current
    one. ``run_order`` must tell the runs of a key and day apart; a tie for the last run stops the job. Stored closed rows pass through. Among open and incoming rows of a key, the last run of a
    day (by ``run_order``) is closed by the key's next day, and an earlier run of the same day on
    that day itself. Where a run may fall into time that stored rows have closed already, use :func:`scd2_split`.

    Rows are first reduced to one per key and day with map-side combine, so the window that finds the
    next day sees at most one row per calendar day for any key, however many rows the key has.
    """
    for df in (stored, incoming):
        if not isinstance(df.schema[FROM].dataType, T.DateType):
            raise TypeError(f"{FROM} must be a DATE")
    closed = stored.where(F.col(TO).isNotNull())
    open_rows = stored.where(F.col(TO).isNull()).unionByName(
        incoming.withColumn(TO, F.lit(None).cast("date"))
    )
    day = [*keys, FROM]
    # Among rows that tie for the last run, the largest and the smallest row number differ.
    numbered = open_rows.withColumn("_row", F.monotonically_increasing_id())
    last, least = (F.max(F.struct(*run_order, n.alias("row"))) for n in (F.col("_row"), -F.col("_row")))
    days = numbered.groupBy(*day).agg(last.alias("a"), least.alias("b"))
    following = F.lead(FROM).over(Window.partitionBy(*keys).orderBy(FROM))
    run = F.struct(*[F.col(f"a.{c}").alias(c) for c in run_order])
    ends = days.select(*day, run.alias("_last"), (F.col("a.row") != -F.col("b.row")).alias("_tied"), following.alias("_next"))
    joined = open_rows.alias("r").join(ends.alias("e"), null_safe("r", "e", day))
    is_last = F.struct(*[F.col(f"r.{c}").alias(c) for c in run_order]).eqNullSafe(F.col("e._last"))
    # Two last runs of a day would both stay open.
    single = F.assert_true(~F.col("e._tied"), F.lit("run_order does not tell two runs of a key and day apart"))
    until = F.when(is_last & single.isNull(), F.col("e._next")).otherwise(F.col(f"r.{FROM}"))
    return closed.unionByName(
        joined.select(*[(until if c == TO else F.col(f"r.{c}")).alias(c) for c in stored.columns])
    )


def scd2_split(
    stored: DataFrame, incoming: DataFrame, keys: Sequence[str], run_order: Sequence[str]
) -> DataFrame:
    """Merge runs of any date into an effective-dated history, so that no two rows of a key hold on one day.

    Incoming rows may begin before, inside or after stored ones, and may have an ``effective_to`` of their own (a
    correction for some time) or NULL (until further notice). On every day the row with the latest ``effective_from`` holds,
    of several the last by ``run_order``; a row that another interrupts holds again after it, as a second row with its own dates.
    A row that never holds stays as an empty interval that ends on its first day. Rows of keys without news pass through. ``run_order``
    must tell the rows of a key and first day apart; a tie stops the job. NULL keys are keys; rows without ``effective_from`` never hold and are kept as they are.

    The days on which rows begin or end cut a key's time into segments. An interval is a range of segments and is taken apart into
    the few dyadic ranges that make it up; the best row of each such range, and of all ranges around a segment, are
    plain grouped maxima. So no interval meets another, and a hot key is spread over its ranges; only the numbering of
    segments sees a key at once, one row per calendar day.
    """
    for df in (stored, incoming):
        if not isinstance(df.schema[FROM].dataType, T.DateType):
            raise TypeError(f"{FROM} must be a DATE")
    if TO not in incoming.columns:
        incoming = incoming.withColumn(TO, F.lit(None).cast("date"))
    news = settle(incoming.select(*keys).distinct())
    touched = stored.alias("s").join(news.alias("n"), null_safe("s", "n", keys), "left_semi").select("s.*")
    others = stored.alias("s").join(news.alias("n"), null_safe("s", "n", keys), "left_anti").select("s.*")
    rows = touched.unionByName(incoming)
    undated = rows.where(F.col(FROM).isNull())
    rows = rows.where(F.col(FROM).isNotNull())
    won = _segments_won(rows, keys, run_order)
    # Segments that follow each other and have one winner are one interval.
    by_day = Window.partitionBy(*keys).orderBy("segment")
    goes_on = F.lag("winner").over(by_day).eqNullSafe(F.col("winner")) & F.lag("until").over(by_day).eqNullSafe(F.col("since"))
    new = F.when(goes_on, F.lit(0)).otherwise(F.lit(1))
    runs = won.withColumn("_new", new).withColumn("_run", F.sum("_new").over(by_day.rowsBetween(Window.unboundedPreceding, 0)))
    # An open end is a NULL, which a maximum would pass over.
    until = F.when(F.count("until") == F.count(F.lit(1)), F.max("until"))
    held = runs.groupBy(*keys, "winner", "_run").agg(F.min("since").alias("_since"), until.alias("_until"))
    order = [FROM, *run_order]
    same = null_safe("r", "h", keys) & F.struct(*[F.col(f"r.{c}").alias(c) for c in order]).eqNullSafe(F.col("h.winner"))
    joined = rows.alias("r").join(held.alias("h"), same, "left")
    never = F.col("h._run").isNull()
    dates = {
        FROM: F.when(never, F.col(f"r.{FROM}")).otherwise(F.col("h._since")),
        TO: F.when(never, F.col(f"r.{FROM}")).otherwise(F.col("h._until")),
    }
    split = joined.select(*[dates.get(c, F.col(f"r.{c}")).alias(c) for c in stored.columns])
    return others.unionByName(undated).unionByName(split)


def _segments_won(rows: DataFrame, keys: Sequence[str], run_order: Sequence[str]) -> DataFrame:
    """(keys, segment, since, until, winner): for each segment of a key's time the row that holds, if any.

    The winner is a struct of ``effective_from`` and ``run_order``. Stops at two rows that these do not tell apart.
    """
    order = [FROM, *run_order]
    # Rows that tie would hold together: one row for each key and run finds them. Then the last run of each interval is enough.
    counted = rows.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("_n"), F.max(TO).alias("_to"), F.max(F.col(TO).isNull()).alias("_open"))
    single = F.assert_true(F.col("_n") == 1, F.lit("run_order does not tell two runs of a key and day apart"))
    until = F.when(single.isNull() & ~F.col("_open"), F.col("_to")).alias(TO)
    holding = counted.select(*keys, *order, until).where(F.col(TO).isNull() | (F.col(TO) > F.col(FROM)))
    lasts = holding.groupBy(*keys, FROM, TO).agg(F.max(F.struct(*run_order)).alias("_last"))
    runs = settle(lasts.select(*keys, FROM, TO, *[F.col(f"_last.{c}").alias(c) for c in run_order]))
    days = runs.select(*keys, F.col(FROM).alias("since")).unionByName(runs.where(F.col(TO).isNotNull()).select(*keys, F.col(TO).alias("since"))).distinct()
    of_key = Window.partitionBy(*keys).orderBy("since")
    segments = settle(days.select(*keys, "since", F.lead("since").over(of_key).alias("until"), (F.row_number().over(of_key) - 1).alias("segment")))
    first = segments.select(*keys, F.col("since").alias(FROM), F.col("segment").alias("i"))
    last = segments.select(*keys, F.col("since").alias(TO), F.col("segment").alias("j"))
    sizes = segments.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("j"))
    begun = runs.alias("r").join(first.alias("f"), null_safe("r", "f", [*keys, FROM])).select("r.*", "f.i")
    closed = begun.where(F.col(TO).isNotNull()).alias("r").join(last.alias("l"), null_safe("r", "l", [*keys, TO])).select("r.*", "l.j")
    open_ = begun.where(F.col(TO).isNull()).alias("r").join(sizes.alias("l"), null_safe("r", "l", keys)).select("r.*", "l.j")
    ranges = closed.unionByName(open_).select(*keys, F.struct(*order).alias("winner"), "i", "j")
    # At each level, ranges of 2^level segments lie on a grid; the interval takes at most two of a level.
    levels = ranges.withColumn("level", F.explode(F.expr("sequence(0, cast(floor(log2(j - i)) as int))")))
    ends = levels.withColumn("a", F.expr("(i + shiftleft(1, level) - 1) div shiftleft(1, level)")).withColumn("b", F.expr("j div shiftleft(1, level)"))
    taken = F.expr("filter(array(if(a < b and a % 2 = 1, a, null), if(a < b and b % 2 = 1, b - 1, null)), x -> x is not null)")
    best = ends.select(*keys, "level", "winner", F.explode(taken).alias("node")).groupBy(*keys, "level", "node").agg(F.max("winner").alias("winner"))
    deep = segments.alias("s").join(sizes.alias("z"), null_safe("s", "z", keys)).select("s.*", "z.j")
    around = deep.withColumn("level", F.explode(F.expr("sequence(0, cast(floor(log2(j)) as int))"))).withColumn("node", F.expr("segment div shiftleft(1, level)"))
    met = around.alias("a").join(best.alias("b"), null_safe("a", "b", [*keys, "level", "node"]))
    # An open last segment has no day on which it ends.
    return met.groupBy(*[F.col(f"a.{c}").alias(c) for c in (*keys, "segment", "since", "until")]).agg(F.max("b.winner").alias("winner"))


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The one newest row of each key.

    Spark turns this shape into a limit of one row per key that also runs before the shuffle, so a
    hot key costs each task one row.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_active(
    df: DataFrame, keys: Sequence[str], run_order: Sequence[str], as_of: Column | None = None
) -> DataFrame:
    """The row of each key that is in force, by the latest run where several share a start date.

    Without ``as_of`` that is the open row; with it, the row whose dates cover the day. One row per
    key whatever the history holds, so a reload brings no old rows back.
    """
    if as_of is None:
        in_force = F.col(TO).isNull()
    else:
        in_force = (F.col(FROM) <= as_of) & (F.col(TO).isNull() | (F.col(TO) > as_of))
    return latest_per_key(df.where(in_force), keys, [F.desc(c) for c in (FROM, *run_order)])


def latest_run(
    df: DataFrame, keys: Sequence[str], run_time: str = "run_time", tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """The latest result row of each key in an appended history.

    ``tie_breakers`` must make the order total, or equal run times would pick a row at random.
    """
    if not tie_breakers:
        raise ValueError("name tie_breakers: of equal run times any row could be picked")
    return latest_per_key(df, keys, [F.desc(c) for c in (run_time, *tie_breakers)])


def latest_execution(df: DataFrame, by: Sequence[str], run_time: str = "run_time") -> DataFrame:
    """All rows written by the latest run of each ``by`` (a business date, say).

    Unlike :func:`latest_run`, a grain that the latest run no longer produced is left out.
    """
    newest = df.groupBy(*by).agg(F.max(run_time).alias(run_time))
    return df.alias("d").join(newest.alias("n"), null_safe("d", "n", [*by, run_time]), "left_semi")


def split_actual_amend(
    df: DataFrame, keys: Sequence[str], div_flag: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(actual, amend): the active rows, and every other row as history.

    Both carry ``div_flag`` and a ``uuid`` derived from ``keys``, so a row keeps its identity when it
    moves from one table to the other.
    """
    stamped = df.withColumn("div_flag", F.lit("N") if div_flag is None else div_flag).withColumn(
        "uuid", surrogate_key(keys)
    )
    active = F.col(ACTIVE).eqNullSafe(F.lit("Y"))
    return stamped.where(active), stamped.where(~active)


def replace_batches(stored: DataFrame, rows: DataFrame, batch: str = BATCH) -> DataFrame:
    """The table after a load that may be a repeated one: stored rows of other batches, and ``rows`` as active ones.

    A batch that is loaded again takes the place of what it loaded before; other batches of the day stay, and so do rows
    that belong to no batch. The distinct batches of ``rows`` are few, so adaptive execution broadcasts them.
    """
    again = rows.select(batch).where(F.col(batch).isNotNull()).distinct()
    return bau_union(stored.join(again, batch, "left_anti").select(*stored.columns), rows)


def bau_union(existing: DataFrame, day: DataFrame) -> DataFrame:
    """The table after a daily load: what it held, and the day's rows as active ones."""
    return existing.unionByName(day.withColumn(ACTIVE, F.lit("Y")))


#: Buckets into which the rows of two copies are dealt to find where they differ.
BUCKETS = 4096


def compare_copies(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that do not occur equally often in both tables, with both counts; empty means identical.

    NULL equals NULL. Rows are dealt into buckets by a hash of all columns, and first only the digests of the buckets are compared,
    now: one row for each bucket and task is shuffled, whatever the size of the tables. Rows of buckets that differ then go
    through one aggregation over all columns, combined on the map side, so many copies of one row collapse before the
    shuffle and no join is needed. Two tables that differ can pass as equal only if two sums of 64-bit hashes agree in every bucket.
    """
    if set(a.columns) != set(b.columns):
        raise ValueError("the copies differ in their columns")
    cols = a.columns
    differing = _differing_buckets(a, b.select(*cols))
    if len(differing) < BUCKETS:
        # No list at all would be no filter.
        mine = _bucket(cols).isin(differing) if differing else F.lit(False)
        a, b = a.where(mine), b.where(mine)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = a.select(*cols, one.alias("n_a"), none.alias("n_b")).unionByName(
        b.select(*cols, none.alias("n_a"), one.alias("n_b"))
    )
    counted = both.groupBy(*cols).agg(F.sum("n_a").alias("count_a"), F.sum("n_b").alias("count_b"))
    return counted.where(F.col("count_a") != F.col("count_b"))


def _row_hash(columns: Sequence[str], *seed: Column) -> Column:
    """A hash of a row in which a NULL differs from any value and from its place."""
    parts: list[Column] = []
    for c in sorted(columns):
        parts += [F.col(f"`{c}`"), F.col(f"`{c}`").isNull()]
    return F.xxhash64(*seed, *parts)


def _bucket(columns: Sequence[str]) -> Column:
    return F.pmod(_row_hash(columns), F.lit(BUCKETS)).cast("int")


def _differing_buckets(a: DataFrame, b: DataFrame) -> list[int]:
    """Buckets in which counts or digests of the two tables differ; at most BUCKETS numbers come to the driver."""
    other = _row_hash(a.columns, F.lit("second")).cast("decimal(38,0)")
    own = _row_hash(a.columns).cast("decimal(38,0)")
    # A row of b takes away what an equal row of a has added.
    sides = [df.select(_bucket(a.columns).alias("bucket"), F.lit(sign).alias("n"), (own * sign).alias("x"), (other * sign).alias("y")) for df, sign in ((a, 1), (b, -1))]
    sums = sides[0].unionByName(sides[1]).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y")])
    return sorted(r["bucket"] for r in sums.where("n <> 0 or x <> 0 or y <> 0").select("bucket").collect())


def _digests(columns: Sequence[str]) -> list[Column]:
    """Aggregates that tell two tables apart whatever their row order: count and sum of row hashes."""
    digest = _row_hash(columns).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("n_rows"), F.sum(digest).cast("string").alias("digest")]


def fingerprint(df: DataFrame) -> DataFrame:
    """One row that tells two tables apart whatever their row order: count and sum of row hashes.

    Cheap enough to run on every rewrite; :func:`compare_copies` is the exact comparison.
    """
    return df.agg(*_digests(df.columns))


def _total(prints: Iterable[dict]) -> tuple[int, int]:
    """Count and digest of several frames together."""
    prints = list(prints)
    return sum(p["n_rows"] for p in prints), sum(int(p["digest"] or 0) for p in prints)


class Watched:
    """A frame whose fingerprint is taken by the job that writes it, without another scan. ``frame`` is to be written once."""

    def __init__(self, df: DataFrame):
        self.original, self.seen = df, Observation()
        self.frame = df.observe(self.seen, *_digests(df.columns))

    def agrees(self, written: DataFrame) -> bool:
        """Whether ``written`` holds the rows that went by."""
        return written_whole([self], written)


def written_whole(watched: Sequence[Watched], written: DataFrame) -> bool:
    """Whether ``written`` holds the rows of all frames together.

    Tasks that run again after a shuffle was lost may count rows twice. So a difference is no proof yet, and the
    originals are read before the answer is no.
    """
    found = _total([fingerprint(written.select(*watched[0].original.columns)).first().asDict()])
    return found == _total(w.seen.get for w in watched) or found == _total(fingerprint(w.original).first().asDict() for w in watched)
