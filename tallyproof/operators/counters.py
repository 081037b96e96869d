"""Counting: one grouped pass per input, however many checks there are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyproof.functions import null_safe, settle
from tallyproof.operators.checks import GRAIN, Check

ROWS = "n_rows"


def grain_distinct(df: DataFrame, grain: Sequence[str] = GRAIN) -> DataFrame:
    """The grain combinations that occur."""
    return df.select(*grain).distinct()


def counters(
    df: DataFrame,
    checks: Sequence[Check],
    grain: Sequence[str] = GRAIN,
    duplicate_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Row count and one violation counter per check, for every grain combination.

    All row predicates are folded into a single aggregation. It combines on the map side, so a grain
    that holds a third of the table costs each task one row of shuffle. A ``duplicate`` check needs
    ``duplicate_keys`` and adds one further aggregation, see :func:`with_duplicates`.
    """
    plain = [c for c in checks if c.rule != "duplicate"]
    sums = [F.count_if(c.predicate(df)).alias(c.counter) for c in plain]
    counted = df.groupBy(*grain).agg(F.count(F.lit(1)).alias(ROWS), *sums)
    twice = [c for c in checks if c.rule == "duplicate"]
    if twice:
        if not duplicate_keys:
            raise ValueError("a duplicate check needs duplicate_keys")
        counted = with_duplicates(counted, df, duplicate_keys, grain, twice[0].counter)
    return counted.select(*grain, ROWS, *[c.counter for c in checks])


def duplicate_counts(
    df: DataFrame, keys: Sequence[str], grain: Sequence[str] = GRAIN, name: str = "n_duplicate"
) -> DataFrame:
    """Per grain: all rows, and the rows whose ``keys`` occur more than once anywhere in ``df``.

    Every row of a repeated key counts, not one per key. A grain column outside ``keys`` does not
    separate keys: an item booked once in each of two clusters is a duplicate in both.
    """
    return with_duplicates(df.groupBy(*grain).agg(F.count(F.lit(1)).alias(ROWS)), df, keys, grain, name)


def _grain_tag(extra: Sequence[str]) -> Column:
    """64-bit stand-in for the grain columns outside the key. The null flags keep NULL positions apart."""
    parts: list[Column] = []
    for name in extra:
        parts += [F.col(name), F.col(name).isNull()]
    return F.xxhash64(*parts) if parts else F.lit(0).cast("bigint")


def with_duplicates(
    counted: DataFrame, df: DataFrame, keys: Sequence[str], grain: Sequence[str], name: str
) -> DataFrame:
    """Add the number of duplicate rows to the per-grain frame ``counted`` (which has ``n_rows``).

    The textbook form is a count window over ``keys``: it moves and sorts every row, and puts all
    rows of a hot key (a NULL item, say) in one task. Here the keys that occur exactly once are
    counted instead and subtracted, which takes one hash aggregation with map-side combine: a hot
    key shrinks to one row per task before the shuffle.

    A key seen once lies in exactly one grain, whose columns outside the key ride along as a hash
    because a number, unlike text, can be updated in place in a hash aggregation. Two grains whose
    hashes clash would be mixed up, so that (about 1 in 10^19 per pair) raises an error instead.
    """
    shared = [c for c in grain if c in keys]
    extra = [c for c in grain if c not in keys]
    once = (
        df.select(*keys, _grain_tag(extra).alias("_tag"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_tag").alias("_tag"))
        .where(F.col("_n") == 1)
        .groupBy(*shared, "_tag")
        .agg(F.count(F.lit(1)).alias("_once"))
    )
    same_tag = Window.partitionBy(*shared, "_tag")
    tagged = counted.withColumn("_tag", _grain_tag(extra))
    if extra:
        clash = F.assert_true(F.count(F.lit(1)).over(same_tag) == 1, F.lit("two grains share one hash"))
        tagged = tagged.withColumn("_clash", clash).where(F.col("_clash").isNull()).drop("_clash")
    joined = tagged.alias("g").join(once.alias("o"), null_safe("g", "o", [*shared, "_tag"]), "left")
    rest = F.col(f"g.{ROWS}") - F.coalesce(F.col("o._once"), F.lit(0))
    return joined.select(*[F.col(f"g.{c}") for c in counted.columns], rest.alias(name))


def source_counts(
    status: DataFrame,
    by: Sequence[str] = ("dwh_business_date", "cluster_type"),
    done: str = "Completed",
    name: str = "source_count",
) -> DataFrame:
    """Finished source loads per business date and cluster; the status text must match exactly."""
    return status.where(F.col("status") == done).groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def changed_parts(then: DataFrame, now: DataFrame, by: str) -> DataFrame:
    """Values of ``by`` whose rows are not the same in both tables, by counts and sums of row hashes; settled.

    For tables without files of their own; ``sources.recheck`` looks at files and reads nothing.
    """
    parts: list[Column] = []
    for c in sorted(then.columns):
        parts += [F.col(c), F.col(c).isNull()]
    digest = F.xxhash64(*parts).cast("decimal(38,0)")
    sides = [df.select(by, F.lit(sign).alias("n"), (digest * sign).alias("x")) for df, sign in ((then, 1), (now, -1))]
    sums = sides[0].unionByName(sides[1]).groupBy(by).agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    return settle(sums.where("n <> 0 or x <> 0").select(by))
