"""Loading only what is new: high watermarks, deltas, scan keys and rescans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyproof.functions import joined_stamp, null_safe, settle, settle_small

WATERMARK = "last_loaded"
MAX_ENVIRONMENTS = 1000
MAX_RANGES = 64


def last_load_ts(stored: DataFrame, date_col: str = "run_date", time_col: str = "run_time") -> DataFrame:
    """Latest ``date time`` stamp of the target, one row; rows with a part missing do not count."""
    return stored.agg(F.max(joined_stamp(date_col, time_col)).alias("last_stamp"))


def _cold(cold_start: str) -> bool:
    if cold_start not in ("load_all", "load_none"):
        raise ValueError("cold_start must be 'load_all' or 'load_none'")
    return cold_start == "load_all"


def _portable(col: Column, dtype: T.DataType) -> Column:
    """A value as it survives the way to the driver and back, whatever the time zones of the two."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    return col.cast("string") if isinstance(dtype, T.TimestampNTZType) else col


def _literal(value, dtype: T.DataType) -> Column:
    """A literal of the exact type from a portable value."""
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    return F.lit(value).cast("timestamp_ntz") if isinstance(dtype, T.TimestampNTZType) else F.lit(value)


def _fixed(one: DataFrame) -> Column | None:
    """The one value of a frame, computed now, as a literal of its exact type; None for NULL.

    A filter with a literal reaches the scan, where it prunes partitions and skips row groups; one with a
    subquery prunes no partitions.
    """
    dtype = one.schema[0].dataType
    value = one.select(_portable(F.col(one.columns[0]), dtype)).first()[0]
    return None if value is None else _literal(value, dtype)


def incremental_rows(
    new: DataFrame,
    stored: DataFrame,
    date_col: str = "run_date",
    time_col: str = "run_time",
    cold_start: str = "load_all",
) -> DataFrame:
    """Rows of ``new`` stamped after everything in ``stored``.

    The latest stamp is looked up now. If ``date_col`` is a DATE, the date that the stamp begins with
    bounds it too, so that older partitions and row groups are not read. An empty target gives no
    stamp; ``load_none`` then loads nothing, as plain SQL would.
    """
    load_all = _cold(cold_start)
    last = last_load_ts(stored, date_col, time_col).first()[0]
    if last is None:
        return new if load_all else new.where(F.lit(False))
    later = joined_stamp(date_col, time_col) > last
    # Years beyond 9999 are written with a sign, and sort as text unlike dates.
    if isinstance(new.schema[date_col].dataType, T.DateType) and last[0].isdigit():
        later = (F.col(date_col) >= F.lit(last[:10]).cast("date")) & later
    return new.where(later)


def high_watermark(target: DataFrame, ts_col: str, by: Sequence[str] = ()) -> DataFrame:
    """Latest ``ts_col`` already loaded, per environment (or whatever ``by`` names).

    Read from the target, not from the source: it tells what has really arrived.
    """
    return target.groupBy(*by).agg(F.max(ts_col).alias(WATERMARK))


def delta(
    lookup: DataFrame,
    watermark: DataFrame,
    ts_col: str,
    by: Sequence[str] = (),
    inclusive: bool = False,
    cold_start: str = "load_all",
) -> DataFrame:
    """Rows of ``lookup`` beyond the watermark of their environment.

    The watermark is computed now, once. Environments are few (MAX_ENVIRONMENTS bounds them), so their watermarks
    become literals: the filter reaches the reader, and the lookup is not shuffled. An environment
    without a watermark is new: it is loaded whole, or left out with ``cold_start="load_none"``.
    ``inclusive`` takes rows at the watermark again, which repeats them unless the load replaces slices.
    """
    load_all = _cold(cold_start)
    ts = F.col(ts_col)
    if not by:
        mark = _fixed(watermark.select(WATERMARK))
        if mark is None:
            return lookup if load_all else lookup.where(F.lit(False))
        return lookup.where(ts >= mark if inclusive else ts > mark)
    dtype = watermark.schema[WATERMARK].dataType
    marks = watermark.where(F.col(WATERMARK).isNotNull()).select(*by, _portable(F.col(WATERMARK), dtype).alias("_mark")).limit(MAX_ENVIRONMENTS + 1).collect()
    if len(marks) > MAX_ENVIRONMENTS:
        raise ValueError(f"more than {MAX_ENVIRONMENTS} environments have a watermark")
    later, known = F.lit(False), F.lit(False)
    for row in marks:
        own = reduce(and_, [F.col(c).eqNullSafe(F.lit(row[c])) for c in by])
        mark = _literal(row["_mark"], dtype)
        later = later | (own & (ts >= mark if inclusive else ts > mark))
        known = known | own
    return lookup.where(later | ~known if load_all else later)


def scan_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of the delta, which say what to scan again."""
    return rows.select(*keys).distinct()


def rescan(fact: DataFrame, keys: DataFrame, partition_column: str | None = None) -> DataFrame:
    """Rows of ``fact`` whose key occurs in ``keys``; a NULL key matches NULL.

    The keys are computed once. If ``partition_column`` is among them, their values or ranges of it become a literal
    filter, so that a fact partitioned or sorted by the column is read there only. Within it the join selects.
    Few keys go to every task: dealt by key, all rows of a key would meet in one.
    """
    on = list(keys.columns)
    wanted = settle_small(keys.distinct())
    if partition_column is not None:
        fact = fact.where(within_range(wanted, partition_column))
    return fact.alias("f").join(wanted.alias("k"), null_safe("f", "k", on), "left_semi").select("f.*")


def within_range(keys: DataFrame, column: str, most: int = MAX_RANGES) -> Column:
    """Whether ``column`` lies in one of up to ``most`` ranges that hold all values of settled ``keys``, or is NULL as one of them is.

    Few values are listed one by one. Of more, neighbours are joined to ranges that end at the widest gaps between them, so that
    scattered dates do not open what lies between; values without a distance have one range. Ranges always hold every key, so what
    they let through is only ever too much, and the join after them selects.
    """
    dtype = keys.schema[column].dataType
    absent = F.col(column).isNull() if keys.where(F.col(column).isNull()).limit(1).count() else F.lit(False)
    values = keys.select(F.col(column).alias("v")).where("v is not null").distinct()
    listed = [r[0] for r in values.select(_portable(F.col("v"), dtype)).limit(most + 1).collect()]
    if not listed:
        return absent
    if len(listed) <= most:
        return reduce(or_, [F.col(column) == _literal(v, dtype) for v in sorted(listed)], absent)
    low, high = (_fixed(values.agg(f("v").alias("v"))) for f in (F.min, F.max))
    distance = _distance(dtype)
    if distance is None:
        return F.col(column).between(low, high) | absent
    # One row for each partition of the fact at most: few enough for one ordered pass.
    gaps = values.select("v", F.lag("v").over(Window.orderBy("v")).alias("before")).where("before is not null")
    widest = gaps.orderBy(distance.desc(), "v").limit(most - 1).select(_portable(F.col("before"), dtype).alias("a"), _portable(F.col("v"), dtype).alias("b")).collect()
    edges = [low, *(x for r in sorted(widest, key=lambda r: r["b"]) for x in (_literal(r["a"], dtype), _literal(r["b"], dtype))), high]
    return reduce(or_, [F.col(column).between(i, j) for i, j in zip(edges[::2], edges[1::2], strict=True)], absent)


def _distance(dtype: T.DataType) -> Column | None:
    """How far ``v`` is from ``before``, for types that have distances."""
    if isinstance(dtype, T.DateType):
        return F.date_diff("v", "before")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros("v") - F.unix_micros("before")
    return F.col("v") - F.col("before") if isinstance(dtype, T.NumericType) else None


def replaced(stored: DataFrame, rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``stored`` with the slices that ``keys`` name replaced by ``rows``; NULL keys match NULL."""
    on = list(keys.columns)
    kept = stored.alias("s").join(keys.distinct().alias("k"), null_safe("s", "k", on), "left_anti").select("s.*")
    return kept.unionByName(rows)


def cycle(
    lookup: DataFrame,
    fact: DataFrame,
    target: DataFrame,
    created_ts: str,
    environment: str = "environment",
    keys: Sequence[str] = ("dwh_business_date", "row_type"),
) -> tuple[DataFrame, DataFrame]:
    """One cycle of the incremental load: (rows of the touched slices as the fact has them now, keys of the slices).

    Each environment has its own watermark in the target. Slices are per environment, so the news of one does not
    touch what another has loaded; and they are scanned whole, so they replace what the target has of them.
    """
    marks = high_watermark(target, created_ts, [environment])
    fresh = delta(lookup, marks, created_ts, [environment])
    touched = settle(scan_keys(fresh, [environment, *keys]))
    return rescan(fact, touched, partition_column=keys[0]), touched
