"""Column expressions shared by the operators. All of them stay inside Spark's own functions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Types whose text form always has at least one visible character, so "blank" can only mean NULL.
_NEVER_BLANK = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def is_blank(df: DataFrame, name: str) -> Column:
    """True where ``name`` is NULL or holds only spaces; never NULL itself.

    Only the space character counts: a tab is a value. Numeric, date and boolean columns skip the
    cast to text, because a non-NULL value of theirs is never blank.
    """
    # As text: one call to the JVM instead of one per step of the expression.
    dtype = df.schema[name].dataType
    if isinstance(dtype, _NEVER_BLANK):
        return F.expr(f"`{name}` IS NULL")
    text = f"`{name}`" if isinstance(dtype, T.StringType) else f"CAST(`{name}` AS STRING)"
    return F.expr(f"`{name}` IS NULL OR TRIM({text}) = ''")


def any_null(names: Sequence[str]) -> Column:
    """True where at least one of the columns is NULL (blank text counts as present)."""
    return F.expr(" OR ".join(f"`{n}` IS NULL" for n in names))


def null_safe(left: str, right: str, keys: Sequence[str]) -> Column:
    """Join condition on ``keys`` between two aliased frames in which NULL matches NULL."""
    return reduce(and_, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def traffic_light(count: Column) -> Column:
    """Green for a counter of zero, Red otherwise."""
    return F.when(count == 0, F.lit("Green")).otherwise(F.lit("Red"))


def joined_stamp(date_col: str, time_col: str) -> Column:
    """``date`` and ``time`` as one comparable text; NULL if either part is NULL."""
    return F.concat(F.col(date_col).cast("string"), F.lit(" "), F.col(time_col).cast("string"))


def zero_pad(col: Column, width: int) -> Column:
    """Whole number as text with leading zeros. Longer values keep all their digits."""
    text = col.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def surrogate_key(names: Sequence[str]) -> Column:
    """SHA-256 over the named columns, the same on every run and on every executor.

    Each part is written as ``length:value`` and a NULL as ``-``, so neither a delimiter inside a
    value nor a NULL next to an empty text can make two different keys look the same.
    """
    parts = []
    for name in names:
        text = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat_ws("|", *parts), 256)
