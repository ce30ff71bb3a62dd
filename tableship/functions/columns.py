"""Column helpers: quoting, picking columns by type, display text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEMPORAL_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)

FIXED_WIDTH_TYPES = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


def quoted(name: str) -> str:
    """Column name as one identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def unused_name(df: DataFrame, wanted: str) -> str:
    taken = {name.lower() for name in df.columns}
    while wanted in taken:
        wanted += "_"
    return wanted


def temporal_columns(df: DataFrame, limit: int | None = None, by_name: bool = False) -> list[str]:
    """Date and timestamp columns; ``by_name`` picks names holding "date" or "time" instead."""
    if by_name:
        names = [n for n in df.columns if "date" in n.lower() or "time" in n.lower()]
    else:
        names = [f.name for f in df.schema.fields if isinstance(f.dataType, TEMPORAL_TYPES)]
    return names[:limit]


def day_of(df: DataFrame, name: str, tz: str | None = None) -> Column:
    """Calendar day of a temporal column.

    A timestamp with a zone falls on the day of ``tz`` (the session zone by default).
    Dates and zoneless timestamps already are wall-clock values, so ``tz`` is refused.
    """
    if tz is None:
        return F.to_date(col(name))
    if not isinstance(df.schema[name].dataType, T.TimestampType):
        raise ValueError(f"{name} carries no time zone, so tz={tz!r} does not apply")
    wall_clock = col(name).cast("timestamp_ntz")
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit(tz), wall_clock))


def newest_first(order_by: str, tie_break: list[str]) -> list[Column]:
    return [col(order_by).desc_nulls_last(), *(col(c).desc_nulls_last() for c in tie_break)]


