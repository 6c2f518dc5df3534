"""Column expressions. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from datetime import UTC, datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def quoted(name: str) -> Column:
    """Column by exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def time_literal(value: datetime | str | None, dtype: T.DataType) -> Column:
    """A time as a literal of the column's own type.

    A time without a zone is what the session's clock shows, for columns with
    and without a zone alike; the zone of the driver process has no say.
    """
    if isinstance(value, datetime) and value.tzinfo is not None:
        since = value - datetime(1970, 1, 1, tzinfo=UTC)
        micros = (since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds
        return F.timestamp_micros(F.lit(micros)).cast(dtype)
    return F.lit(None if value is None else str(value)).cast(dtype)


def is_float(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def is_absent(df: DataFrame, name: str) -> Column:
    """NULL, or NaN where the type has one."""
    col = quoted(name)
    if is_float(df.schema[name].dataType):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def all_present(df: DataFrame, names: list[str] | None = None) -> Column:
    return reduce(and_, [~is_absent(df, n) for n in names or df.columns])


def without_nan(col: Column) -> Column:
    """NaN read as NULL, so one bad value does not turn a mean into NaN."""
    return F.nanvl(col.cast("double"), F.lit(None).cast("double"))


def parse_timestamp(text: Column) -> Column:
    """Timestamp of a text, NULL where it does not parse (never an error)."""
    return F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT))


def is_unparsable(text: Column) -> Column:
    return text.isNotNull() & parse_timestamp(text).isNull()


def clock_skew(ts: Column, seconds: Column) -> Column:
    """Epoch seconds of ``ts`` minus the seconds the row itself claims."""
    return F.unix_timestamp(ts) - seconds


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in percent, rounded half up; NULL when ``whole`` is 0."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, digits)
