"""Time functions: wall clock, UTC instants and the local business day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the shop's source files carry this zone's wall clock, and its calendar date is the
# business day.
LOCAL_ZONE = "America/Sao_Paulo"


def parse_ts(df: DataFrame, col: str) -> DataFrame:
    """Text to timestamp; the text stays in `<col>_raw`, unparsable text becomes NULL."""
    return df.withColumns({f"{col}_raw": F.col(col), col: F.try_to_timestamp(F.col(col))})


def utc(col: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """The UTC instant of a wall-clock timestamp in `zone`."""
    return F.to_utc_timestamp(col, zone)


def to_utc(df: DataFrame, col: str, src_tz: str = LOCAL_ZONE) -> DataFrame:
    return df.withColumn(col, utc(col, src_tz))


def local_date(col: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """Business day of a UTC instant: its calendar date in the shop's zone."""
    return F.to_date(F.from_utc_timestamp(col, zone))


def iso_weekday(day: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(day) + 1


def date_key(day: Column) -> Column:
    """The date as the integer YYYYMMDD."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def in_days(ts: Column | str, first: str, last: str) -> Column:
    """Half-open test `first 00:00 <= ts < last + 1 day`, so the filter reaches the scan."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return (ts >= F.lit(first).cast("date")) & (ts < F.date_add(F.lit(last).cast("date"), 1))
