"""Time handling that does not depend on the session time zone.

All UTC times are ``timestamp_ntz`` wall clocks, so the same input gives the
same day on any cluster.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NTZ = "timestamp_ntz"


def ntz(value: str | date | datetime | Column) -> Column:
    """A timestamp_ntz literal (a Column passes through)."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast(NTZ)


def utc_wall(instant: Column) -> Column:
    """UTC wall clock of a zoned timestamp."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), ntz("1970-01-01"))


def to_utc(wall: Column, source_tz: str = "UTC") -> Column:
    """UTC wall clock of a wall clock kept in ``source_tz``; UTC is an identity."""
    if source_tz == "UTC":
        return wall
    return F.convert_timezone(F.lit(source_tz), F.lit("UTC"), wall)


def parse_utc(text: Column, source_tz: str = "UTC") -> Column:
    """Parse ISO text to a UTC wall clock; malformed text gives NULL.

    Text with its own offset is converted by that offset; other text is read
    as a wall clock in ``source_tz``.
    """
    has_offset = text.rlike(r":\d\d.*(Z|[+-]\d\d:?\d\d)$")
    return F.when(has_offset, utc_wall(F.try_to_timestamp(text))).otherwise(
        to_utc(text.try_cast(NTZ), source_tz)
    )


def as_utc(df: DataFrame, name: str, source_tz: str = "UTC") -> Column:
    """UTC wall clock of a column, whatever time type or text it holds."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return utc_wall(F.col(name))
    if isinstance(kind, T.StringType):
        return parse_utc(F.col(name), source_tz)
    return to_utc(F.col(name).cast(NTZ), source_tz)


def day_number(ds: Column | str) -> Column:
    """Days since 1970-01-01, for RANGE frames and trend axes."""
    return F.unix_date(F.col(ds) if isinstance(ds, str) else ds)


def wall_seconds(wall: Column) -> Column:
    """Whole seconds from 1970-01-01 to a wall clock."""
    of_day = F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall)
    return F.unix_date(wall.cast("date")).cast("bigint") * 86400 + of_day


def instant(wall: Column) -> Column:
    """Zoned timestamp of a UTC wall clock (watermarks accept no other type)."""
    date_parts = [F.year(wall), F.month(wall), F.dayofmonth(wall), F.hour(wall), F.minute(wall)]
    return F.make_timestamp_ltz(*date_parts, F.extract(F.lit("SECOND"), wall), F.lit("UTC"))
