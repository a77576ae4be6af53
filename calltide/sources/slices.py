"""Time slices of a table. Bounds are literals so they reach the scan."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from calltide.functions.times import ntz


def _at(as_of: str | datetime) -> datetime:
    return datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of


def window_bounds(as_of: str | datetime, sample_days: int, overlap_days: int) -> tuple[datetime, datetime]:
    """[midnight of as_of - (sample + overlap) days, as_of) without fractions of a second."""
    end = _at(as_of).replace(microsecond=0)
    start = datetime.combine((end - timedelta(days=sample_days + overlap_days)).date(), datetime.min.time())
    return start, end


def slice_time(df: DataFrame, ts: str, start: str | datetime | Column, end: str | datetime | Column) -> DataFrame:
    """Rows with start <= ts < end."""
    return df.filter((F.col(ts) >= ntz(start)) & (F.col(ts) < ntz(end)))


def trailing_window(
    df: DataFrame, ts: str, as_of: str | datetime, sample_days: int = 90, overlap_days: int = 1
) -> DataFrame:
    """Rows of the trailing ingest window before ``as_of``."""
    start, end = window_bounds(as_of, sample_days, overlap_days)
    return slice_time(df, ts, start, end)


def load_day(df: DataFrame, ts: str, day: str | date) -> DataFrame:
    """Rows of one calendar day."""
    start = datetime.fromisoformat(str(day))
    return slice_time(df, ts, start, start + timedelta(days=1))


def backfill(df: DataFrame, ts: str, as_of: str | datetime, days: int = 7) -> DataFrame:
    """Rows of the last ``days`` whole days before the day of ``as_of``, in one range scan."""
    end = datetime.combine(_at(as_of).date(), datetime.min.time())
    return slice_time(df, ts, end - timedelta(days=days), end)


def recent_count(df: DataFrame, day_col: str, as_of: str | date, days: int = 7) -> DataFrame:
    """One row: how many rows carry a day in the last ``days`` days up to ``as_of``."""
    end = date.fromisoformat(str(as_of)[:10])
    recent = (F.col(day_col) > F.lit(end - timedelta(days=days))) & (F.col(day_col) <= F.lit(end))
    return df.filter(recent).agg(F.count(F.lit(1)).alias("records"))


def incremental_slice(source: DataFrame, target: DataFrame, mark: str, overlap_days: int = 1) -> DataFrame:
    """Source rows at or after the target's newest ``mark`` less the overlap.

    The newest mark is a scalar subquery: it prunes the scan at run time and
    never visits the driver. An empty target selects the whole source.
    """
    if isinstance(target.schema[mark].dataType, T.DateType):
        low, floor = F.date_sub(F.max(mark), overlap_days), ntz(datetime.min).cast("date")
    else:
        low, floor = F.max(mark) - F.expr(f"interval {int(overlap_days)} days"), ntz(datetime.min)
    newest = target.agg(F.coalesce(low, floor).alias("low")).scalar()
    return source.filter(F.col(mark) >= newest)


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def ingest_summary(df: DataFrame, ts: str) -> DataFrame:
    """One row: record count and covered time range."""
    return df.agg(
        F.count(F.lit(1)).alias("records"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
