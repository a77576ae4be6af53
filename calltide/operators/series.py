"""Daily multi-series counts and their features.

A series is one value of the key columns; a table holds at most one row per
series and day, so a window over one series is bounded by the calendar, not by
the number of requests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from calltide.functions.times import day_number

# The dimensions of the daily table.
DAILY_KEYS = ("complaint_type", "borough", "agency")


def daily_counts(df: DataFrame, ts: str = "created_ts_utc", keys: Sequence[str] = DAILY_KEYS) -> DataFrame:
    """Requests per day and series; NULL key values form their own series."""
    return df.groupBy(F.to_date(ts).alias("ds"), *keys).agg(F.count(F.lit(1)).alias("y"))


def series_total(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sum of y per day, over all series or per subset of the keys."""
    return daily.groupBy(*keys, "ds").agg(F.sum("y").alias("y"))


def _by_day(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("ds")


def add_lag(daily: DataFrame, keys: Sequence[str] = DAILY_KEYS, rows: int = 7) -> DataFrame:
    """y of ``rows`` rows earlier in the series (rows, not days)."""
    return daily.withColumn(f"y_lag{rows}", F.lag("y", rows).over(_by_day(keys)))


def add_moving_avg(daily: DataFrame, keys: Sequence[str] = DAILY_KEYS, rows: int = 7) -> DataFrame:
    """Mean of the current and the preceding rows, ``rows`` in all."""
    return daily.withColumn(f"y_ma{rows}", F.avg("y").over(_by_day(keys).rowsBetween(1 - rows, 0)))


def add_calendar_features(daily: DataFrame, keys: Sequence[str] = DAILY_KEYS, days: int = 7) -> DataFrame:
    """Lag and mean over true calendar days; a missing day gives NULL / is left out.

    Both are RANGE frames over the day number, so the sparse series needs
    neither filling nor a self-join.
    """
    by_day = Window.partitionBy(*keys).orderBy(day_number("ds"))
    return daily.withColumns(
        {
            f"y_day_lag{days}": F.max("y").over(by_day.rangeBetween(-days, -days)),
            f"y_day_ma{days}": F.avg("y").over(by_day.rangeBetween(1 - days, 0)),
        }
    )


def explode_days(df: DataFrame, first: Column, last: Column, out: str = "ds") -> DataFrame:
    """A row for every day from ``first`` to ``last``, opened by month and then by day.

    A span of thousands of years, which one wrong date can cause, so never
    becomes one array.
    """
    month = F.explode(F.sequence(F.trunc("__first", "month"), F.trunc("__last", "month"), F.expr("interval 1 month")))
    day = F.explode(F.sequence(F.greatest("__first", "__month"), F.least("__last", F.last_day("__month"))))
    spans = df.withColumns({"__first": first, "__last": last}).filter("__first <= __last")
    return spans.withColumn("__month", month).withColumn(out, day).drop("__first", "__last", "__month")


def days_ahead(last: str, horizon: int) -> Column:
    """The ``horizon`` days after ``last`` as an array."""
    return F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda i: F.date_add(last, i)) if horizon > 0 else F.array().cast("array<date>")


def date_spine(daily: DataFrame, keys: Sequence[str] = (), horizon: int = 14, fill_gaps: bool = False) -> DataFrame:
    """The observed days of each series and ``horizon`` days past its last; with ``fill_gaps`` every day in between too."""
    if fill_gaps:
        span = daily.groupBy(*keys).agg(F.min("ds").alias("__from"), F.max("ds").alias("__to"))
        return explode_days(span, F.col("__from"), F.date_add("__to", horizon)).select(*keys, "ds")
    span = daily.groupBy(*keys).agg(F.collect_set("ds").alias("__days"), F.max("ds").alias("__to"))
    return span.select(*keys, F.explode(F.concat("__days", days_ahead("__to", horizon))).alias("ds"))


def last_n(df: DataFrame, keys: Sequence[str], n: int, order_by: str = "ds") -> DataFrame:
    """The last ``n`` rows of each series; the cut is made before the shuffle too."""
    newest = Window.partitionBy(*keys).orderBy(F.desc(order_by))
    return df.withColumn("__rank", F.row_number().over(newest)).filter(F.col("__rank") <= n).drop("__rank")


def gold_features(silver: DataFrame, ts: str = "created_ts_utc", keys: Sequence[str] = DAILY_KEYS) -> DataFrame:
    """The daily table: counts, 7-row lag, 7-row mean."""
    return add_moving_avg(add_lag(daily_counts(silver, ts, keys), keys), keys)
