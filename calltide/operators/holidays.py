"""Holiday calendar tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltide.functions.holidays import holiday_dates


def us_holidays(days: DataFrame, ds: str = "ds") -> DataFrame:
    """(ds, holiday) for all years covered by the column ``ds`` of ``days``.

    A fixed date on a weekend also yields its "(observed)" day. Sixteen rows
    a year at most, spread from the one-row min/max of the days.
    """
    span = days.agg(F.year(F.min(ds)).alias("lo"), F.year(F.max(ds)).alias("hi"))
    years = span.select(F.explode(F.sequence("lo", F.col("hi") + 1)).alias("year"), "lo", "hi")
    entries = [
        F.struct(on.alias("ds"), F.lit(name).alias("holiday")) for name, on in holiday_dates(F.col("year")).items()
    ]
    return (
        years.select("lo", "hi", F.inline(F.array(*entries)))
        .filter(F.year("ds").between(F.col("lo"), F.col("hi")))
        .select("ds", "holiday")
    )


def join_holidays(daily: DataFrame, holidays: DataFrame) -> DataFrame:
    """Add ``holiday`` (names joined by "; ") and ``is_holiday`` to every day.

    The calendar is broadcast: its size is set by the years covered.
    """
    per_day = holidays.groupBy("ds").agg(
        F.array_join(F.array_sort(F.collect_set("holiday")), "; ").alias("holiday")
    )
    return daily.join(F.broadcast(per_day), "ds", "left").withColumn("is_holiday", F.col("holiday").isNotNull())
