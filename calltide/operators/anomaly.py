"""Breaches of the forecast band, streaks and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from calltide.functions.columns import join_series
from calltide.functions.times import day_number


def actual_vs_forecast(actual: DataFrame, forecast: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Every actual day with its upper bound; days without a forecast keep NULL."""
    bound = forecast.select(*keys, F.col("ds").cast("date").alias("ds"), "yhat_upper")
    return join_series(actual, bound, [*keys, "ds"], "left")


def flag_breaches(joined: DataFrame) -> DataFrame:
    """``is_anomaly`` = y above its upper bound; NULL where there is no bound."""
    return joined.withColumn("is_anomaly", F.col("y") > F.col("yhat_upper"))


def _with_alert(df: DataFrame, alert_after: int) -> DataFrame:
    return df.withColumn("alert", F.col("anomaly_streak") >= alert_after)


def breach_cumulative(flagged: DataFrame, keys: Sequence[str] = (), alert_after: int = 3) -> DataFrame:
    """Breaches so far in the series, never reset, and the alert on them."""
    so_far = Window.partitionBy(*keys).orderBy("ds").rowsBetween(Window.unboundedPreceding, 0)
    hits = F.when(F.col("is_anomaly"), 1).otherwise(0)
    return _with_alert(flagged.withColumn("anomaly_streak", F.sum(hits).over(so_far)), alert_after)


def breach_streak(flagged: DataFrame, keys: Sequence[str] = (), alert_after: int = 3) -> DataFrame:
    """Length of the current run of consecutive calendar days in breach.

    A day without breach, without bound, or missing altogether ends the run.
    Days of one run share (day number - rank among breach days), so the run is
    counted in a second window that reuses the first one's partitioning.
    """
    breach = F.coalesce(F.col("is_anomaly"), F.lit(False))
    by_day = Window.partitionBy(*keys, "__breach").orderBy("ds")
    in_run = Window.partitionBy(*keys, "__breach", "__run").orderBy("ds")
    runs = (
        flagged.withColumn("__breach", breach)
        .withColumn("__run", day_number("ds") - F.row_number().over(by_day))
        .withColumn("__length", F.row_number().over(in_run))
    )
    length = F.when(F.col("__breach"), F.col("__length")).otherwise(0).cast("bigint")
    return _with_alert(runs.withColumn("anomaly_streak", length).drop("__breach", "__run", "__length"), alert_after)


def false_positive_rate(flagged: DataFrame, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Share of unlabelled days that were flagged; NULL when every day is labelled."""
    normal = ~F.coalesce(F.col(label), F.lit(False))
    false_alarms = F.count_if(normal & F.coalesce(F.col("is_anomaly"), F.lit(False)))
    return (
        flagged.groupBy(*keys)
        .agg(false_alarms.alias("false_positives"), F.count_if(normal).alias("negatives"))
        .withColumn(
            "false_positive_rate",
            F.when(F.col("negatives") > 0, F.col("false_positives") / F.col("negatives")),
        )
    )
