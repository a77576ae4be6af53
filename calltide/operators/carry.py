"""Row-based features kept up by carried rows: the last rows of every month and series.

A feature looks back a few rows in its series, so a change reaches as many rows beyond it. With the last rows of each month
at hand, a changed month and what it reaches are computed again without reading the months between or before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from calltide.functions.columns import all_of
from calltide.operators.merge import sized
from calltide.operators.series import DAILY_KEYS, add_lag, add_moving_avg

REACH = 7  # rows a feature looks back


def with_features(daily: DataFrame, keys: Sequence[str] = DAILY_KEYS) -> DataFrame:
    return add_moving_avg(add_lag(daily, keys, REACH), keys, REACH)


def tails(daily: DataFrame, keys: Sequence[str] = DAILY_KEYS) -> DataFrame:
    """``month``, keys, ``year``, the number ``n`` of rows of each series in the month, and its last rows as ``tail``.

    A group holds the days of one month.
    """
    rows = F.slice(F.sort_array(F.collect_list(F.struct("ds", "y")), asc=False), 1, REACH)
    # collect_list skips no struct, so a row without a day is held too; it sorts first in its series.
    return daily.groupBy("month", *keys).agg(F.count(F.lit(1)).alias("n"), rows.alias("tail")).withColumn("year", F.year("month"))


def rows_after(daily: DataFrame, changed: DataFrame, keys: Sequence[str] = DAILY_KEYS, n: int = 0) -> DataFrame:
    """``changed`` (keys, month and its last changed day ``last``) with the number ``after`` of later rows in the month.

    ``n`` is the number of rows of ``daily`` where it is known.
    """
    later = daily.select("month", *keys, "ds").withColumnsRenamed({c: f"__{c}" for c in ("month", *keys, "ds")})
    same = all_of([changed[c].eqNullSafe(later[f"__{c}"]) for c in ("month", *keys)])
    both = changed.join(sized(later, n), same & (later["__ds"] > changed["last"]), "left")
    return both.groupBy(*keys, "month").agg(F.count("__ds").alias("after"))


def months_to_redo(held: DataFrame, changed: DataFrame, keys: Sequence[str] = DAILY_KEYS, n: int = 0) -> DataFrame:
    """Months of changed series with ``state``: ``redo``, or ``before`` for those whose last rows the former need.

    ``held`` are the tails after the change, ``changed`` the series and months that changed, with the number ``after`` of rows
    that the month has after its last changed day. To be redone are changed months and those with a row at most ``REACH`` rows
    after a changed one. ``n`` is the number of rows of ``changed`` where it is known.
    """
    series = changed.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    own = held.join(sized(series, n), all_of([held[k].eqNullSafe(series[f"__{k}"]) for k in keys]), "left_semi")
    none = F.lit(None).cast(held.schema["tail"].dataType).alias("tail")
    no = F.lit(None).cast("bigint")
    both = own.select(*keys, "month", "n", "tail", no.alias("after")).unionByName(
        changed.select(*keys, "month", F.lit(0).cast("bigint").alias("n"), none, "after")
    )
    spans = both.groupBy(*keys, "month").agg(F.sum("n").alias("n"), F.max("after").alias("after"), F.any_value("tail", F.lit(True)).alias("tail"))
    by_month = Window.partitionBy(*keys).orderBy("month")
    upto = F.sum("n").over(by_month.rowsBetween(Window.unboundedPreceding, 0))
    last = F.last(F.col("upto") - F.col("after"), ignorenulls=True).over(by_month.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.first_value(F.when(F.col("redo"), F.col("upto") - F.col("n")), F.lit(True)).over(by_month.rowsBetween(1, Window.unboundedFollowing))
    found = (
        spans.withColumn("upto", upto).withColumn("last", last)
        .withColumn("redo", F.col("after").isNotNull() | F.coalesce(F.col("upto") - F.col("n") - F.col("last") < REACH, F.lit(False)))
        .withColumn("ahead", ahead)
    )
    needed = F.coalesce(F.col("ahead") - F.col("upto") < REACH, F.lit(False))
    state = F.when(F.col("redo"), "redo").when(needed, "before")
    return found.select(*keys, "month", "tail", state.alias("state")).filter("state IS NOT NULL")
