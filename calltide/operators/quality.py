"""Data-quality rules and monitoring measures. Every check reads all rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from calltide.functions.times import ntz, wall_seconds
from calltide.operators.series import explode_days


class QualityError(ValueError):
    """Raised when a quality rule fails."""


@dataclass(frozen=True)
class Rule:
    """A named rule: which values count, and which of those pass."""

    name: str
    applies: str
    passes: str
    mostly: float = 1.0


def not_null(column: str, mostly: float = 1.0) -> Rule:
    return Rule(f"{column}_not_null", "true", f"`{column}` IS NOT NULL", mostly)


def between(column: str, low: float, high: float, mostly: float = 1.0) -> Rule:
    """Range rule, bounds included; NULL and NaN values are left out of the ratio."""
    present = f"(`{column}` IS NOT NULL AND NOT isnan(`{column}`))"
    return Rule(f"{column}_between", present, f"(`{column}` BETWEEN {low} AND {high})", mostly)


def dated_between(column: str, first: str, last: str, mostly: float = 1.0) -> Rule:
    """Date range rule, bounds included; dates outside are reported, never cut off."""
    return Rule(f"{column}_dated", f"`{column}` IS NOT NULL", f"(CAST(`{column}` AS DATE) BETWEEN DATE '{first}' AND DATE '{last}')", mostly)


def missing_notes(columns: Sequence[str]) -> list[Rule]:
    """Rules that always pass and put the names of absent input columns into the report."""
    return [Rule(f"{c}_column_missing", "false", "true") for c in columns]


# The rules of the cleaned table.
SILVER_RULES = (
    not_null("complaint_type"),
    between("latitude", -90, 90, mostly=0.99),
    between("longitude", -180, 180, mostly=0.99),
)


def quality_report(df: DataFrame, rules: Sequence[Rule] = SILVER_RULES) -> DataFrame:
    """One row per rule (rule, total, failed, ratio, success) from one pass over the data.

    A rule without any value to judge passes.
    """
    counts = []
    for i, r in enumerate(rules):
        counts.append(F.count_if(F.expr(r.applies)).alias(f"total_{i}"))
        counts.append(F.count_if(F.expr(f"{r.applies} AND NOT {r.passes}")).alias(f"failed_{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.col(f"total_{i}").alias("total"),
                F.col(f"failed_{i}").alias("failed"),
                F.lit(r.mostly).alias("mostly"),
            )
            for i, r in enumerate(rules)
        ]
    )
    ratio = F.when(F.col("total") > 0, (F.col("total") - F.col("failed")) / F.col("total")).otherwise(1.0)
    return (
        df.agg(*counts)
        .select(F.inline(rows))
        .withColumn("ratio", ratio)
        .withColumn("success", F.col("ratio") >= F.col("mostly"))
        .drop("mostly")
    )


def expect_not_null(df: DataFrame, column: str) -> DataFrame:
    return quality_report(df, [not_null(column)])


def expect_between(df: DataFrame, column: str, low: float, high: float, mostly: float = 1.0) -> DataFrame:
    return quality_report(df, [between(column, low, high, mostly)])


def enforce_report(report: DataFrame) -> None:
    """Raise QualityError naming the rules that failed in a quality report."""
    failed = report.filter(~F.col("success")).collect()  # one row per failed rule
    if failed:
        raise QualityError("; ".join(f"{r.rule}: {r.failed} of {r.total} values fail" for r in failed))


def enforce(df: DataFrame, rules: Sequence[Rule] = SILVER_RULES) -> DataFrame:
    """Return ``df`` unchanged, or raise QualityError naming the failed rules."""
    enforce_report(quality_report(df, rules))
    return df


def quarantine(df: DataFrame, rules: Sequence[Rule] = SILVER_RULES) -> DataFrame:
    """Add ``failed_rules``, the names of the rules a row breaks (empty = valid)."""
    broken = [F.when(F.expr(f"{r.applies} AND NOT {r.passes}"), F.lit(r.name)) for r in rules]
    return df.withColumn("failed_rules", F.array_compact(F.array(*broken)))


def split_valid(df: DataFrame, rules: Sequence[Rule] = SILVER_RULES) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the mask, rejected rows with it)."""
    masked = quarantine(df, rules)
    valid = masked.filter(F.size("failed_rules") == 0).drop("failed_rules")
    return valid, masked.filter(F.size("failed_rules") > 0)


def daily_completeness(df: DataFrame, ts: str) -> DataFrame:
    """Rows per one-day tumbling window."""
    return (
        df.groupBy(F.window(ts, "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("records"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "records")
    )


def missing_dates(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Days without a row between the first and last day of each series.

    Gaps are opened between neighbouring days, so no calendar is joined.
    """
    in_order = Window.partitionBy(*keys).orderBy("ds")
    gaps = daily.select(*keys, "ds").withColumn("__next", F.lead("ds").over(in_order)).filter(F.col("__next") > F.date_add("ds", 1))
    return explode_days(gaps, F.date_add("ds", 1), F.date_sub("__next", 1)).select(*keys, "ds")


def drift_report(
    df: DataFrame, ts: str, column: str, history: int = 28, z_limit: float = 3.0
) -> DataFrame:
    """Daily row count and NULL rate against the preceding ``history`` observed days.

    ``drifted`` is TRUE when either lies more than ``z_limit`` standard
    deviations from its trailing mean, NULL while there is no spread to judge by.
    """
    daily = df.groupBy(F.to_date(ts).alias("ds")).agg(
        F.count(F.lit(1)).alias("records"),
        (F.count_if(F.col(column).isNull()) / F.count(F.lit(1))).alias("null_rate"),
    )
    past = Window.orderBy("ds").rowsBetween(-history, -1)

    def z(value: str) -> Column:
        spread = F.stddev_samp(value).over(past)
        return F.when(spread > 1e-9, (F.col(value) - F.avg(value).over(past)) / spread)

    scored = daily.withColumns({"records_z": z("records"), "null_rate_z": z("null_rate")})
    far = [F.abs(F.col(c)) > z_limit for c in ("records_z", "null_rate_z")]
    return scored.withColumn("drifted", far[0] | far[1])


def value_drift(
    df: DataFrame, ts: str, columns: Sequence[str], history: int = 28, least: float = 0.1, sketch_size: int = 800
) -> DataFrame:
    """How far the values of a day lie from those of the preceding ``history`` observed days: per day and column.

    Each day and column is one quantile sketch (KLL), combined before the only shuffle of values; the sketches of the days before
    are merged for the reference. ``distance`` is the largest difference of the two distributions, read off 49 quantiles of both.
    ``drifted`` is TRUE when it exceeds ``least`` and what chance explains in one of a hundred days (Kolmogorov and Smirnov). It is
    NULL while there is no reference or the day has no values. NULL and NaN are no values; their rate is ``drift_report``'s matter.
    Up to ``sketch_size`` values are held exactly; beyond, ranks are off by about 2 / ``sketch_size``.
    """
    sketch = lambda c: F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(sketch_size))
    daily = df.groupBy(F.to_date(ts).alias("ds")).agg(*[sketch(c).alias(f"__{i}") for i, c in enumerate(columns)])
    rows = daily.select("ds", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__{i}").alias("day")) for i, c in enumerate(columns)])).alias("r"))
    past = Window.partitionBy("column").orderBy("ds").rowsBetween(-history, -1)
    both = rows.select("ds", "r.column", "r.day").withColumn("past", F.kll_merge_agg_double("day", F.lit(sketch_size)).over(past))
    number = lambda c: F.kll_sketch_get_n_double(c)
    ranks = F.array(*[F.lit(i / 50) for i in range(1, 50)])
    # A sketch without values has no quantiles.
    at = lambda c, n: F.when(F.col(n) > 0, F.kll_sketch_get_quantile_double(F.col(c), ranks))
    known = both.select("ds", "column", "day", "past", number("day").alias("records"), F.coalesce(number("past"), F.lit(0)).alias("reference"))
    known = known.withColumns({"__a": at("day", "records"), "__b": at("past", "reference")})
    upto = lambda of, x: F.size(F.filter(of, lambda v: v <= x))
    apart = F.transform(F.concat("__a", "__b"), lambda x: F.abs(upto(F.col("__a"), x) - upto(F.col("__b"), x)))
    chance = 1.63 * F.sqrt((F.col("records") + F.col("reference")) / (F.col("records") * F.col("reference")))
    scored = known.withColumn("distance", F.array_max(apart) / 50)
    return scored.select(
        "ds", "column", "records", "reference", "distance", F.when(F.col("distance").isNotNull(), F.col("distance") > F.greatest(F.lit(least), chance)).alias("drifted")
    )


def freshness(df: DataFrame, ts: str, as_of: str, limit_hours: float = 2.0) -> DataFrame:
    """One row: newest time, its lag behind ``as_of`` in seconds, and whether it is in the limit."""
    newest = df.agg(F.max(ts).alias("last_ts"))
    lag = wall_seconds(ntz(as_of)) - wall_seconds(F.col("last_ts"))
    return newest.withColumn("lag_seconds", lag).withColumn("fresh", F.col("lag_seconds") < limit_hours * 3600)


def run_metrics(runs: DataFrame, goal: float = 0.995) -> DataFrame:
    """Success rate and durations per job and day of a run log (job, day, success, duration_s).

    The median is exact at any size, the lower one of an even number: equal
    durations are counted first, then summed in order until half of the runs
    are reached.
    """
    day = Window.partitionBy("job", "day")
    counted = runs.groupBy("job", "day", "duration_s").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if("success").alias("good"),
        (F.sum("duration_s")).alias("spent"),
    )
    known = F.when(F.col("duration_s").isNotNull(), F.col("runs")).otherwise(0)
    placed = counted.withColumns(
        {"upto": F.sum(known).over(day.orderBy(F.col("duration_s").asc_nulls_last())), "known": F.sum(known).over(day)}
    )
    reached = (2 * F.col("upto") >= F.col("known")) & F.col("duration_s").isNotNull()
    return (
        placed.groupBy("job", "day")
        .agg(
            F.sum("runs").alias("runs"),
            (F.sum("good") / F.sum("runs")).alias("success_rate"),
            (F.sum("spent") / F.max("known")).alias("mean_duration_s"),
            F.max("duration_s").alias("max_duration_s"),
            F.min(F.when(reached, F.col("duration_s"))).alias("median_duration_s"),
        )
        .withColumn("meets_goal", F.col("success_rate") >= goal)
    )
