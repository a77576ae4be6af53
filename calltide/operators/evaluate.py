"""Forecast scores, in-sample and held out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from calltide.functions.columns import all_of, join_series
from calltide.operators.forecast import held_out, holdout_forecast


def ape() -> Column:
    """Absolute percentage error with the actual value floored at 1."""
    return F.abs(F.col("y") - F.col("yhat")) / F.greatest(F.col("y").cast("double"), F.lit(1.0))


def scored_days(forecast: DataFrame, actual: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Forecast days that have an actual value: (keys, ds, y, yhat)."""
    bound = forecast.select(*keys, F.col("ds").cast("date").alias("ds"), "yhat")
    known = actual.filter(F.col("y").isNotNull()).select(*keys, "ds", "y")
    return join_series(known, bound, [*keys, "ds"], "inner").filter(F.col("yhat").isNotNull())


def mape_tail(
    forecast: DataFrame,
    actual: DataFrame,
    keys: Sequence[str] = (),
    days: int = 14,
    more_than: int = 0,
) -> DataFrame:
    """MAPE over the last ``days`` scored days of each series.

    With a forecast fitted on the whole series this is an in-sample score; use
    ``backtest`` to choose between models. Series with at most ``more_than``
    scored days get NULL (28 for the training report).
    """
    newest = Window.partitionBy(*keys).orderBy(F.desc("ds"))
    ranked = scored_days(forecast, actual, keys).withColumns(
        {"__rank": F.row_number().over(newest), "__days": F.count(F.lit(1)).over(Window.partitionBy(*keys))}
    )
    return (
        ranked.filter(F.col("__rank") <= days)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("scored_days"),
            F.when(F.max("__days") > more_than, F.avg(ape())).alias("mape"),
        )
    )


def tuning_days(horizon: int, backtest_days: int = 28) -> int:
    """Days the tuning score looks at."""
    return min(horizon, backtest_days)


def forecast_metrics(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """MAPE, MAE, RMSE and mean residual per series of (keys, ds, y, yhat)."""
    residual = F.col("y") - F.col("yhat")
    return scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("scored_days"),
        F.avg(ape()).alias("mape"),
        F.avg(F.abs(residual)).alias("mae"),
        F.sqrt(F.avg(residual * residual)).alias("rmse"),
        F.avg(residual).alias("mean_residual"),
    )


def backtest(points: DataFrame, keys: Sequence[str] = (), test_days: int = 28) -> DataFrame:
    """Scores of the trend + weekday model on a real holdout, per series."""
    return forecast_metrics(holdout_forecast(points, keys, test_days), keys)


def rolling_origin_forecasts(
    points: DataFrame,
    keys: Sequence[str] = (),
    origins: int = 4,
    step_days: int = 14,
    train_days: int = 90,
    test_days: int = 14,
) -> DataFrame:
    """Held-out forecasts (keys, cutoff, ds, y, yhat) of the trend + weekday model at several cutoffs.

    Every day opens into the cutoffs that use it and (series, cutoff) becomes
    the series, so all cutoffs are fitted in one job.
    """
    last = F.max("ds").over(Window.partitionBy(*keys))
    cutoffs = F.transform(
        F.sequence(F.lit(1), F.lit(origins)),
        lambda i: F.date_sub(F.col("__last"), (test_days + (i - 1) * step_days).cast("int")),
    )
    used = (F.col("ds") > F.date_sub("cutoff", train_days)) & (F.col("ds") <= F.date_add("cutoff", test_days))
    opened = points.withColumn("__last", last).withColumn("cutoff", F.explode(cutoffs)).filter(used)
    return held_out(opened.drop("__last"), [*keys, "cutoff"])


def rolling_origin_backtest(
    points: DataFrame,
    keys: Sequence[str] = (),
    origins: int = 4,
    step_days: int = 14,
    train_days: int = 90,
    test_days: int = 14,
) -> DataFrame:
    """Backtest at several cutoffs, each trained on its trailing ``train_days``."""
    held = rolling_origin_forecasts(points, keys, origins, step_days, train_days, test_days)
    return forecast_metrics(held, [*keys, "cutoff"])


def conformal_widths(held: DataFrame, keys: Sequence[str] = (), interval_width: float = 0.95, block_days: int = 7) -> DataFrame:
    """Half-widths by horizon from held-out residuals: (keys, last_ds, block, half).

    Split-conformal: of n absolute residuals of a series and block of ``block_days`` horizon days, the ceil((n + 1) *
    ``interval_width``)-th smallest. A new residual of the same kind lies within it with at least that probability, whatever its
    distribution. A block with too few residuals for that rank takes the residuals of all blocks of the series, and their largest
    when those are too few as well. ``held`` are rolling-origin forecasts (keys, cutoff, ds, y, yhat); ``last_ds`` is the last day
    they know.
    """
    days = held.withColumns(
        {
            "__error": F.abs(F.col("y") - F.col("yhat")),
            "block": F.floor((F.datediff("ds", "cutoff") - 1) / block_days).cast("int"),
        }
    )

    def rank(n: str) -> Column:
        # A hair less, as 0.95 * 20 is a little more than 19 in binary.
        return F.ceil((F.col(n) + 1) * interval_width - 1e-9).cast("int")

    errors = F.sort_array(F.collect_list("__error"))  # a group holds origins times horizon days at most
    own = Window.partitionBy(*keys)
    found = (
        days.groupBy(*keys, "block").agg(errors.alias("__own"), F.max("ds").alias("__last"))
        .withColumns({"__all": F.sort_array(F.flatten(F.collect_list("__own").over(own))), "last_ds": F.max("__last").over(own)})
        .withColumns({"__n": F.size("__own"), "__m": F.size("__all")})
    )
    half = (
        F.when(rank("__n") <= F.col("__n"), F.get("__own", rank("__n") - 1))
        .when(rank("__m") <= F.col("__m"), F.get("__all", rank("__m") - 1))
        .otherwise(F.array_max("__all"))
    )
    return found.select(*keys, "last_ds", "block", half.alias("half"))


def calibrated_band(
    forecast: DataFrame, held: DataFrame, keys: Sequence[str] = (), interval_width: float = 0.95, block_days: int = 7
) -> DataFrame:
    """The forecast with a band from held-out residuals on the days after the data; observed days keep theirs.

    Days further ahead than any held-out day take the widths of the last block.
    """
    widths = conformal_widths(held, keys, interval_width, block_days)
    listed = widths.groupBy(*keys).agg(
        F.max("last_ds").alias("__last"), F.max("block").alias("__blocks"), F.map_from_entries(F.collect_list(F.struct("block", "half"))).alias("__halves")
    )
    joined = join_series(forecast, listed, keys) if keys else forecast.join(listed, F.lit(True), "left")
    ahead = F.datediff("ds", "__last")
    block = F.least(F.floor((ahead - 1) / block_days).cast("int"), F.col("__blocks"))
    half = F.try_element_at("__halves", block)
    use = (ahead > 0) & half.isNotNull()
    return joined.withColumns(
        {
            "yhat_lower": F.when(use, F.col("yhat") - half).otherwise(F.col("yhat_lower")),
            "yhat_upper": F.when(use, F.col("yhat") + half).otherwise(F.col("yhat_upper")),
        }
    ).select(*forecast.columns)
