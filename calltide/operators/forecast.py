"""Trend + weekday forecast in closed form.

The fitted model is a table with one row per series, so forecasting needs no
join: the row opens into its days and the forecast is an expression on them.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from calltide.functions.times import day_number
from calltide.operators.series import days_ahead, explode_days

_ORIGIN = 10957  # day number of 2000-01-01, keeps the trend axis small


def band_z(interval_width: float) -> float:
    """Normal quantile of a two-sided interval."""
    return NormalDist().inv_cdf(0.5 + interval_width / 2)


def _axis(ds: str = "ds") -> Column:
    return (day_number(ds) - _ORIGIN).cast("double")


def with_fit(points: DataFrame, keys: Sequence[str], train_y: Column) -> DataFrame:
    """Add slope, intercept, weekday effect and training residual to every row of a series.

    ``train_y`` is NULL on rows the fit must not see. One shuffle by series: the
    weekday window works on the same partitioning.
    """
    series = Window.partitionBy(*keys)
    same_weekday = Window.partitionBy(*keys, "__dow")
    return (
        points.withColumns({"__x": _axis(), "__dow": F.dayofweek("ds"), "__train": train_y.cast("double")})
        .withColumns(
            {
                "slope": F.coalesce(F.regr_slope("__train", "__x").over(series), F.lit(0.0)),
                "intercept": F.coalesce(
                    F.regr_intercept("__train", "__x").over(series), F.avg("__train").over(series)
                ),
            }
        )
        .withColumn("__rest", F.col("__train") - F.col("intercept") - F.col("slope") * F.col("__x"))
        .withColumn("__effect", F.coalesce(F.avg("__rest").over(same_weekday), F.lit(0.0)))
    )


def fit_trend_seasonal(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares line per series, then the mean residual per weekday: one row per series.

    A single-day series has slope 0 and no sigma, hence no band.
    """
    fitted = with_fit(points.filter(F.col("y").isNotNull()), keys, F.col("y"))
    effects = [F.coalesce(F.max(F.when(F.col("__dow") == d, F.col("__effect"))), F.lit(0.0)) for d in range(1, 8)]
    return fitted.groupBy(*keys).agg(
        F.max("slope").alias("slope"),
        F.max("intercept").alias("intercept"),
        F.array(*effects).alias("weekday_effect"),
        F.stddev_samp(F.col("__rest") - F.col("__effect")).alias("sigma"),
        F.count(F.lit(1)).alias("n_days"),
        F.min("ds").alias("first_ds"),
        F.max("ds").alias("last_ds"),
        F.sort_array(F.collect_set("ds")).alias("days"),
    )


def _yhat(ds: str = "ds") -> Column:
    weekday = F.element_at("weekday_effect", F.dayofweek(ds))
    return F.col("intercept") + F.col("slope") * _axis(ds) + weekday


def with_band(df: DataFrame, interval_width: float) -> DataFrame:
    """Add yhat_lower and yhat_upper around ``yhat`` from the column ``sigma``."""
    half = F.col("sigma") * band_z(interval_width)
    return df.withColumns({"yhat_lower": F.col("yhat") - half, "yhat_upper": F.col("yhat") + half})


def open_days(model: DataFrame, horizon: int, include_history: bool = True, fill_gaps: bool = False) -> DataFrame:
    """One row per model and day: its observed days, unless only the horizon is wanted, and the horizon after its last.

    With ``fill_gaps`` the days between the observed ones are opened as well.
    """
    if include_history and fill_gaps:
        return explode_days(model, F.col("first_ds"), F.date_add("last_ds", horizon))
    ahead = days_ahead("last_ds", horizon)
    return model.withColumn("ds", F.explode(F.concat("days", ahead) if include_history else ahead))


def predict_trend_seasonal(
    model: DataFrame,
    keys: Sequence[str] = (),
    horizon: int = 14,
    include_history: bool = True,
    interval_width: float = 0.95,
    fill_gaps: bool = False,
) -> DataFrame:
    """Forecast rows (keys, ds, yhat, yhat_lower, yhat_upper) of a fitted model table."""
    days = open_days(model, horizon, include_history, fill_gaps).withColumn("yhat", _yhat())
    return with_band(days, interval_width).select(*keys, "ds", "yhat", "yhat_lower", "yhat_upper")


def forecast_trend_seasonal(
    points: DataFrame,
    keys: Sequence[str] = (),
    horizon: int = 14,
    include_history: bool = True,
    interval_width: float = 0.95,
    fill_gaps: bool = False,
) -> DataFrame:
    """Fit and forecast every series: its observed days and ``horizon`` days, with a band."""
    model = fit_trend_seasonal(points, keys)
    return predict_trend_seasonal(model, keys, horizon, include_history, interval_width, fill_gaps)


def held_out(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, ds, y, yhat) of the days after the column ``cutoff``, fitted on the days up to it.

    Training and held-out days share the window partition, so no join is needed.
    A series without training days is left out.
    """
    fitted = with_fit(points, keys, F.when(F.col("ds") <= F.col("cutoff"), F.col("y")))
    yhat = F.col("intercept") + F.col("slope") * F.col("__x") + F.col("__effect")
    scored = (F.col("ds") > F.col("cutoff")) & F.col("intercept").isNotNull() & F.col("y").isNotNull()
    return fitted.filter(scored).select(*keys, "ds", "y", yhat.alias("yhat"))


def holdout_forecast(points: DataFrame, keys: Sequence[str] = (), test_days: int = 28) -> DataFrame:
    """Held-out forecast of the last ``test_days`` calendar days of each series."""
    last = F.max("ds").over(Window.partitionBy(*keys))
    return held_out(points.withColumn("cutoff", F.date_sub(last, test_days)), keys)


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Return ``df``, or raise when it has no rows."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df
