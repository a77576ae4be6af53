"""Backtests of the regression forecast at many origins, solved from running sums.

The additive form needs sums of products of its features only. A hinge of the trend is a shifted day number past its knot, so
its products with other features over any stretch of days are differences of running sums of the day number, its square, the
season features and their products with both. One pass over a series gives these sums; every origin then takes its own
training window, knots and scale from them and solves one small system, without going over its days again. The result equals
a separate fit at each origin.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from calltide.operators.evaluate import forecast_metrics
from calltide.operators.regression import (
    DEFAULTS, KNOT_RANGE, KNOTS, prior_scales, season_features, solve_gram, sparse_hinges, unused_seasons,
)

# Executors need not have this package: the solver travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class RunningSums:
    """Sums over the first days of a series; a difference of two gives the sum over the days between."""

    def __init__(self, day: np.ndarray, season: np.ndarray, y: np.ndarray):
        self.day, self.season, self.y = day, season, y
        self.span = float(max(day[-1] - day[0], 1))
        self.u = u = (day - day[0]) / self.span  # near 1, for the sake of exact sums
        run = lambda v: np.concatenate([np.zeros((1, *v.shape[1:])), np.cumsum(v, axis=0)])
        self.powers = [run(np.ones_like(u)), run(u), run(u * u)]
        self.with_y = [run(y), run(u * y)]
        self.squares = run(y * y)
        self.seasons = [run(season), run(season * u[:, None])]
        self.season_y = run(season * y[:, None])
        self.grams: dict[int, np.ndarray] = {0: np.zeros((season.shape[1],) * 2)}

    def season_gram(self, upto: int) -> np.ndarray:
        """Products of the season features over the first ``upto`` days, carried on from the nearest known point before."""
        if upto not in self.grams:
            last = max(k for k in self.grams if k <= upto)
            part = self.season[last:upto]
            self.grams[upto] = self.grams[last] + part.T @ part
        return self.grams[upto]

    def products(self, lo: int, hi: int):
        """Gram matrix, products with y, and the trend's shape for the days ``lo`` to ``hi``."""
        width = float(max(self.day[hi - 1] - self.day[lo], 1)) / self.span
        at = np.concatenate([[0.0], KNOT_RANGE * (np.arange(KNOTS) + 1) / (KNOTS + 1)])  # the line itself, then the hinges
        knots = self.u[lo] + at * width
        since = np.clip(np.searchsorted(self.u, knots, side="right"), lo, hi)
        since[0] = lo
        past = np.maximum(since[:, None], since[None, :])
        m0, m1, m2 = (p[hi] - p[past] for p in self.powers)
        lines = (m2 - (knots[:, None] + knots) * m1 + knots[:, None] * knots * m0) / width**2
        ones = (self.powers[1][hi] - self.powers[1][since] - knots * (hi - since)) / width
        s0, s1 = (s[hi] - s[since] for s in self.seasons)
        mixed = (s1 - knots[:, None] * s0) / width
        y0, y1 = (v[hi] - v[since] for v in self.with_y)
        n, k = 1 + len(knots), 1 + len(knots) + self.season.shape[1]
        gram = np.empty((k, k))
        gram[0, 0] = hi - lo
        gram[0, 1:n] = gram[1:n, 0] = ones
        gram[1:n, 1:n] = lines
        gram[0, n:] = gram[n:, 0] = self.seasons[0][hi] - self.seasons[0][lo]
        gram[1:n, n:], gram[n:, 1:n] = mixed, mixed.T
        gram[n:, n:] = self.season_gram(hi) - self.season_gram(lo)
        right = np.concatenate([[self.with_y[0][hi] - self.with_y[0][lo]], (y1 - knots * y0) / width, self.season_y[hi] - self.season_y[lo]])
        return gram, right, knots, width

    def forecast(self, lo: int, hi: int, upto: int, params: dict[str, str]) -> np.ndarray:
        """Forecast of the days ``hi`` to ``upto`` by a fit to the days ``lo`` to ``hi``."""
        gram, right, knots, width = self.products(lo, hi)
        scale = max(float(np.abs(self.y[lo:hi]).max()), 1e-12)
        n, days = 1 + len(knots), hi - lo
        right = right / scale
        for cut in unused_seasons(params):
            used = slice(n + cut.start, n + cut.stop)
            gram[used], gram[:, used], right[used] = 0.0, 0.0, 0.0
        square = (self.squares[hi] - self.squares[lo]) / scale**2
        variance = max(square / days - (right[0] / days) ** 2, 0.0)
        priors = np.concatenate(prior_scales(params, n, len(right) - n))
        coef = solve_gram(gram, right, variance, priors, lambda b: max(float(square - 2 * b @ right + b @ gram @ b), 0.0) / days, sparse_hinges(params, n))
        hinges = np.maximum((self.u[hi:upto, None] - knots) / width, 0.0)
        return scale * (coef[0] + hinges @ coef[1:n] + self.season[hi:upto] @ coef[n:])


def origin_forecasts(
    points: DataFrame,
    keys: Sequence[str] = (),
    origins: int = 4,
    step_days: int = 14,
    train_days: int | None = 90,
    test_days: int = 14,
    params: dict[str, str] | None = None,
) -> DataFrame:
    """Held-out forecasts (keys, cutoff, ds, y, yhat) of the additive regression at several cutoffs.

    The cutoffs lie ``step_days`` apart, the last one ``test_days`` before the end of the series. Each is trained on its
    trailing ``train_days``, or on all days before when None; a cutoff without training days is left out. A group holds one
    series of daily points.
    """
    settings = {**DEFAULTS, **(params or {})}
    if settings["seasonality_mode"] != "additive":
        raise ValueError("running sums hold for the additive form only")
    schema = T.StructType(
        [points.schema[k] for k in keys]
        + [T.StructField(c, T.DateType()) for c in ("cutoff", "ds")]
        + [T.StructField(c, T.DoubleType()) for c in ("y", "yhat")]
    )
    kept = list(keys)
    known = points.filter(F.col("y").isNotNull() & F.col("ds").isNotNull())
    if keys:
        known = known.repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    rows = known.select(
        *keys, F.datediff("ds", F.lit("1970-01-01").cast("date")).alias("day"), F.array(*season_features("ds")).alias("season"), F.col("y").cast("double").alias("y")
    )

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("day")
        day = pdf["day"].to_numpy()
        sums = RunningSums(day, np.vstack(pdf["season"].to_numpy()), pdf["y"].to_numpy(dtype=float))
        out = []
        for i in reversed(range(origins)):
            cutoff = int(day[-1]) - test_days - i * step_days
            hi, upto = np.searchsorted(day, [cutoff, cutoff + test_days], side="right")
            lo = 0 if train_days is None else int(np.searchsorted(day, cutoff - train_days, side="right"))
            if lo < hi < upto:
                out.append(pd.DataFrame({"cutoff": cutoff, "ds": day[hi:upto], "y": sums.y[hi:upto], "yhat": sums.forecast(lo, int(hi), int(upto), settings)}))
        found = pd.concat(out) if out else pd.DataFrame({c: [] for c in ("cutoff", "ds", "y", "yhat")})
        for c in ("cutoff", "ds"):
            found[c] = pd.to_datetime(found[c], unit="D").dt.date
        for k in kept:
            found[k] = pdf[k].iloc[0]
        return found[[*kept, "cutoff", "ds", "y", "yhat"]]

    return rows.groupBy(*keys).applyInPandas(solve, schema)


def rolling_origin_regression(
    points: DataFrame,
    keys: Sequence[str] = (),
    origins: int = 4,
    step_days: int = 14,
    train_days: int | None = 90,
    test_days: int = 14,
    params: dict[str, str] | None = None,
) -> DataFrame:
    """Scores of the regression forecast per series and cutoff, as ``rolling_origin_backtest`` gives for the trend form."""
    return forecast_metrics(origin_forecasts(points, keys, origins, step_days, train_days, test_days, params), [*keys, "cutoff"])


def backtest_regression(
    points: DataFrame, keys: Sequence[str] = (), test_days: int = 28, params: dict[str, str] | None = None
) -> DataFrame:
    """Scores of the regression forecast on the last ``test_days`` of each series, fitted on all days before."""
    return forecast_metrics(origin_forecasts(points, keys, 1, test_days, None, test_days, params), keys)
