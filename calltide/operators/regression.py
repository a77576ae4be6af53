"""Regression forecast: piecewise-linear trend, Fourier seasons, holidays.

The setting ``changepoint_prior`` is ``normal`` (the default), which spreads a
change of slope over neighbouring knots, or ``laplace``, which keeps few knots.

Spark computes the features of a day, both for fitting and for forecasting;
Python only solves one small penalised least-squares problem per series
(``applyInPandas``). A group holds one series of daily points, so its size is
set by the calendar. The result is a coefficient table with one row per series,
and forecasting is a sum of products on it.
"""

from __future__ import annotations

import json
import math
import random
import sys
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from calltide.functions.holidays import HOLIDAY_NAMES, holiday_flags
from calltide.functions.times import day_number
from calltide.operators.evaluate import tuning_days
from calltide.operators.forecast import open_days, with_band
from calltide.sources.layers import parked

# Executors need not have this package: the solver travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Shape of the model.
KNOTS = 25
KNOT_RANGE = 0.8
SPARSE_STEPS = 40
WEEKLY_ORDER = 3
YEARLY_ORDER = 10
DEFAULTS = {
    "growth": "linear",
    "daily_seasonality": "false",
    "changepoint_prior_scale": "0.05",
    "seasonality_prior_scale": "10.0",
    "holidays_prior_scale": "10.0",
    "seasonality_mode": "additive",
    "weekly_seasonality": "true",
    "yearly_seasonality": "true",
}

# Columns of the season features: weekly, yearly, holidays.
_WEEKLY = slice(0, 2 * WEEKLY_ORDER)
_YEARLY = slice(_WEEKLY.stop, _WEEKLY.stop + 2 * YEARLY_ORDER)
_HOLIDAY = slice(_YEARLY.stop, _YEARLY.stop + len(HOLIDAY_NAMES))

_FIT_COLUMNS = [
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("trend_coef", T.ArrayType(T.DoubleType())),
    T.StructField("season_coef", T.ArrayType(T.DoubleType())),
    T.StructField("y_scale", T.DoubleType()),
    T.StructField("sigma", T.DoubleType()),
    T.StructField("first_ds", T.DateType()),
    T.StructField("last_ds", T.DateType()),
    T.StructField("days", T.ArrayType(T.DateType())),
]


def trend_features(ds: str, first: str, last: str) -> list[Column]:
    """[1, t, hinges]: t runs from 0 to 1 over the training span, knots on its first 80 %."""
    span = F.greatest(F.datediff(last, first), F.lit(1))
    t = F.datediff(ds, first) / span
    hinges = [F.greatest(t - KNOT_RANGE * (k + 1) / (KNOTS + 1), F.lit(0.0)) for k in range(KNOTS)]
    return [F.lit(1.0), t, *hinges]


def season_features(ds: str) -> list[Column]:
    """Weekly and yearly Fourier terms and the holiday flags of a day."""
    day = day_number(ds)
    waves = []
    for period, order in ((7.0, WEEKLY_ORDER), (365.25, YEARLY_ORDER)):
        for k in range(1, order + 1):
            angle = day * (2 * math.pi * k / period)
            waves += [F.sin(angle), F.cos(angle)]
    return waves + holiday_flags(F.col(ds))


def _solve(x: np.ndarray, y: np.ndarray, prior_sd: np.ndarray, sparse: int = 0) -> np.ndarray:
    """Penalised least squares under independent priors, the noise variance refined on the way."""
    return solve_gram(x.T @ x, x.T @ y, float(np.var(y)), prior_sd, lambda coef: float(np.mean((y - x @ coef) ** 2)), sparse)


def solve_gram(
    gram: np.ndarray, right: np.ndarray, variance: float, prior_sd: np.ndarray, error: Callable[[np.ndarray], float], sparse: int = 0
) -> np.ndarray:
    """The same from sums of products; ``error`` gives the mean squared residual of coefficients.

    Priors are normal, for the ``sparse`` coefficients after the first two double exponential: those are reweighted again and
    again, a small one being penalised ever harder, so that a few large ones stay and the others go to zero. An infinite prior
    leaves a coefficient unpenalised. What the days cannot tell apart is then split evenly.
    """
    noise, coef = max(variance * 0.1, 1e-8), np.zeros(len(right))
    hinges = slice(2, 2 + sparse)
    for step in range(SPARSE_STEPS if sparse else 3):
        weight = noise / prior_sd**2
        if step and sparse:
            weight[hinges] = noise / (prior_sd[hinges] * np.maximum(np.abs(coef[hinges]), 1e-9))
        penalised = gram + np.diag(weight)
        try:
            coef = np.linalg.solve(penalised, right)
        except np.linalg.LinAlgError:
            size = np.sqrt(np.diag(penalised))
            size[size == 0] = 1.0
            coef = np.linalg.lstsq(penalised / np.outer(size, size), right / size, rcond=1e-12)[0] / size
        noise = max(error(coef), 1e-8)
    return coef


def prior_scales(params: dict[str, str], n_trend: int, n_season: int) -> tuple[np.ndarray, np.ndarray]:
    """Standard deviations of the priors of the trend's and the seasons' coefficients."""
    trend_sd = np.full(n_trend, float(params["changepoint_prior_scale"]))
    trend_sd[:2] = float(params.get("trend_prior_scale", "5.0"))
    season_sd = np.full(n_season, float(params["seasonality_prior_scale"]))
    season_sd[_HOLIDAY] = float(params["holidays_prior_scale"])
    for cut in unused_seasons(params):
        season_sd[cut] = 1.0  # columns of zeros
    return trend_sd, season_sd


def sparse_hinges(params: dict[str, str], n_trend: int) -> int:
    """Number of hinges with a double exponential prior."""
    return n_trend - 2 if params.get("changepoint_prior") == "laplace" else 0


def unused_seasons(params: dict[str, str]) -> list[slice]:
    """Season columns that the settings switch off."""
    return [cut for name, cut in (("weekly_seasonality", _WEEKLY), ("yearly_seasonality", _YEARLY)) if params[name] != "true"]


def solve_series(trend: np.ndarray, season: np.ndarray, y: np.ndarray, params: dict[str, str]):
    """(trend coefficients, season coefficients, fitted values) of one series scaled to about 1."""
    trend_sd, season_sd = prior_scales(params, trend.shape[1], season.shape[1])
    sparse = sparse_hinges(params, trend.shape[1])
    season = season.copy()  # a column of zeros gets coefficient 0
    for cut in unused_seasons(params):
        season[:, cut] = 0.0

    if params["seasonality_mode"] == "additive":
        both = _solve(np.hstack([trend, season]), y, np.concatenate([trend_sd, season_sd]), sparse)
        a, b = both[: trend.shape[1]], both[trend.shape[1] :]
        return a, b, trend @ a + season @ b
    b = np.zeros(season.shape[1])
    for _ in range(5):  # trend * (1 + season): solve one factor while the other is held
        a = _solve(trend * (1 + season @ b)[:, None], y, trend_sd, sparse)
        level = trend @ a
        b = _solve(season * level[:, None], y - level, season_sd)
    return a, b, (trend @ a) * (1 + season @ b)


def unpenalised(weekly: bool = True) -> dict[str, str]:
    """Settings of ordinary least squares: a straight line, with or without weekday effects, no penalty and nothing else."""
    off, free = "1e-12", "inf"
    return {
        **DEFAULTS, "changepoint_prior_scale": off, "holidays_prior_scale": off, "seasonality_prior_scale": free,
        "trend_prior_scale": free, "weekly_seasonality": str(weekly).lower(), "yearly_seasonality": "false",
    }


def _with_features(points: DataFrame, groups: Sequence[str], held_days: int = 0) -> DataFrame:
    """Add training span and features; the window shares the grouping's partitioning.

    The span ends with the last day before the ``held_days``.

    The series are spread over a fixed number of partitions: their rows are few
    and their fits are not, so adaptive execution must not merge them by size.
    """
    series = Window.partitionBy(*groups)
    known = points.filter(F.col("y").isNotNull())
    if groups:
        known = known.repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), *groups)
    return (
        known.withColumn("y", F.col("y").cast("double"))
        .withColumns({"first_ds": F.min("ds").over(series), "__cut": F.date_sub(F.max("ds").over(series), held_days)})
        .withColumn("last_ds", F.coalesce(F.max(F.when(F.col("ds") <= F.col("__cut"), F.col("ds"))).over(series), "__cut"))
        .drop("__cut")
        .withColumns(
            {
                "trend": F.array(*trend_features("ds", "first_ds", "last_ds")),
                "season": F.array(*season_features("ds")),
            }
        )
    )


def _matrices(pdf: pd.DataFrame):
    return (
        np.vstack(pdf["trend"].to_numpy()),
        np.vstack(pdf["season"].to_numpy()),
        pdf["y"].to_numpy(dtype=float),
    )


def _fitted(pdf: pd.DataFrame, kept: list[str], settings: dict[str, str]) -> pd.DataFrame:
    """The coefficient row of one series."""
    trend, season, y = _matrices(pdf)
    scale = max(float(np.abs(y).max()), 1e-12)
    a, b, fitted = solve_series(trend, season, y / scale, settings)
    row = pdf.iloc[:1][kept].copy()
    row["params"] = [settings]
    row["trend_coef"], row["season_coef"] = [a.tolist()], [b.tolist()]
    row["y_scale"], row["sigma"] = scale, scale * float(np.std(y / scale - fitted)) if len(y) > 1 else None
    row["first_ds"], row["last_ds"] = pdf["first_ds"].iloc[0], pdf["last_ds"].iloc[0]
    row["days"] = [sorted(pdf["ds"])]
    return row


def fit_regression(
    points: DataFrame, keys: Sequence[str] = (), params: dict[str, str] | None = None
) -> DataFrame:
    """Coefficient table: one row per series."""
    settings = {**DEFAULTS, **(params or {})}
    schema = T.StructType([points.schema[k] for k in keys] + _FIT_COLUMNS)
    kept = list(keys)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        return _fitted(pdf, kept, settings)

    return _with_features(points, keys).groupBy(*keys).applyInPandas(fit, schema)


def fit_trials(
    points: DataFrame, keys: Sequence[str], trials: list[dict[str, str]], trials_per_task: int = 5
) -> DataFrame:
    """Coefficient table of every series and trial, fitted on all days: the columns of ``fit_regression`` and ``trial``."""
    schema = T.StructType([points.schema[k] for k in keys] + [T.StructField("trial", T.IntegerType())] + _FIT_COLUMNS)
    kept = list(keys)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        first = int(pdf["block"].iloc[0]) * trials_per_task
        rows = []
        for number, params in list(enumerate(trials))[first : first + trials_per_task]:
            row = _fitted(pdf, kept, params)
            row.insert(len(kept), "trial", number)
            rows.append(row)
        return pd.concat(rows)

    groups = [*keys, "block"]
    return _with_features(_in_blocks(points, trials, trials_per_task), groups).groupBy(*groups).applyInPandas(fit, schema)


def _in_blocks(points: DataFrame, trials: list[dict[str, str]], trials_per_task: int) -> DataFrame:
    """Daily points once for every block of trials."""
    n_blocks = math.ceil(len(trials) / trials_per_task)
    return points.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))


def _dot(features: list[Column], coef: str) -> Column:
    """Sum of products, written out so that it stays in generated code."""
    return reduce(lambda a, b: a + b, [f * F.col(coef)[i] for i, f in enumerate(features)])


def predict_regression(
    model: DataFrame,
    keys: Sequence[str] = (),
    horizon: int = 14,
    include_history: bool = True,
    interval_width: float = 0.95,
    fill_gaps: bool = False,
    trend_variance: bool = False,
) -> DataFrame:
    """Forecast from a coefficient table without refitting, all inside Spark.

    With ``trend_variance`` the band widens ahead of the data by the slope
    changes that may come: as many a day as the trend had knots, each as large
    as they were on average. They add the rate times twice the squared mean
    change times a third of the cubed time ahead to the variance.
    """
    level = _dot(trend_features("ds", "first_ds", "last_ds"), "trend_coef")
    season = _dot(season_features("ds"), "season_coef")
    additive = F.col("params")["seasonality_mode"] == "additive"
    yhat = F.col("y_scale") * F.when(additive, level + season).otherwise(level * (1 + season))
    days = open_days(model, horizon, include_history, fill_gaps).withColumn("yhat", yhat)
    if trend_variance:
        span = F.greatest(F.datediff("last_ds", "first_ds"), F.lit(1))
        ahead = F.greatest(F.datediff("ds", "last_ds"), F.lit(0)) / span
        change = F.aggregate(F.slice("trend_coef", 3, KNOTS), F.lit(0.0), lambda s, c: s + F.abs(c)) / KNOTS
        coming = (KNOTS / KNOT_RANGE) * 2 * change * change * ahead * ahead * ahead / 3
        days = days.withColumn("sigma", F.sqrt(F.col("sigma") * F.col("sigma") + F.col("y_scale") * F.col("y_scale") * coming))
    return with_band(days, interval_width).select(*keys, "ds", "yhat", "yhat_lower", "yhat_upper")


def forecast_regression(
    points: DataFrame,
    keys: Sequence[str] = (),
    horizon: int = 14,
    include_history: bool = True,
    interval_width: float = 0.95,
    params: dict[str, str] | None = None,
) -> DataFrame:
    """Fit and forecast every series."""
    return predict_regression(fit_regression(points, keys, params), keys, horizon, include_history, interval_width)


def forecast_infer(
    coefficients: DataFrame,
    registry: DataFrame,
    keys: Sequence[str] = (),
    horizon: int = 14,
    stage: str = "Production",
    interval_width: float = 0.95,
) -> DataFrame:
    """Next ``horizon`` days from the stored coefficients of the newest version in ``stage``.

    ``coefficients`` is a coefficient table with model_name and version.
    """
    models = coefficients.join(_live(registry, stage), ["model_name", "version"], "left_semi")
    named = ["model_name", "version", *keys]
    return predict_regression(models, named, horizon, include_history=False, interval_width=interval_width)


def _live(registry: DataFrame, stage: str) -> DataFrame:
    """Newest version of each model in the stage."""
    return registry.filter(F.col("stage") == stage).groupBy("model_name").agg(F.max("version").alias("version"))


def require_models(coefficients: DataFrame, registry: DataFrame, stage: str = "Production") -> None:
    """Raise when the stage holds no version, or a live one has no stored coefficients."""
    live = _live(registry, stage)
    if live.isEmpty():
        raise ValueError(f"no model is in {stage}")
    lacking = live.join(coefficients, ["model_name", "version"], "left_anti").orderBy("model_name").limit(1).first()
    if lacking:
        raise ValueError(f"no stored model for version {lacking['version']} of {lacking['model_name']}")


# Ranges of the search.
_RANGES = {"changepoint_prior_scale": (0.01, 0.5), "seasonality_prior_scale": (0.01, 10.0), "holidays_prior_scale": (0.01, 10.0)}


def draw_trials(n_trials: int = 20, seed: int = 7) -> list[dict[str, str]]:
    """Seeded random draw from the search space, one parameter map per trial."""
    rng = random.Random(seed)

    def log_uniform(low: float, high: float) -> str:
        return repr(math.exp(rng.uniform(math.log(low), math.log(high))))

    return [
        {
            **DEFAULTS,
            **{name: log_uniform(low, high) for name, (low, high) in _RANGES.items()},
            "seasonality_mode": rng.choice(["additive", "multiplicative"]),
            "weekly_seasonality": rng.choice(["true", "false"]),
            "yearly_seasonality": rng.choice(["true", "false"]),
        }
        for _ in range(n_trials)
    ]


def tune(
    points: DataFrame,
    keys: Sequence[str] = (),
    trials: list[dict[str, str]] | None = None,
    horizon: int = 14,
    trials_per_task: int = 5,
) -> DataFrame:
    """Score every trial on a real holdout: (keys, trial, params, mape), one row per series and trial.

    A series without days on either side of the cut has no score: its mape is NULL.
    Daily points open into blocks of trials, so the blocks of one series run in
    parallel; features are computed after the shuffle and never travel.
    """
    trials = trials or draw_trials()
    kept = list(keys)

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        first = int(pdf["block"].iloc[0]) * trials_per_task
        return _scores(pdf, list(enumerate(trials))[first : first + trials_per_task], kept)

    groups = [*keys, "block"]
    featured = _with_features(_in_blocks(points, trials, trials_per_task), groups, tuning_days(horizon))
    return featured.groupBy(*groups).applyInPandas(score, _score_schema(points, keys))


def _score_schema(points: DataFrame, keys: Sequence[str]) -> T.StructType:
    return T.StructType(
        [points.schema[k] for k in keys]
        + [
            T.StructField("trial", T.IntegerType()),
            T.StructField("params", T.MapType(T.StringType(), T.StringType())),
            T.StructField("mape", T.DoubleType()),
        ]
    )


def _scores(pdf: pd.DataFrame, block: list[tuple[int, dict[str, str]]], kept: list[str]) -> pd.DataFrame:
    """Held-out scores of numbered settings on one series."""
    held = (pd.to_datetime(pdf["ds"]) > pd.to_datetime(pdf["last_ds"])).to_numpy()
    trend, season, y = _matrices(pdf)
    out = []
    for number, params in block:
        if held.all() or not held.any():
            out.append({**{k: pdf[k].iloc[0] for k in kept}, "trial": number, "params": params, "mape": None})
            continue
        scale = max(float(np.abs(y[~held]).max()), 1e-12)
        a, b, _ = solve_series(trend[~held], season[~held], y[~held] / scale, params)
        level, wave = trend[held] @ a, season[held] @ b
        yhat = scale * (level + wave if params["seasonality_mode"] == "additive" else level * (1 + wave))
        mape = float(np.mean(np.abs(y[held] - yhat) / np.maximum(y[held], 1.0)))
        out.append({**{k: pdf[k].iloc[0] for k in kept}, "trial": number, "params": params, "mape": mape})
    return pd.DataFrame(out, columns=[*kept, "trial", "params", "mape"])


def score_trials(points: DataFrame, keys: Sequence[str], trials: DataFrame, horizon: int = 14, trials_per_task: int = 4) -> DataFrame:
    """Score each series' own trials (keys, trial, params): the columns of ``tune``."""
    kept, groups = list(keys), [*keys, "block"]
    blocked = trials.withColumn("block", F.floor(F.col("trial") / trials_per_task).cast("int"))
    needed = blocked.select(*[F.col(c).alias(f"__{c}") for c in groups]).distinct()
    same = [points[k].eqNullSafe(needed[f"__{k}"]) for k in keys]
    opened = points.join(needed, same) if keys else points.join(needed, F.lit(True))
    opened = opened.select(*points.columns, F.col("__block").alias("block"))
    own = blocked.select(*groups, "trial", F.to_json("params").alias("settings"))

    def score(pdf: pd.DataFrame, mine: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame(columns=[*kept, "trial", "params", "mape"])
        block = [(int(n), json.loads(p)) for n, p in zip(mine["trial"], mine["settings"])]
        return _scores(pdf, block, kept)

    featured = _with_features(opened, groups, tuning_days(horizon))
    return featured.groupBy(*groups).cogroup(own.groupBy(*groups)).applyInPandas(score, _score_schema(points, keys))


def refined(best: DataFrame, keys: Sequence[str], turn: int, first_trial: int, seed: int = 7) -> DataFrame:
    """New settings near good ones: scales moved by a seeded factor that narrows with each turn, choices flipped now and then.

    ``best`` has keys, ``rank`` from 1 and ``params``; the draw depends on series, rank and turn alone.
    """

    def draw(name: Column, salt: int) -> Column:
        h = F.xxhash64(F.concat_ws("\x01", name, *[F.coalesce(F.col(k).cast("string"), F.lit("\x02")) for k in keys]), "rank", F.lit(turn), F.lit(seed + salt))
        return F.pmod(h, F.lit(1 << 20)) / (1 << 20)

    def moved(name: Column, value: Column) -> Column:
        factor = F.exp((2 * draw(name, 0) - 1) * (1.5 / turn))
        out = value
        for scale, (low, high) in _RANGES.items():
            out = F.when(name == scale, F.least(F.greatest(value.cast("double") * factor, F.lit(low)), F.lit(high)).cast("string")).otherwise(out)
        flip = draw(name, 1) < 0.15
        out = F.when((name == "seasonality_mode") & flip, F.when(value == "additive", "multiplicative").otherwise("additive")).otherwise(out)
        switch = name.isin("weekly_seasonality", "yearly_seasonality") & flip
        return F.when(switch, F.when(value == "true", "false").otherwise("true")).otherwise(out)

    trial = (F.col("rank") + (first_trial - 1)).cast("int").alias("trial")
    return best.select(*keys, trial, F.transform_values("params", moved).alias("params"))


def tune_adaptive(
    points: DataFrame, keys: Sequence[str] = (), n_trials: int = 20, keep: int = 4, horizon: int = 14, seed: int = 7
) -> DataFrame:
    """Search in turns: a random draw, then settings near the best ``keep`` of each series so far, ``n_trials`` fits in all.

    Returns the columns of ``tune`` and ``turn`` (0: the draw). Trials are rows, and a series has its own from turn 1 on. The turns
    come one after the other; inside a turn all series and trials are independent tasks.
    """
    turns = max(1, (2 * n_trials // 5) // keep)
    drawn = n_trials - turns * keep
    done = parked(tune(points, keys, draw_trials(drawn, seed), horizon).withColumn("turn", F.lit(0)), "turn")
    for turn in range(1, turns + 1):
        best = done.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("mape").asc_nulls_last(), "trial"))).filter(F.col("rank") <= keep)
        near = parked(refined(best, keys, turn, drawn + (turn - 1) * keep, seed), "near")
        scored = parked(score_trials(points, keys, near, horizon, keep).withColumn("turn", F.lit(turn)), "turn")
        done = done.unionByName(scored)
    return done
