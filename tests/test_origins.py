"""Backtests of the regression from running sums against a fit per origin."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from calltide.operators import origins, regression
from calltide.operators.evaluate import forecast_metrics, scored_days


def points(spark, seed=1, n=420):
    rng = np.random.default_rng(seed)
    rows = []
    for k in ("a", None):
        for i in range(n):
            if rng.random() < 0.85:
                rows.append((k, date(2022, 1, 3) + timedelta(days=i), float(20 + 0.03 * i + 5 * (i % 7 == 2) + rng.normal())))
    rows += [("one", date(2022, 1, 3), 4.0), ("short", date(2022, 1, 3), 4.0), ("short", date(2022, 1, 9), 5.0)]
    return spark.createDataFrame(rows, "k string, ds date, y double")


@pytest.mark.parametrize(("train_days", "settings"), [(90, {}), (None, {}), (200, {"yearly_seasonality": "false", "changepoint_prior_scale": "0.5"}), (None, {"changepoint_prior": "laplace"})])
def test_equals_a_fit_per_origin(spark, train_days, settings):
    rows = points(spark)
    got = origins.origin_forecasts(rows, ["k"], 3, 20, train_days, 14, settings).collect()
    mine = {(r.k, r.cutoff, r.ds): r.yhat for r in got}
    assert len({r.cutoff for r in got if r.k == "a"}) == 3
    wanted, near = 0, 1e-6 if settings.get("changepoint_prior") else 1e-8
    for cutoff in sorted({r.cutoff for r in got}):
        own = rows.filter(F.col("ds") <= F.lit(cutoff)).filter("k IS NULL OR k = 'a'")
        if train_days:
            own = own.filter(F.col("ds") > F.lit(cutoff - timedelta(days=train_days)))
        for r in regression.forecast_regression(own, ["k"], 40, False, params=settings).collect():
            if (r.k, cutoff, r.ds) in mine:
                wanted += 1
                assert mine[r.k, cutoff, r.ds] == pytest.approx(r.yhat, rel=near, abs=near)
    assert wanted == sum(r.k in ("a", None) for r in got)


def test_scores_are_those_of_the_forecasts(spark):
    rows = points(spark)
    held = origins.origin_forecasts(rows, ["k"], 1, 28, None, 28)
    plain = lambda df: sorted((tuple(v if not isinstance(v, float) else round(v, 9) for v in r) for r in df.collect()), key=str)
    assert plain(origins.backtest_regression(rows, ["k"])) == plain(forecast_metrics(scored_days(held, rows, ["k"]), ["k"]))
    assert {r.k for r in held.select("k").distinct().collect()} == {"a", None}  # the others have no days before


def test_multiplicative_form_is_refused(spark):
    with pytest.raises(ValueError, match="additive"):
        origins.origin_forecasts(points(spark), ["k"], params={"seasonality_mode": "multiplicative"})


def test_unpenalised_form_is_least_squares(spark):
    rng = np.random.default_rng(3)
    days = [date(2022, 1, 3) + timedelta(days=i) for i in range(100)]
    y = rng.normal(10, 2, 100)
    rows = spark.createDataFrame(list(zip(days, map(float, y))), "ds date, y double")
    got = [r.yhat for r in regression.forecast_regression(rows, (), 0, params=regression.unpenalised()).orderBy("ds").collect()]
    x = np.column_stack([np.arange(100), *(np.array([d.weekday() == w for d in days], float) for w in range(7))])
    assert got == pytest.approx(list(x @ np.linalg.lstsq(x, y, rcond=None)[0]), abs=1e-9)


@pytest.mark.parametrize(("mode", "scale"), [("additive", "0.5"), ("multiplicative", "0.005")])
def test_a_single_break_is_one_knot(spark, mode, scale):
    """The slope changes once, at a knot: the sparse prior finds that knot, the normal one spreads it."""
    rng = np.random.default_rng(8)
    n, knot = 521, 12
    at = regression.KNOT_RANGE * (knot + 1) / (regression.KNOTS + 1) * (n - 1)
    rows = [
        (date(2022, 1, 3) + timedelta(days=i), float((50 + 0.02 * i + 0.4 * max(i - at, 0)) * (1 + 0.1 * (i % 7 == 3)) + rng.normal(0, 0.3)))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "ds date, y double")
    base = {"changepoint_prior_scale": scale, "seasonality_mode": mode, "yearly_seasonality": "false"}
    hinges = {
        prior: np.abs(regression.fit_regression(df, (), {**base, "changepoint_prior": prior}).first().trend_coef[2:]) for prior in ("normal", "laplace")
    }
    sparse = hinges["laplace"]
    assert sparse.argmax() in (knot - 1, knot, knot + 1)
    near = sparse[knot - 1 : knot + 2].sum()
    assert near > 0.95 * sparse.sum() and np.delete(sparse, [knot - 1, knot, knot + 1]).max() < 0.03 * near
    spread = hinges["normal"]
    assert spread[knot - 1 : knot + 2].sum() < 0.8 * spread.sum()
