"""Regression forecast on planted series. Accuracy, not equality with another solver, is the contract."""

import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from calltide.operators import regression

START = date(2021, 1, 1)
DAYS = 730


def planted(kind: str, noise: float, seed: int = 3):
    rng = random.Random(seed)
    values = []
    for i in range(DAYS):
        d = START + timedelta(days=i)
        level = 200 + 0.1 * i + (40 if i > 300 else 0)
        wave = 0.15 * math.sin(2 * math.pi * d.weekday() / 7) + 0.1 * math.cos(2 * math.pi * i / 365.25)
        y = level * (1 + wave) if kind == "multiplicative" else level + 200 * wave
        if d.month == 12 and d.day == 25:
            y -= 80
        values.append((kind, d, y + rng.gauss(0, noise)))
    return values


@pytest.fixture(scope="module")
def series(spark):
    rows = planted("additive", 3.0) + planted("multiplicative", 3.0)
    return spark.createDataFrame(rows, "k string, ds date, y double").cache()


def test_holdout_accuracy_and_contract(spark, series):
    cut = START + timedelta(days=DAYS - 28)
    df = regression.forecast_regression(series.filter(F.col("ds") < F.lit(cut)), ["k"], horizon=28)
    assert df.columns == ["k", "ds", "yhat", "yhat_lower", "yhat_upper"]
    assert dict(df.dtypes)["ds"] == "date"
    assert df.count() == 2 * DAYS
    scored = df.join(series, ["k", "ds"]).filter(F.col("ds") >= F.lit(cut))
    mape = {r.k: r.m for r in scored.groupBy("k").agg(F.avg(F.abs(F.col("y") - F.col("yhat")) / F.col("y")).alias("m")).collect()}
    assert mape["additive"] < 0.05 and mape["multiplicative"] < 0.1


def test_band_covers_its_share(spark, series):
    df = regression.forecast_regression(series.filter("k = 'additive'"), ["k"], horizon=7, interval_width=0.9)
    inside = df.join(series, ["k", "ds"]).agg(
        F.avg(F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("double"))
    )
    assert inside.first()[0] == pytest.approx(0.9, abs=0.05)


def test_holiday_effect_is_recovered(spark, series):
    df = regression.forecast_regression(series.filter("k = 'additive'"), ["k"], horizon=7)
    got = {r.ds: r.yhat for r in df.collect()}
    assert got[date(2022, 12, 24)] - got[date(2022, 12, 25)] > 40


def test_multiplicative_mode_fits_better_when_true(spark, series):
    multiplicative = series.filter("k = 'multiplicative'")

    def sigma(mode):
        return regression.fit_regression(multiplicative, ["k"], {"seasonality_mode": mode}).first().sigma

    assert sigma("multiplicative") < sigma("additive")


def test_spark_forecast_equals_numpy_fit(spark, series):
    one = series.filter("k = 'additive'").drop("k")
    model = regression.fit_regression(one)
    predicted = {r.ds: r.yhat for r in regression.predict_regression(model, horizon=1).collect()}
    pdf = regression._with_features(one, []).toPandas().sort_values("ds")
    trend, season, y = regression._matrices(pdf)
    _, _, fitted = regression.solve_series(trend, season, y / np.abs(y).max(), regression.DEFAULTS)
    assert np.allclose([predicted[d] for d in pdf["ds"]], fitted * np.abs(y).max())


def test_seasons_can_be_switched_off(spark, series):
    flat = regression.fit_regression(
        series.filter("k = 'additive'"), ["k"], {"weekly_seasonality": "false", "yearly_seasonality": "false"}
    ).first()
    assert all(abs(c) < 1e-12 for c in flat.season_coef[:26])


def test_tuning_contract(spark, series):
    trials = regression.draw_trials(20, seed=1)
    assert trials == regression.draw_trials(20, seed=1)
    for t in trials:
        assert 0.01 <= float(t["changepoint_prior_scale"]) <= 0.5
        assert 0.01 <= float(t["holidays_prior_scale"]) <= 10
    got = regression.tune(series, ["k"], trials, horizon=14).collect()
    assert {(r.k, r.trial) for r in got} == {(k, t) for k in ("additive", "multiplicative") for t in range(20)}
    assert all(r.params == trials[r.trial] and r.mape >= 0 for r in got)
    best = min((r for r in got if r.k == "additive"), key=lambda r: r.mape)
    assert best.mape < 0.05 and best.params["weekly_seasonality"] == "true"


def test_tune_scores_do_not_depend_on_blocks(spark, series):
    trials = regression.draw_trials(6)
    one = {(r.k, r.trial): round(r.mape, 9) for r in regression.tune(series, ["k"], trials, trials_per_task=6).collect()}
    six = {(r.k, r.trial): round(r.mape, 9) for r in regression.tune(series, ["k"], trials, trials_per_task=1).collect()}
    assert one == six


def test_inference_uses_the_newest_production_version(spark, series):
    fit = regression.fit_regression(series, ["k"]).withColumn("model_name", F.col("k"))
    coefficients = fit.withColumn("version", F.explode(F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))))
    registry = spark.createDataFrame(
        [("additive", 1, "Production"), ("additive", 2, "Staging"), ("multiplicative", 2, "None")],
        "model_name string, version bigint, stage string",
    )
    got = regression.forecast_infer(coefficients, registry, ["k"], horizon=14).collect()
    assert len(got) == 14
    assert {(r.model_name, r.version) for r in got} == {("additive", 1)}
    assert min(r.ds for r in got) == START + timedelta(days=DAYS)


def test_short_and_null_series(spark):
    rows = [("one", START, 5.0), (None, START, 1.0), (None, START + timedelta(days=1), 2.0)]
    df = regression.forecast_regression(spark.createDataFrame(rows, "k string, ds date, y double"), ["k"], horizon=7)
    assert {(r.k, r.n) for r in df.groupBy("k").agg(F.count("yhat").alias("n")).collect()} == {("one", 8), (None, 9)}


def test_tune_equals_a_direct_holdout_score(spark, series):
    one = series.filter("k = 'additive'").drop("k")
    trials = regression.draw_trials(4, seed=5)
    got = {r.trial: r.mape for r in regression.tune(one, trials=trials, horizon=14).collect()}
    pdf = regression._with_features(one, [], 14).toPandas().sort_values("ds")
    trend, season, y = regression._matrices(pdf)
    for number, params in enumerate(trials):
        scale = np.abs(y[:-14]).max()
        a, b, _ = regression.solve_series(trend[:-14], season[:-14], y[:-14] / scale, params)
        level, wave = trend[-14:] @ a, season[-14:] @ b
        yhat = scale * (level + wave if params["seasonality_mode"] == "additive" else level * (1 + wave))
        assert got[number] == pytest.approx(float(np.mean(np.abs(y[-14:] - yhat) / np.maximum(y[-14:], 1))), rel=1e-6)


def test_tune_gives_series_without_training_days_no_score(spark, series):
    short = spark.createDataFrame([("short", START, 5.0)], "k string, ds date, y double")
    got = regression.tune(series.filter("k = 'additive'").unionByName(short), ["k"], regression.draw_trials(2))
    scores = {(r.k, r.trial): r.mape for r in got.collect()}
    assert set(scores) == {(k, t) for k in ("additive", "short") for t in (0, 1)}
    assert all((v is None) == (k == "short") for (k, _), v in scores.items())
