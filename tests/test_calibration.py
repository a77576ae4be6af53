"""Bands from held-out residuals."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from calltide.operators import evaluate, forecast, regression
from calltide.plans import jobs
from calltide.sources import layers
from calltide.params import Params

FIRST = date(2023, 1, 2)


def noisy(spark, series=150, days=174, seed=5):
    rng = np.random.default_rng(seed)
    rows = [
        (f"s{s}" if s else None, FIRST + timedelta(days=d), float(50 + 0.1 * d + 8 * (d % 7 == 3) + (rng.standard_t(4) if s % 2 else rng.normal()) * (1 + s % 5)))
        for s in range(series)
        for d in range(days)
    ]
    return spark.createDataFrame(rows, "k string, ds date, y double")


def test_coverage_is_nominal_and_false_alarms_are_few(spark):
    rows = noisy(spark)
    cut = FIRST + timedelta(days=159)
    known, ahead = rows.filter(F.col("ds") <= F.lit(cut)), rows.filter(F.col("ds") > F.lit(cut))
    held = layers.parked(evaluate.rolling_origin_forecasts(known, ["k"], 6, 14, 70, 14), "held")
    plain = forecast.forecast_trend_seasonal(known.filter(F.col("ds") > F.lit(cut - timedelta(days=70))), ["k"], 14)
    for width in (0.8, 0.9, 0.95):
        banded = evaluate.calibrated_band(plain, held, ["k"], width)
        met = banded.withColumnRenamed("k", "j").join(ahead, F.col("j").eqNullSafe(F.col("k")) & (banded["ds"] == ahead["ds"]))
        found = met.agg(F.avg(F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("int")), F.avg((F.col("y") > F.col("yhat_upper")).cast("int")), F.count("*")).first()
        assert found[2] == 150 * 14 and width - 0.02 <= found[0] <= width + 0.025
        assert width < 0.9 or found[1] < 0.05
    same = banded.filter(F.col("ds") <= F.lit(cut)).exceptAll(plain.filter(F.col("ds") <= F.lit(cut))).count()
    assert same == 0  # observed days keep their band


def test_ranks_and_blocks(spark):
    day = lambda n: FIRST + timedelta(days=n)
    rows = [("a", day(0), day(1 + i % 7), 10.0, 10.0 + e) for i, e in enumerate(range(1, 20))] + [("a", day(0), day(9), 10.0, 30.0)]
    rows += [("b", day(0), day(1), 1.0, 4.0)]
    held = spark.createDataFrame(rows, "k string, cutoff date, ds date, y double, yhat double")
    got = {(r.k, r.block): (r.half, r.last_ds) for r in evaluate.conformal_widths(held, ["k"], 0.95).collect()}
    assert got == {("a", 0): (19.0, day(9)), ("a", 1): (20.0, day(9)), ("b", 0): (3.0, day(1))}
    got = {(r.k, r.block): r.half for r in evaluate.conformal_widths(held, ["k"], 0.5).collect()}
    assert got[("a", 0)] == 10.0 and got[("a", 1)] == 20.0
    plain = spark.createDataFrame([("a", day(n), 0.0, -1.0, 1.0) for n in (9, 10, 16, 17, 99)] + [("c", day(9), 0.0, -1.0, 1.0)], "k string, ds date, yhat double, yhat_lower double, yhat_upper double")
    upper = {(r.k, r.ds): r.yhat_upper for r in evaluate.calibrated_band(plain, held, ["k"], 0.5).collect()}
    assert upper == {("a", day(9)): 1.0, ("a", day(10)): 10.0, ("a", day(16)): 10.0, ("a", day(17)): 20.0, ("a", day(99)): 20.0, ("c", day(9)): 1.0}


def test_slope_changes_widen_the_band(spark):
    rng = np.random.default_rng(1)
    rows = [(FIRST + timedelta(days=d), float(100 + (d if d < 150 else 300 - d) + rng.normal())) for d in range(300)]
    fitted = regression.fit_regression(spark.createDataFrame(rows, "ds date, y double"))
    widths = [
        [r.yhat_upper - r.yhat for r in regression.predict_regression(fitted, (), 60, False, trend_variance=t).orderBy("ds").collect()] for t in (False, True)
    ]
    assert len(set(np.round(widths[0], 9))) == 1 and all(a < b for a, b in zip(widths[1], widths[1][1:]))
    assert widths[1][0] == pytest.approx(widths[0][0], rel=0.01) and widths[1][-1] > 1.2 * widths[0][-1]


@pytest.mark.parametrize("method", ["trend", "regression"])
def test_job_stores_a_calibrated_band(spark, tmp_path, method):
    where = jobs.Layers(str(tmp_path))
    daily = noisy(spark, 2, 160).select("ds", F.col("k").alias("borough"), F.col("y").cast("long").alias("y"))
    layers.overwrite_layer(daily, where.gold)
    plain, banded = [
        {(r.borough, r.ds): r for r in jobs.forecast_job(spark, where, ["borough"], Params(), method, calibrated=c).collect()} for c in (False, True)
    ]
    assert plain.keys() == banded.keys()
    last = FIRST + timedelta(days=159)
    for key, r in plain.items():
        assert banded[key].yhat == pytest.approx(r.yhat)
        assert (key[1] <= last) == (banded[key].yhat_upper == pytest.approx(r.yhat_upper, rel=1e-9))
