"""Search in turns against the random draw of as many fits."""

from datetime import date, timedelta

import numpy as np
from pyspark.sql import functions as F

from calltide.operators import regression


def series(spark, n=12, days=260):
    rng = np.random.default_rng(11)
    rows = []
    for s in range(n):
        slope, season = rng.normal(0, 0.05), rng.uniform(0, 0.3)
        for d in range(days):
            level = 40 + slope * d + (0.3 * (d - 150) if s % 3 == 0 and d > 150 else 0)
            rows.append((f"s{s}" if s else None, date(2023, 1, 2) + timedelta(days=d), float(max(level * (1 + season * np.sin(d % 7)) + rng.normal(0, 2), 0))))
    return spark.createDataFrame(rows, "k string, ds date, y double")


def test_adaptive_search_beats_the_draw_on_most_series(spark):
    points = series(spark)
    adaptive = regression.tune_adaptive(points, ["k"]).cache()
    assert adaptive.groupBy("k").count().filter("count = 20").count() == 12
    assert {tuple(r) for r in adaptive.groupBy("turn").agg(F.count("*") / 12).collect()} == {(0, 12.0), (1, 4.0), (2, 4.0)}
    best = lambda df: {r.k: r.m for r in df.groupBy("k").agg(F.min("mape").alias("m")).collect()}
    mine, other = best(adaptive), best(regression.tune(points, ["k"], regression.draw_trials(20)))
    assert sum(mine[k] < other[k] for k in mine) > 6
    low, high = regression._RANGES["changepoint_prior_scale"]
    scales = [float(r.p) for r in adaptive.select(F.col("params")["changepoint_prior_scale"].alias("p")).collect()]
    assert all(low <= x <= high for x in scales) and len(set(scales)) > 60


def test_own_trials_score_like_shared_ones(spark):
    points = series(spark, 3, 120)
    trials = regression.draw_trials(5)
    rows = [(k, i, t) for k in ("s1", "s2", None) for i, t in enumerate(trials)]
    own = spark.createDataFrame(rows, "k string, trial int, params map<string,string>")
    as_rows = lambda df: sorted((str(r.k), r.trial, round(r.mape, 9)) for r in df.collect())
    assert as_rows(regression.score_trials(points, ["k"], own, trials_per_task=2)) == as_rows(regression.tune(points, ["k"], trials))


def test_no_keys_and_short_series(spark):
    points = series(spark, 1, 90).drop("k")
    assert regression.tune_adaptive(points, (), 10, 2).filter("mape IS NOT NULL").count() == 10
    short = series(spark, 1, 5)
    assert regression.tune_adaptive(short, ["k"], 5, 1).filter("mape IS NULL").count() == 5
