"""Drift of values between days."""

from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from calltide.operators import quality


def test_a_planted_shift_is_found(spark):
    """Equal counts and NULL rates, one column shifted on one day, another one spread out on another day."""
    rng = np.random.default_rng(2)
    rows = []
    for day in range(40):
        for i in range(400):
            x = float(rng.normal() + (0.8 if day == 33 else 0))
            y = float(rng.normal() * (3 if day == 36 else 1)) if i % 10 else None
            rows.append((datetime(2024, 1, 1) + timedelta(days=day, seconds=i), x, y, 0))
    df = spark.createDataFrame(rows, "ts timestamp_ntz, x double, y double, zero int")
    found = quality.value_drift(df, "ts", ["x", "y", "zero"], sketch_size=200).collect()
    days = {(r.column, (r.ds - datetime(2024, 1, 1).date()).days) for r in found if r.drifted}
    assert days == {("x", 33), ("y", 36)}
    assert {r.records for r in found if r.column == "y"} == {360} and {r.distance for r in found if r.column == "zero"} == {None, 0.0}
    report = quality.drift_report(df, "ts", "y")
    assert report.filter("drifted").count() == 0


def test_days_without_values(spark):
    rows = [(datetime(2024, 1, d), v) for d in range(1, 5) for v in ((None, float("nan")) if d == 3 else (1.0, 2.0))]
    found = {r.ds.day: r for r in quality.value_drift(spark.createDataFrame(rows, "ts timestamp_ntz, v double"), "ts", ["v"]).collect()}
    assert found[1].drifted is None and found[3].drifted is None and found[3].records == 0
    assert found[4].reference == 4 and found[4].distance == 0 and found[4].drifted is False
    assert quality.value_drift(spark.createDataFrame([], "ts timestamp_ntz, v double"), "ts", ["v"]).count() == 0


def test_values_are_combined_before_the_only_shuffle(spark):
    df = spark.range(1000).select(F.lit(datetime(2024, 1, 1)).alias("ts"), F.col("id").cast("double").alias("v"))
    text = quality.value_drift(df, "ts", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_kll_sketch_agg_double" in text.split("Exchange")[-1]
