"""Daily series, holidays, streaks and scores on hand-written rows."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from calltide.functions.holidays import HOLIDAY_NAMES, holiday_flags
from calltide.operators import anomaly, evaluate, forecast, holidays, models, series


def day(n: int) -> date:
    return date(2023, 12, 31) + timedelta(days=n)


def points(spark, values, key=None):
    rows = [(key, day(n), y) for n, y in values]
    return spark.createDataFrame(rows, "k string, ds date, y bigint")


def test_daily_counts_null_dimension_is_a_series(spark, rows):
    df = spark.createDataFrame(
        [("2024-01-01 23:59:59", "Noise"), ("2024-01-01 00:00:00", None), ("2024-01-01 01:00:00", None)],
        "t string, complaint_type string",
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = rows(series.daily_counts(df, "t", ["complaint_type"]))
    assert got == [(date(2024, 1, 1), "Noise", 1), (date(2024, 1, 1), None, 2)]


def test_lag_and_mean_count_rows(spark):
    df = points(spark, [(n, n) for n in (1, 2, 3, 4, 5, 6, 9, 20)])
    got = {r.y: r for r in series.add_moving_avg(series.add_lag(df, ["k"]), ["k"]).collect()}
    assert got[20].y_lag7 == 1 and got[9].y_lag7 is None
    assert got[1].y_ma7 == 1.0 and got[3].y_ma7 == 2.0
    assert got[20].y_ma7 == pytest.approx((2 + 3 + 4 + 5 + 6 + 9 + 20) / 7)


def test_calendar_features_count_days(spark):
    df = points(spark, [(n, n) for n in (1, 2, 8, 10)])
    got = {r.y: r for r in series.add_calendar_features(df, ["k"]).collect()}
    assert got[8].y_day_lag7 == 1 and got[10].y_day_lag7 is None
    assert got[8].y_day_ma7 == 5.0 and got[10].y_day_ma7 == 9.0


def test_spine_and_last_n(spark, rows):
    df = points(spark, [(1, 5), (4, 6)], "a")
    assert rows(series.date_spine(df, ["k"], 2)) == [("a", day(n)) for n in (1, 4, 5, 6)]
    assert rows(series.date_spine(df, ["k"], 2, fill_gaps=True)) == [("a", day(n)) for n in range(1, 7)]
    assert rows(series.date_spine(df, ["k"], 0)) == [("a", day(1)), ("a", day(4))]


def test_a_wrong_year_does_not_fill_the_calendar(spark):
    df = spark.createDataFrame([("a", date(2024, 1, 1), 1), ("a", date(2024, 1, 2), 1), ("a", date(9999, 6, 1), 1)], "k string, ds date, y long")
    assert series.date_spine(df, ["k"], 7).count() == 10
    assert forecast.forecast_trend_seasonal(df, ["k"], horizon=7).count() == 10
    filled = series.date_spine(df, ["k"], 7, fill_gaps=True)
    assert filled.count() == filled.distinct().count() == (date(9999, 6, 1) - date(2024, 1, 1)).days + 8


def test_last_n(spark, rows):
    df = points(spark, [(1, 5), (4, 6)], "a")
    assert rows(series.last_n(df, ["k"], 1)) == [("a", day(4), 6)]


def test_daily_counts_sum_to_rows(spark, sf_dir):
    from calltide.sources.requests import requests

    rows = requests(spark, sf_dir)
    assert series.daily_counts(rows, "created_date").agg(F.sum("y")).first()[0] == rows.count()


def test_holidays_of_known_years(spark):
    span = spark.createDataFrame([(date(2021, 5, 1),), (date(2023, 6, 1),)], "ds date")
    got = {(r.ds, r.holiday) for r in holidays.us_holidays(span).collect()}
    known = {
        (date(2021, 6, 18), "Juneteenth National Independence Day (observed)"),
        (date(2021, 12, 31), "New Year's Day (observed)"),
        (date(2022, 5, 30), "Memorial Day"),
        (date(2023, 1, 2), "New Year's Day (observed)"),
        (date(2023, 1, 16), "Martin Luther King Jr. Day"),
        (date(2023, 2, 20), "Washington's Birthday"),
        (date(2023, 9, 4), "Labor Day"),
        (date(2023, 10, 9), "Columbus Day"),
        (date(2023, 11, 10), "Veterans Day (observed)"),
        (date(2023, 11, 23), "Thanksgiving"),
    }
    assert known <= got
    assert all(date(2021, 1, 1) <= d <= date(2023, 12, 31) for d, _ in got)


def test_holiday_flags_agree_with_the_calendar(spark):
    span = spark.createDataFrame([(date(1985, 1, 1),), (date(2033, 12, 31),)], "ds date")
    days = series.date_spine(span.withColumn("y", F.lit(1)), horizon=0, fill_gaps=True)
    flagged = days.select("ds", F.array(*holiday_flags(F.col("ds"))).alias("f")).collect()
    assert all(len(r.f) == len(HOLIDAY_NAMES) for r in flagged)
    from_flags = {r.ds for r in flagged if sum(r.f) > 0}
    assert from_flags == {r.ds for r in holidays.us_holidays(span).collect()}


def test_join_holidays_keeps_every_day(spark):
    df = points(spark, [(n, 1) for n in range(1, 5)])
    got = {r.ds: r.holiday for r in holidays.join_holidays(df, holidays.us_holidays(df)).collect()}
    assert got == {day(1): "New Year's Day", day(2): None, day(3): None, day(4): None}


# anomalies


def flagged(spark, breaches, days, key="a", unbounded=()):
    rows = [
        (key, day(n), 10 if n in breaches else 1, None if n in unbounded else 5.0) for n in days
    ]
    return anomaly.flag_breaches(spark.createDataFrame(rows, "k string, ds date, y bigint, yhat_upper double"))


def streaks(df):
    return {(r.ds - date(2023, 12, 31)).days: (r.anomaly_streak, r.alert) for r in df.collect()}


def test_equal_to_bound_is_no_breach_and_no_bound_is_null(spark):
    df = spark.createDataFrame([(5, 5.0), (6, 5.0), (6, None)], "y int, yhat_upper double")
    assert [r.is_anomaly for r in anomaly.flag_breaches(df).collect()] == [False, True, None]


def test_cumulative_and_consecutive_differ(spark):
    df = flagged(spark, {1, 3, 5, 6}, range(1, 7))
    cumulative = streaks(anomaly.breach_cumulative(df, ["k"]))
    run = streaks(anomaly.breach_streak(df, ["k"]))
    assert cumulative[6] == (4, True)
    assert run == {1: (1, False), 2: (0, False), 3: (1, False), 4: (0, False), 5: (1, False), 6: (2, False)}


def test_missing_day_or_missing_bound_breaks_a_run(spark):
    gap = streaks(anomaly.breach_streak(flagged(spark, {1, 2, 4, 5}, [1, 2, 4, 5]), ["k"]))
    assert gap == {1: (1, False), 2: (2, False), 4: (1, False), 5: (2, False)}
    no_bound = streaks(anomaly.breach_streak(flagged(spark, {1, 2, 3, 4}, range(1, 5), unbounded={3}), ["k"]))
    assert no_bound[4] == (1, False) and no_bound[3] == (0, False)


def test_run_at_the_end_alerts_per_series(spark):
    both = flagged(spark, {3, 4, 5}, range(1, 6), "a").unionByName(flagged(spark, {1}, range(1, 6), None))
    got = {(r.k, r.ds): r.alert for r in anomaly.breach_streak(both, ["k"]).collect()}
    assert got[("a", day(5))] and not got[("a", day(4))] and not got[(None, day(5))]


def test_streak_never_exceeds_cumulative(spark):
    df = flagged(spark, {n for n in range(1, 200) if n * n % 7 < 3}, [n for n in range(1, 200) if n % 11])
    run, cumulative = streaks(anomaly.breach_streak(df, ["k"])), streaks(anomaly.breach_cumulative(df, ["k"]))
    assert all(run[n][0] <= cumulative[n][0] for n in run)


def test_false_positive_rate(spark):
    df = spark.createDataFrame(
        [(True, True), (True, False), (False, None), (None, False), (True, None)], "is_anomaly boolean, incident boolean"
    )
    r = anomaly.false_positive_rate(df, "incident").first()
    assert (r.false_positives, r.negatives, r.false_positive_rate) == (2, 4, 0.5)
    none = anomaly.false_positive_rate(df.filter("incident"), "incident").first()
    assert none.false_positive_rate is None


# forecasts and scores


def test_forecast_recovers_line_and_weekdays(spark):
    start = date(2023, 1, 1)
    rows = [(start + timedelta(days=i), 100 + (i % 7) * 10) for i in range(60)]
    df = spark.createDataFrame(rows, "ds date, y bigint")
    got = {r.ds: r for r in forecast.forecast_trend_seasonal(df, horizon=7).collect()}
    assert len(got) == 67
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in got.values())
    for i in range(60, 67):
        assert got[start + timedelta(days=i)].yhat == pytest.approx(100 + (i % 7) * 10, abs=4)
    future = forecast.forecast_trend_seasonal(df, horizon=7, include_history=False)
    assert future.count() == 7
    assert dict(future.dtypes)["ds"] == "date"


def test_single_day_series_has_no_band(spark):
    r = forecast.forecast_trend_seasonal(points(spark, [(1, 7)], "a"), ["k"], horizon=1).collect()
    assert [x.yhat for x in r] == [7.0, 7.0] and all(x.yhat_upper is None for x in r)


def test_actual_vs_forecast_keeps_days_without_bound(spark):
    actual = points(spark, [(1, 5), (2, 5)], None)
    predicted = spark.createDataFrame([(None, day(1), 6.0)], "k string, ds date, yhat_upper double")
    got = {r.ds: r.yhat_upper for r in anomaly.actual_vs_forecast(actual, predicted, ["k"]).collect()}
    assert got == {day(1): 6.0, day(2): None}


def test_mape_floors_the_actual_and_takes_the_tail(spark):
    actual = points(spark, [(1, 100), (2, 0), (3, 4)], "a")
    predicted = spark.createDataFrame([("a", day(n), 2.0) for n in (1, 2, 3, 4)], "k string, ds date, yhat double")
    r = evaluate.mape_tail(predicted, actual, ["k"], days=2).first()
    assert (r.scored_days, r.mape) == (2, (2.0 + 0.5) / 2)
    short = evaluate.mape_tail(predicted, actual, ["k"], days=2, more_than=28).first()
    assert short.mape is None
    assert evaluate.tuning_days(14) == 14 and evaluate.tuning_days(60) == 28


def test_backtest_does_not_see_the_future(spark):
    steady = [(n, 10) for n in range(1, 61)]
    jump = steady + [(n, 1000) for n in range(61, 75)]
    scores = evaluate.backtest(points(spark, jump, "a"), ["k"], test_days=14).first()
    assert scores.mae == pytest.approx(990.0) and scores.scored_days == 14
    origins = evaluate.rolling_origin_backtest(points(spark, jump, "a"), ["k"], origins=2, test_days=14)
    by_cutoff = {r.cutoff: r.mae for r in origins.collect()}
    assert by_cutoff[day(60)] == pytest.approx(990.0) and by_cutoff[day(46)] == pytest.approx(0.0, abs=1e-9)


def test_require_rows(spark):
    df = spark.range(1)
    assert forecast.require_rows(df) is df
    with pytest.raises(ValueError):
        forecast.require_rows(df.limit(0))


# model versions


def registry(spark, rows):
    return spark.createDataFrame(
        [("m", v, {}, mape, stage) for v, mape, stage in rows],
        "model_name string, version bigint, params map<string,string>, mape string, stage string",
    )


def test_best_version_skips_bad_tags_and_breaks_ties_low(spark):
    df = registry(spark, [(1, "", "None"), (2, "oops", "None"), (3, "nan", "None"), (5, "0.1", "None"), (4, "0.1", "None")])
    assert tuple(models.best_version(df).first()) == ("m", 4, 0.1)
    assert models.best_version(registry(spark, [(1, None, "None")])).isEmpty()


@pytest.mark.parametrize(
    "staged, promoted",
    [(None, True), ("0.5", True), ("0.2", False), ("0.1", False), ("oops", True)],
)
def test_promotion(spark, staged, promoted):
    rows = [(1, "0.2", "None"), (2, "0.3", "Production")] + ([(3, staged, "Staging")] if staged else [])
    df = registry(spark, rows)
    decision = models.promote_if_better(df).first()
    assert decision.promoted is promoted
    assert decision.best_version == (3 if staged == "0.1" else 1)
    after = {r.version: r.stage for r in models.apply_promotions(df).collect()}
    assert after[1] == ("Staging" if promoted else "None")
    assert after.get(3, "Staging") == "Staging"


def test_newest_staging_version_counts(spark):
    df = registry(spark, [(1, "0.9", "Staging"), (2, "0.1", "Staging"), (3, "0.5", "None")])
    d = models.promote_if_better(df).first()
    assert (d.stage_version, d.stage_mape, d.promoted) == (2, 0.1, False)


def test_register_runs_continues_versions(spark):
    df = registry(spark, [(7, "0.2", "None")])
    runs = spark.createDataFrame([("m", 1, 0.5), ("m", 0, 0.4), ("new", 0, 0.3)], "model_name string, trial int, mape double")
    added = models.register_runs(df, runs.withColumn("params", F.create_map(F.lit("a"), F.lit("b"))))
    assert {(r.model_name, r.version, r.mape, r.stage) for r in added.collect()} == {
        ("m", 8, "0.4", "None"),
        ("m", 9, "0.5", "None"),
        ("new", 1, "0.3", "None"),
    }
    changed = spark.createDataFrame([("m", 7, "Production"), ("m", 99, "Staging")], "model_name string, version bigint, stage string")
    assert [(r.version, r.stage) for r in models.set_stage(df, changed).collect()] == [(7, "Production")]
