"""Queries on daily series, holidays, forecasts, scores and anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from calltide.operators import anomaly, evaluate, forecast, holidays, origins, regression, series
from calltide.plans.registry import (
    BOROUGHS,
    DAILY,
    PAIRS,
    REQ,
    TOTAL,
    fit_sql,
    forecast_sql,
    ols_ahead_sql,
    ols_sql,
    query,
    rounded,
    with_sql,
)
from calltide.sources.requests import requests, table

KEYS = list(series.DAILY_KEYS)
PAIR = ["complaint_type", "borough"]
Z95 = forecast.band_z(0.95)
Z50 = forecast.band_z(0.5)
BAND = ["yhat", "yhat_lower", "yhat_upper"]


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.daily_counts(requests(spark, sf_dir), "created_date")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series per complaint type and borough."""
    return series.series_total(daily(spark, sf_dir), PAIR)


def total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.series_total(daily(spark, sf_dir))


@query(with_sql(REQ, DAILY, select="SELECT * FROM daily"))
def daily_counts(spark, sf_dir):
    return daily(spark, sf_dir)


@query(with_sql(REQ, DAILY, TOTAL, select="SELECT * FROM total"))
def series_total(spark, sf_dir):
    return total(spark, sf_dir)


BY_DAY = "OVER (PARTITION BY complaint_type, borough, agency ORDER BY ds"


@query(with_sql(REQ, DAILY, select=f"SELECT *, lag(y, 7) {BY_DAY}) AS y_lag7 FROM daily"))
def add_lag(spark, sf_dir):
    return series.add_lag(daily(spark, sf_dir))


@query(
    with_sql(
        REQ,
        DAILY,
        select=f"SELECT *, round(avg(y) {BY_DAY} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS y_ma7 FROM daily",
    )
)
def add_moving_avg(spark, sf_dir):
    return rounded(series.add_moving_avg(daily(spark, sf_dir)), ["y_ma7"])


GOLD = f"""gold AS (
  SELECT *, lag(y, 7) {BY_DAY}) AS y_lag7,
         round(avg(y) {BY_DAY} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS y_ma7 FROM daily
)"""


@query(with_sql(REQ, DAILY, GOLD, select="SELECT * FROM gold"))
def gold_features(spark, sf_dir):
    return rounded(series.gold_features(requests(spark, sf_dir), "created_date"), ["y_ma7"])


@query(
    with_sql(
        REQ,
        DAILY,
        PAIRS,
        select="""
SELECT a.*, b.y AS y_day_lag7,
       round((SELECT avg(c.y) FROM pairs c WHERE c.complaint_type = a.complaint_type AND c.borough = a.borough
              AND c.ds BETWEEN a.ds - 6 AND a.ds), 6) AS y_day_ma7
FROM pairs a LEFT JOIN pairs b
  ON a.complaint_type = b.complaint_type AND a.borough = b.borough AND b.ds = a.ds - 7
""",
    )
)
def add_calendar_features(spark, sf_dir):
    return rounded(series.add_calendar_features(pairs(spark, sf_dir), PAIR), ["y_day_ma7"])


SPINE_AHEAD = """SELECT complaint_type, borough, CAST(t AS DATE) AS ds FROM (
  SELECT complaint_type, borough, unnest(generate_series(CAST({first} AS TIMESTAMP),
         CAST(max(ds) + 14 AS TIMESTAMP), INTERVAL 1 DAY)) AS t FROM pairs GROUP BY complaint_type, borough)"""


@query(with_sql(REQ, DAILY, PAIRS, select=SPINE_AHEAD.format(first="min(ds)")))
def date_spine_filled(spark, sf_dir):
    return series.date_spine(pairs(spark, sf_dir), PAIR, horizon=14, fill_gaps=True)


@query(
    with_sql(
        REQ,
        DAILY,
        PAIRS,
        select="SELECT complaint_type, borough, ds FROM pairs UNION ALL " + SPINE_AHEAD.format(first="max(ds) + 1"),
    )
)
def date_spine(spark, sf_dir):
    return series.date_spine(pairs(spark, sf_dir), PAIR, horizon=14)


@query(
    with_sql(
        REQ,
        DAILY,
        select=f"""
SELECT * EXCLUDE rn FROM (
  SELECT *, row_number() {BY_DAY} DESC) AS rn FROM daily) WHERE rn <= 28
""",
    )
)
def last_n(spark, sf_dir):
    return series.last_n(daily(spark, sf_dir), KEYS, 28)


def _nth(month: int, weekday: int, nth: int) -> str:
    first = f"make_date(y, {month}, 1)"
    return f"{first} + CAST((7 + {weekday} - isodow({first})) % 7 + {7 * (nth - 1)} AS INTEGER)"


_FIXED = {
    "New Year''s Day": ("make_date(y, 1, 1)", 1871),
    "Juneteenth National Independence Day": ("make_date(y, 6, 19)", 2021),
    "Independence Day": ("make_date(y, 7, 4)", 1871),
    "Veterans Day": ("make_date(y, 11, 11)", 1938),
    "Christmas Day": ("make_date(y, 12, 25)", 1871),
}
_MOVING = {
    "Martin Luther King Jr. Day": (_nth(1, 1, 3), 1986),
    "Washington''s Birthday": (_nth(2, 1, 3), 1971),
    "Memorial Day": ("make_date(y, 5, 31) - CAST((isodow(make_date(y, 5, 31)) + 6) % 7 AS INTEGER)", 1971),
    "Labor Day": (_nth(9, 1, 1), 1894),
    "Columbus Day": (_nth(10, 1, 2), 1971),
    "Thanksgiving": (_nth(11, 4, 4), 1942),
}

HOLIDAYS = (
    "years AS (SELECT unnest(generate_series(year(min(ds)), year(max(ds)) + 1)) AS y FROM total),\n"
    "bounds AS (SELECT year(min(ds)) AS lo, year(max(ds)) AS hi FROM total),\n"
    "fixed AS ("
    + " UNION ALL ".join(
        f"SELECT {ds} AS ds, '{name}' AS holiday FROM years WHERE y >= {since}" for name, (ds, since) in _FIXED.items()
    )
    + "),\nmoving AS ("
    + " UNION ALL ".join(
        f"SELECT {ds} AS ds, '{name}' AS holiday FROM years WHERE y >= {since}" for name, (ds, since) in _MOVING.items()
    )
    + """),
holidays AS (
  SELECT CAST(ds AS DATE) AS ds, holiday FROM (
    SELECT * FROM fixed UNION ALL SELECT * FROM moving
    UNION ALL SELECT ds - 1, holiday || ' (observed)' FROM fixed WHERE isodow(ds) = 6
    UNION ALL SELECT ds + 1, holiday || ' (observed)' FROM fixed WHERE isodow(ds) = 7) u, bounds
  WHERE year(ds) BETWEEN lo AND hi)"""
)


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the orders, read from one column."""
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("ds"))


@query(with_sql(REQ, DAILY, TOTAL, HOLIDAYS, select="SELECT * FROM holidays"))
def us_holidays(spark, sf_dir):
    return holidays.us_holidays(order_days(spark, sf_dir))


@query(
    with_sql(
        REQ,
        DAILY,
        TOTAL,
        HOLIDAYS,
        select="""
SELECT total.ds, y, names AS holiday, names IS NOT NULL AS is_holiday FROM total LEFT JOIN (
  SELECT ds, string_agg(holiday, '; ' ORDER BY holiday) AS names FROM holidays GROUP BY ds) n ON total.ds = n.ds
""",
    )
)
def join_holidays(spark, sf_dir):
    return holidays.join_holidays(total(spark, sf_dir), holidays.us_holidays(order_days(spark, sf_dir)))


FORECAST = [fit_sql("pairs", PAIR), forecast_sql(PAIR, 14, Z95)]
ROUND_BAND = "round(yhat, 6) AS yhat, round(yhat_lower, 6) AS yhat_lower, round(yhat_upper, 6) AS yhat_upper"


@query(with_sql(REQ, DAILY, PAIRS, *FORECAST, select=f"SELECT complaint_type, borough, ds, {ROUND_BAND} FROM f"))
def forecast_trend_seasonal(spark, sf_dir):
    return rounded(forecast.forecast_trend_seasonal(pairs(spark, sf_dir), PAIR, horizon=14), BAND)


@query(
    with_sql(
        REQ,
        DAILY,
        PAIRS,
        select="SELECT *, TRUE AS banded, TRUE AS unbiased FROM (SELECT complaint_type, borough, ds FROM pairs UNION ALL SELECT * FROM ("
        + SPINE_AHEAD.format(first="max(ds) + 1") + "))",
    )
)
def forecast_regression(spark, sf_dir):
    """Rows of each series, whether each forecast lies in its band, and whether the residuals of a series cancel out."""
    points = pairs(spark, sf_dir)
    found = regression.forecast_regression(points, PAIR, horizon=14)
    inside = (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    off = F.abs(F.avg(F.col("y") - F.col("yhat")).over(Window.partitionBy(*PAIR))) <= 0.02 * F.avg("y").over(Window.partitionBy(*PAIR))
    judged = found.join(points, [*PAIR, "ds"], "left").withColumns({"banded": inside, "unbiased": off})
    return judged.select(*PAIR, "ds", "banded", "unbiased")


@query(
    with_sql(
        REQ,
        DAILY,
        PAIRS,
        *FORECAST,
        select="""
SELECT pairs.*, round(yhat_upper, 6) AS yhat_upper FROM pairs LEFT JOIN f USING (complaint_type, borough, ds)
""",
    )
)
def actual_vs_forecast(spark, sf_dir):
    actual = pairs(spark, sf_dir)
    joined = anomaly.actual_vs_forecast(actual, forecast.forecast_trend_seasonal(actual, PAIR), PAIR)
    return rounded(joined, ["yhat_upper"])


# A narrow band gives many breaches, so that runs of several days occur.
NARROW = [fit_sql("pairs", PAIR), forecast_sql(PAIR, 14, Z50)]
FLAGS = """flags AS (
  SELECT pairs.*, round(yhat_upper, 6) AS yhat_upper, y > round(yhat_upper, 6) AS is_anomaly
  FROM pairs LEFT JOIN f USING (complaint_type, borough, ds)
)"""


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    actual = pairs(spark, sf_dir)
    predicted = forecast.forecast_trend_seasonal(actual, PAIR, interval_width=0.5)
    return anomaly.flag_breaches(rounded(anomaly.actual_vs_forecast(actual, predicted, PAIR), ["yhat_upper"]))


@query(with_sql(REQ, DAILY, PAIRS, *NARROW, FLAGS, select="SELECT * FROM flags"))
def flag_breaches(spark, sf_dir):
    return flags(spark, sf_dir)


@query(
    with_sql(
        REQ,
        DAILY,
        PAIRS,
        *NARROW,
        FLAGS,
        """running AS (
  SELECT *, CAST(sum(CASE WHEN is_anomaly THEN 1 ELSE 0 END)
    OVER (PARTITION BY complaint_type, borough ORDER BY ds) AS BIGINT) AS anomaly_streak FROM flags)""",
        select="SELECT *, anomaly_streak >= 3 AS alert FROM running",
    )
)
def breach_cumulative(spark, sf_dir):
    return anomaly.breach_cumulative(flags(spark, sf_dir), PAIR)


# Run length by counting back to the latest day that starts a run.
STREAK = """marked AS (
  SELECT *, CASE WHEN is_anomaly AND NOT coalesce(lag(is_anomaly) OVER w AND lag(ds) OVER w = ds - 1, FALSE)
                 THEN ds END AS starts
  FROM {source} WINDOW w AS (PARTITION BY {keys} ORDER BY ds)),
streaks AS (
  SELECT * EXCLUDE starts, CASE WHEN is_anomaly THEN CAST(ds - max(starts) OVER (PARTITION BY {keys} ORDER BY ds) + 1 AS BIGINT)
                ELSE CAST(0 AS BIGINT) END AS anomaly_streak FROM marked)"""


@query(
    with_sql(
        REQ,
        DAILY,
        PAIRS,
        *NARROW,
        FLAGS,
        STREAK.format(source="flags", keys="complaint_type, borough"),
        select="SELECT *, anomaly_streak >= 3 AS alert FROM streaks",
    )
)
def breach_streak(spark, sf_dir):
    return anomaly.breach_streak(flags(spark, sf_dir), PAIR)


@query(
    with_sql(
        REQ,
        DAILY,
        PAIRS,
        *NARROW,
        FLAGS,
        select="""
SELECT complaint_type, borough, count(*) FILTER (WHERE is_anomaly AND y < 3) AS false_positives,
       count(*) FILTER (WHERE y < 3) AS negatives,
       round(count(*) FILTER (WHERE is_anomaly AND y < 3) / count(*) FILTER (WHERE y < 3), 6) AS false_positive_rate
FROM flags GROUP BY ALL
""",
    )
)
def false_positive_rate(spark, sf_dir):
    labelled = flags(spark, sf_dir).withColumn("incident", F.col("y") >= 3)
    return rounded(anomaly.false_positive_rate(labelled, "incident", PAIR), ["false_positive_rate"])


APE = "abs(y - yhat) / greatest(CAST(y AS DOUBLE), 1)"


@query(
    with_sql(
        REQ,
        DAILY,
        PAIRS,
        *FORECAST,
        f"""tail AS (
  SELECT complaint_type, borough, {APE} AS ape,
         row_number() OVER (PARTITION BY complaint_type, borough ORDER BY ds DESC) AS rn
  FROM pairs JOIN f USING (complaint_type, borough, ds))""",
        select="""
SELECT complaint_type, borough, count(*) AS scored_days, round(avg(ape), 6) AS mape FROM tail WHERE rn <= 14 GROUP BY ALL
""",
    )
)
def mape_tail(spark, sf_dir):
    actual = pairs(spark, sf_dir)
    fitted = forecast.forecast_trend_seasonal(actual, PAIR)
    return rounded(evaluate.mape_tail(fitted, actual, PAIR, days=evaluate.tuning_days(14), more_than=28), ["mape"])


SCORES = f"""count(*) AS scored_days, round(avg({APE}), 6) AS mape, round(avg(abs(y - yhat)), 6) AS mae,
       round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse, round(avg(y - yhat), 6) AS mean_residual"""
SCORE_COLUMNS = ["mape", "mae", "rmse", "mean_residual"]


@query(
    with_sql(
        REQ,
        DAILY,
        PAIRS,
        *FORECAST,
        select=f"SELECT complaint_type, {SCORES} FROM pairs JOIN f USING (complaint_type, borough, ds) GROUP BY ALL",
    )
)
def forecast_metrics(spark, sf_dir):
    actual = pairs(spark, sf_dir)
    scored = evaluate.scored_days(forecast.forecast_trend_seasonal(actual, PAIR), actual, PAIR)
    return rounded(evaluate.forecast_metrics(scored, ["complaint_type"]), SCORE_COLUMNS)


@query(
    with_sql(
        REQ,
        DAILY,
        PAIRS,
        """split AS (SELECT *, max(ds) OVER (PARTITION BY complaint_type, borough) - 28 AS cutoff FROM pairs)""",
        fit_sql("split", PAIR, "ds <= cutoff"),
        select=f"""
SELECT complaint_type, borough, {SCORES} FROM (
  SELECT x.*, intercept + slope * x + coalesce(effect, 0) AS yhat
  FROM x JOIN m USING (complaint_type, borough) LEFT JOIN e USING (complaint_type, borough, dow) WHERE ds > cutoff)
GROUP BY ALL
""",
    )
)
def backtest(spark, sf_dir):
    return rounded(evaluate.backtest(pairs(spark, sf_dir), PAIR, test_days=28), SCORE_COLUMNS)


@query(
    with_sql(
        REQ,
        DAILY,
        PAIRS,
        """ends AS (SELECT complaint_type, borough, CAST(unnest([max(ds) - 14, max(ds) - 28, max(ds) - 42, max(ds) - 56]) AS DATE) AS cutoff
                    FROM pairs GROUP BY complaint_type, borough)""",
        """opened AS (SELECT pairs.*, cutoff FROM pairs JOIN ends USING (complaint_type, borough)
                      WHERE ds > cutoff - 90 AND ds <= cutoff + 14)""",
        fit_sql("opened", [*PAIR, "cutoff"], "ds <= cutoff"),
        select=f"""
SELECT complaint_type, borough, cutoff, {SCORES} FROM (
  SELECT x.*, intercept + slope * x + coalesce(effect, 0) AS yhat
  FROM x JOIN m USING (complaint_type, borough, cutoff)
  LEFT JOIN e USING (complaint_type, borough, cutoff, dow) WHERE ds > cutoff)
GROUP BY ALL
""",
    )
)
def rolling_origin_backtest(spark, sf_dir):
    scores = evaluate.rolling_origin_backtest(
        pairs(spark, sf_dir), PAIR, origins=4, step_days=14, train_days=90, test_days=14
    )
    return rounded(scores, SCORE_COLUMNS)


BOROUGH = ["borough"]


def boroughs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.series_total(daily(spark, sf_dir), BOROUGH)


OLS_BAND = f"""round(yhat, 6) AS yhat, round(yhat - {Z95!r} * sigma, 6) AS yhat_lower, round(yhat + {Z95!r} * sigma, 6) AS yhat_upper"""


@query(
    with_sql(
        REQ, DAILY, BOROUGHS, ols_sql("line", "boroughs", BOROUGH),
        select=f"""
SELECT borough, ds, {OLS_BAND} FROM (SELECT borough, ds, yhat FROM line_f UNION ALL SELECT * FROM {ols_ahead_sql("line", 14)})
JOIN line_s USING (borough)""",
    )
)
def forecast_regression_numbers(spark, sf_dir):
    """The regression forecast without penalties, which is least squares: its numbers, day by day."""
    found = regression.forecast_regression(boroughs(spark, sf_dir), BOROUGH, 14, params=regression.unpenalised())
    return rounded(found, BAND)


@query(
    with_sql(
        REQ, DAILY, BOROUGHS, """line_cut AS (SELECT boroughs.*, max(ds) OVER (PARTITION BY borough) - 28 AS cutoff FROM boroughs)""",
        ols_sql("line", "line_cut", BOROUGH, train="ds <= cutoff"),
        select=f"SELECT borough, {SCORES} FROM line_f WHERE ds > cutoff GROUP BY ALL",
    )
)
def backtest_regression(spark, sf_dir):
    """Scores of the unpenalised regression on the last 28 days."""
    return rounded(origins.backtest_regression(boroughs(spark, sf_dir), BOROUGH, 28, regression.unpenalised()), SCORE_COLUMNS)


@query(
    with_sql(
        REQ, DAILY, BOROUGHS,
        """ends AS (SELECT borough, CAST(unnest([max(ds) - 14, max(ds) - 28, max(ds) - 42, max(ds) - 56]) AS DATE) AS cutoff FROM boroughs GROUP BY borough)""",
        """line_cut AS (SELECT boroughs.*, cutoff FROM boroughs JOIN ends USING (borough) WHERE ds <= cutoff + 14)""",
        ols_sql("line", "line_cut", ["borough", "cutoff"], train="ds <= cutoff"),
        select=f"SELECT borough, cutoff, {SCORES} FROM line_f WHERE ds > cutoff GROUP BY ALL",
    )
)
def rolling_origin_regression(spark, sf_dir):
    """Scores of the unpenalised regression at four cutoffs, solved from running sums."""
    scores = origins.rolling_origin_regression(boroughs(spark, sf_dir), BOROUGH, 4, 14, None, 14, regression.unpenalised())
    return rounded(scores, SCORE_COLUMNS)


CONFORMAL = """held AS (SELECT borough, abs(y - yhat) AS e, (CAST(ds - cutoff AS INTEGER) - 1) // 7 AS block FROM line_f WHERE ds > cutoff),
n AS (SELECT *, count(*) OVER (PARTITION BY borough, block) AS n, row_number() OVER (PARTITION BY borough, block ORDER BY e) AS r,
  count(*) OVER (PARTITION BY borough) AS m, row_number() OVER (PARTITION BY borough ORDER BY e) AS q FROM held),
half AS (SELECT borough, b.block, coalesce(
    max(CASE WHEN n.block = b.block AND r = CAST(ceil((n + 1) * 0.8 - 1e-9) AS BIGINT) THEN e END),
    max(CASE WHEN q = CAST(ceil((m + 1) * 0.8 - 1e-9) AS BIGINT) THEN e END), max(e)) AS half
  FROM n JOIN (SELECT DISTINCT borough, block FROM held) b USING (borough) GROUP BY ALL)"""


@query(
    with_sql(
        REQ, DAILY, BOROUGHS,
        """ends AS (SELECT borough, max(ds) AS last, unnest([1, 2, 3, 4, 5, 6]) AS i FROM boroughs GROUP BY borough)""",
        """line_cut AS (SELECT boroughs.*, CAST(last - CAST(14 * i AS INTEGER) AS DATE) AS cutoff FROM boroughs JOIN ends USING (borough) WHERE ds <= last - CAST(14 * (i - 1) AS INTEGER))""",
        ols_sql("line", "line_cut", ["borough", "cutoff"], train="ds <= cutoff"), CONFORMAL, ols_sql("whole", "boroughs", BOROUGH),
        select=f"""
SELECT a.borough, a.ds, round(a.yhat, 6) AS yhat, round(a.yhat - half, 6) AS yhat_lower, round(a.yhat + half, 6) AS yhat_upper
FROM {ols_ahead_sql("whole", 14)} a JOIN (SELECT borough, max(ds) AS last FROM boroughs GROUP BY borough) l ON a.borough = l.borough
JOIN half ON half.borough = a.borough AND half.block = least((CAST(a.ds - last AS INTEGER) - 1) // 7, (SELECT max(h.block) FROM half h WHERE h.borough = a.borough))""",
    )
)
def calibrated_band(spark, sf_dir):
    """The next days with a band from the residuals at six held-out origins."""
    points = boroughs(spark, sf_dir)
    ahead = regression.forecast_regression(points, BOROUGH, 14, include_history=False, params=regression.unpenalised())
    held = origins.origin_forecasts(points, BOROUGH, 6, 14, None, 14, regression.unpenalised())
    return rounded(evaluate.calibrated_band(ahead, held, BOROUGH, 0.8), BAND)
