"""Queries on tuning, model versions and inference.

Runs are derived from the orders: one model per order priority and one run per
ship month and year, scored by a price ratio.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from calltide.operators import models, regression
from calltide.operators.evaluate import ape
from calltide.plans.registry import BOROUGHS, DAILY, PAIRS, REQ, ols_ahead_sql, ols_sql, query, rounded, with_sql
from calltide.plans.series_queries import BAND, OLS_BAND, PAIR, boroughs, pairs
from calltide.sources.requests import table

REGISTRY = """registry AS (
  SELECT model_name, month AS version, CASE WHEN month % 11 = 0 THEN '' WHEN month % 13 = 0 THEN 'oops'
           WHEN month % 17 = 0 THEN 'nan' ELSE CAST(orders_in_month AS VARCHAR) END AS mape,
         CASE WHEN month % 7 = 0 THEN 'Staging' WHEN month % 5 = 0 THEN 'Production' ELSE 'None' END AS stage
  FROM (SELECT o_orderpriority AS model_name, (year(o_orderdate) - 1990) * 12 + month(o_orderdate) AS month,
               count(*) AS orders_in_month FROM orders GROUP BY ALL))"""


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    month = ((F.year("o_orderdate") - 1990) * 12 + F.month("o_orderdate")).cast("bigint")
    counted = orders.groupBy(F.col("o_orderpriority").alias("model_name"), month.alias("version")).agg(
        F.count(F.lit(1)).alias("n")
    )
    version = F.col("version")
    tag = (
        F.when(version % 11 == 0, "")
        .when(version % 13 == 0, "oops")
        .when(version % 17 == 0, "nan")
        .otherwise(F.col("n").cast("string"))
    )
    stage = F.when(version % 7 == 0, "Staging").when(version % 5 == 0, "Production").otherwise("None")
    return counted.select("model_name", "version", tag.alias("mape"), stage.alias("stage"))


VALUE = """CASE WHEN NOT isnan(coalesce(try_cast(nullif(mape, 'nan') AS DOUBLE), 'nan'::DOUBLE))
           THEN try_cast(nullif(mape, 'nan') AS DOUBLE) END"""
SCORED = f"scored AS (SELECT *, {VALUE} AS value FROM registry)"
BEST = """best AS (
  SELECT model_name, version, value FROM scored WHERE value IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY value, version) = 1)"""
STAGED = """staged AS (
  SELECT model_name, version, value FROM scored WHERE stage = 'Staging'
  QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY version DESC) = 1)"""
DECISION = """decision AS (
  SELECT b.model_name, b.version AS best_version, b.value AS best_mape, s.version AS stage_version,
         s.value AS stage_mape, s.value IS NULL OR b.value < s.value AS promoted
  FROM best b LEFT JOIN staged s ON b.model_name = s.model_name)"""


@query(f"WITH {REGISTRY}, {SCORED}, {BEST} SELECT model_name, version, value AS mape FROM best")
def best_version(spark, sf_dir):
    return models.best_version(registry(spark, sf_dir))


@query(f"WITH {REGISTRY}, {SCORED}, {BEST}, {STAGED}, {DECISION} SELECT * FROM decision")
def promote_if_better(spark, sf_dir):
    return models.promote_if_better(registry(spark, sf_dir))


@query(f"""
WITH {REGISTRY}, {SCORED}, {BEST}, {STAGED}, {DECISION}
SELECT r.model_name, r.version, r.mape,
       CASE WHEN d.model_name IS NOT NULL THEN 'Staging' ELSE r.stage END AS stage
FROM registry r LEFT JOIN decision d ON r.model_name = d.model_name AND r.version = d.best_version AND d.promoted
""")
def apply_promotions(spark, sf_dir):
    return models.apply_promotions(registry(spark, sf_dir))


@query(f"""
WITH {REGISTRY}
SELECT model_name, version, mape,
       CASE WHEN version = max(version) OVER (PARTITION BY model_name) THEN 'Production' ELSE stage END AS stage
FROM registry
""")
def set_stage(spark, sf_dir):
    runs = registry(spark, sf_dir)
    newest = runs.groupBy("model_name").agg(F.max("version").alias("version"))
    return models.set_stage(runs, newest.withColumn("stage", F.lit("Production")))


@query(f"""
WITH {REGISTRY},
newest AS (SELECT model_name, max(version) AS newest FROM registry GROUP BY 1),
runs AS (SELECT o_orderpriority AS model_name, year(o_orderdate) AS trial, count(*) AS n FROM orders GROUP BY ALL)
SELECT model_name, newest + row_number() OVER (PARTITION BY model_name ORDER BY trial) AS version,
       CAST(trial AS VARCHAR) AS year, CAST(n AS VARCHAR) AS mape, 'None' AS stage
FROM runs JOIN newest USING (model_name)
""")
def register_runs(spark, sf_dir):
    runs = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("model_name"), F.year("o_orderdate").alias("trial"))
        .agg(F.count(F.lit(1)).alias("mape"))
        .withColumn("params", F.create_map(F.lit("year"), F.col("trial").cast("string")))
    )
    added = models.register_runs(registry(spark, sf_dir), runs)
    return added.withColumn("year", F.col("params")["year"]).drop("params")


TRIALS = ", ".join(f"({i}, '{t['seasonality_mode']}')" for i, t in enumerate(regression.draw_trials(20)))


@query(
    with_sql(
        REQ,
        DAILY,
        PAIRS,
        select=f"""
SELECT DISTINCT complaint_type, borough, CAST(trial AS INTEGER) AS trial, mode AS seasonality_mode, TRUE AS scored, CAST(0 AS DOUBLE) AS off
FROM pairs, (VALUES {TRIALS}) t(trial, mode)
""",
    )
)
def tune(spark, sf_dir):
    """Every series and trial with its parameters, whether it has a score, and how far that is from the score of its own forecasts.

    The latter come by another way: models fitted on the days before and stored, and their forecasts of the held-out days.
    """
    points = pairs(spark, sf_dir)
    settings = regression.draw_trials(20)
    trials = regression.tune(points, PAIR, settings)
    last = Window.partitionBy(*PAIR)
    cut = points.withColumn("cutoff", F.date_sub(F.max("ds").over(last), 14))
    fitted = regression.fit_trials(cut.filter("ds <= cutoff"), PAIR, settings)
    ahead = regression.predict_regression(fitted, [*PAIR, "trial"], 400, include_history=False)
    again = ahead.join(cut.filter("ds > cutoff"), [*PAIR, "ds"]).groupBy(*PAIR, "trial").agg(F.avg(ape()).alias("again"))
    off = F.round(F.col("mape") - F.col("again"), 6)
    return trials.join(again, [*PAIR, "trial"], "left").select(
        *PAIR, "trial", F.col("params")["seasonality_mode"].alias("seasonality_mode"), F.coalesce(F.col("mape").between(0, 10), F.lit(False)).alias("scored"), F.abs(off).alias("off")
    )


@query(
    with_sql(
        REQ, DAILY, BOROUGHS,
        select="""SELECT DISTINCT borough, CAST(trial AS INTEGER) AS trial, CAST(CASE WHEN trial < 12 THEN 0 WHEN trial < 16 THEN 1 ELSE 2 END AS INTEGER) AS turn,
  TRUE AS scored FROM boroughs, range(20) t(trial)""",
    )
)
def tune_adaptive(spark, sf_dir):
    """Every series' twenty trials in three turns, and whether each has a score that a forecast can have."""
    found = regression.tune_adaptive(boroughs(spark, sf_dir), ["borough"])
    return found.select("borough", "trial", "turn", F.coalesce(F.col("mape").between(0, 10), F.lit(False)).alias("scored"))


LINE_TRIALS = [regression.unpenalised(), regression.unpenalised(weekly=False)]


@query(
    with_sql(
        REQ, DAILY, BOROUGHS, "cut AS (SELECT boroughs.*, max(ds) OVER (PARTITION BY borough) - 14 AS cutoff FROM boroughs)",
        *[ols_sql(f"try{i}", "cut", ["borough"], weekly=i == 0, train="ds <= cutoff") for i in range(2)],
        select="""
SELECT borough, trial, round(avg(abs(y - yhat) / greatest(y, 1)), 6) AS mape FROM (
  SELECT 0 AS trial, borough, ds, cutoff, CAST(y AS DOUBLE) AS y, yhat FROM try0_f UNION ALL SELECT 1, borough, ds, cutoff, CAST(y AS DOUBLE), yhat FROM try1_f)
WHERE ds > cutoff GROUP BY ALL""",
    )
)
def tune_numbers(spark, sf_dir):
    """Held-out scores of two settings whose fits SQL can solve."""
    return rounded(regression.tune(boroughs(spark, sf_dir), ["borough"], LINE_TRIALS).select("borough", "trial", "mape"), ["mape"])


@query(
    with_sql(
        REQ, DAILY, BOROUGHS, ols_sql("line", "boroughs", ["borough"]),
        select=f"""SELECT 'requests' AS model_name, CAST(1 AS BIGINT) AS version, borough, ds, {OLS_BAND}
FROM {ols_ahead_sql("line", 14)} JOIN line_s USING (borough)""",
    )
)
def forecast_infer(spark, sf_dir):
    """Days ahead from a stored model in Production, the numbers of least squares; a newer version is not live."""
    points = boroughs(spark, sf_dir).withColumn("model_name", F.lit("requests"))
    version = lambda n, params: regression.fit_regression(points, ["model_name", "borough"], params).withColumn("version", F.lit(n).cast("bigint"))
    coefficients = version(1, regression.unpenalised()).unionByName(version(2, None))
    runs = table(spark, sf_dir, "region").select(F.lit("requests").alias("model_name"), F.explode(F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))).alias("version")).distinct()
    staged = runs.withColumn("stage", F.when(F.col("version") == 1, "Production").otherwise("Staging"))
    return rounded(regression.forecast_infer(coefficients, staged, ["borough"]), BAND)
