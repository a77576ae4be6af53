"""Queries on data quality and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from calltide.operators import quality
from calltide.operators.series import daily_counts, series_total
from calltide.plans.registry import DAILY, PAIRS, REQ, query, rounded, with_sql
from calltide.sources.requests import requests, table

RULES = [
    quality.not_null("l_returnflag"),
    quality.between("l_discount", 0.0, 0.05, mostly=0.99),
    quality.between("l_quantity", 1, 49, mostly=0.9),
]

REPORT = """
SELECT '{rule}' AS rule, count(*) AS total, count(*) FILTER (WHERE NOT {ok}) AS failed,
       round((count(*) - count(*) FILTER (WHERE NOT {ok})) / count(*), 6) AS ratio,
       (count(*) - count(*) FILTER (WHERE NOT {ok})) / count(*) >= {mostly} AS success
FROM {table}"""

NOT_NULL = REPORT.format(rule="l_returnflag_not_null", ok="(l_returnflag IS NOT NULL)", mostly=1, table="lineitem")
DISCOUNT = REPORT.format(
    rule="l_discount_between", ok="(l_discount BETWEEN 0 AND 0.05)", mostly=0.99, table="lineitem"
)
QUANTITY = REPORT.format(rule="l_quantity_between", ok="(l_quantity BETWEEN 1 AND 49)", mostly=0.9, table="lineitem")


@query(with_sql(REQ, select=REPORT.format(rule="closed_date_not_null", ok="(closed_date IS NOT NULL)", mostly=1, table="req")))
def expect_not_null(spark, sf_dir):
    return rounded(quality.expect_not_null(requests(spark, sf_dir, closed=True), "closed_date"), ["ratio"])


@query(REPORT.format(rule="c_acctbal_between", ok="(c_acctbal BETWEEN 0 AND 9000)", mostly=0.8, table="customer"))
def expect_between(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return rounded(quality.expect_between(customers, "c_acctbal", 0, 9000, mostly=0.8), ["ratio"])


@query(" UNION ALL ".join([NOT_NULL, DISCOUNT, QUANTITY]))
def quality_report(spark, sf_dir):
    return rounded(quality.quality_report(table(spark, sf_dir, "lineitem"), RULES), ["ratio"])


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem")
def enforce(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return quality.enforce(lines, [quality.not_null("l_orderkey"), quality.between("l_discount", 0, 1)])


@query("""
SELECT l_orderkey, l_linenumber,
       concat_ws(',', CASE WHEN l_returnflag IS NULL THEN 'l_returnflag_not_null' END,
                 CASE WHEN NOT l_discount BETWEEN 0 AND 0.05 THEN 'l_discount_between' END,
                 CASE WHEN NOT l_quantity BETWEEN 1 AND 49 THEN 'l_quantity_between' END) AS failed_rules
FROM lineitem
""")
def quarantine(spark, sf_dir):
    marked = quality.quarantine(table(spark, sf_dir, "lineitem"), RULES)
    return marked.select("l_orderkey", "l_linenumber", F.array_join("failed_rules", ",").alias("failed_rules"))


@query("""
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, count(*) AS records
FROM events GROUP BY ALL
""")
def daily_completeness(spark, sf_dir):
    return quality.daily_completeness(table(spark, sf_dir, "events"), "ts")


@query(
    with_sql(
        REQ,
        DAILY,
        PAIRS,
        """span AS (SELECT complaint_type, borough, unnest(generate_series(CAST(min(ds) AS TIMESTAMP),
             CAST(max(ds) AS TIMESTAMP), INTERVAL 1 DAY)) AS t FROM pairs GROUP BY complaint_type, borough)""",
        select="""
SELECT complaint_type, borough, CAST(t AS DATE) AS ds FROM span
WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.complaint_type = span.complaint_type
                  AND p.borough = span.borough AND p.ds = CAST(t AS DATE))
""",
    )
)
def missing_dates(spark, sf_dir):
    daily = daily_counts(requests(spark, sf_dir), "created_date")
    return quality.missing_dates(series_total(daily, ["complaint_type", "borough"]), ["complaint_type", "borough"])


@query("""
WITH daily AS (
  SELECT CAST(ts AS DATE) AS ds, count(*) AS records,
         count(*) FILTER (WHERE value < 5) / count(*) AS null_rate FROM events GROUP BY 1),
z AS (
  SELECT *, CASE WHEN stddev_samp(records) OVER p > 1e-9
                 THEN (records - avg(records) OVER p) / stddev_samp(records) OVER p END AS records_z,
         CASE WHEN stddev_samp(null_rate) OVER p > 1e-9
                 THEN (null_rate - avg(null_rate) OVER p) / stddev_samp(null_rate) OVER p END AS null_rate_z
  FROM daily WINDOW p AS (ORDER BY ds ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
SELECT ds, records, round(null_rate, 6) AS null_rate, round(records_z, 6) AS records_z,
       round(null_rate_z, 6) AS null_rate_z, abs(records_z) > 3 OR abs(null_rate_z) > 3 AS drifted FROM z
""")
def drift_report(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", F.expr("CASE WHEN value >= 5 THEN value END").alias("value"))
    report = quality.drift_report(events, "ts", "value")
    return rounded(report, ["null_rate", "records_z", "null_rate_z"])


@query("""
WITH v AS (SELECT CAST(ts AS DATE) AS ds, CAST(ts AS DATE) - DATE '2024-01-01' AS nth,
             CASE WHEN CAST(ts AS DATE) = DATE '2024-01-20' THEN value + 3 ELSE value END AS value FROM events),
d AS (SELECT ds, dense_rank() OVER (ORDER BY ds) AS nth FROM (SELECT DISTINCT ds FROM v)),
w AS (SELECT d.nth, value FROM v JOIN d USING (ds)),
s AS (SELECT nth, 'a' AS side, value FROM w UNION ALL SELECT t.nth, 'b', w.value FROM d t JOIN w ON w.nth BETWEEN t.nth - 28 AND t.nth - 1),
o AS (SELECT *, row_number() OVER (PARTITION BY nth, side ORDER BY value) AS r, count(*) OVER (PARTITION BY nth, side) AS n FROM s),
q AS (SELECT nth, side, n, i, value FROM o, (SELECT unnest(range(1, 50)) AS i) g WHERE r = CAST(ceil(round(i / 50 * n, 7)) AS BIGINT)),
f AS (SELECT x.nth, x.side, x.i, abs(count(*) FILTER (WHERE y.side = 'a' AND y.value <= x.value) - count(*) FILTER (WHERE y.side = 'b' AND y.value <= x.value)) / 50 AS apart
  FROM q x JOIN q y USING (nth) GROUP BY ALL),
n AS (SELECT nth, count(*) FILTER (WHERE side = 'a') AS records, count(*) FILTER (WHERE side = 'b') AS reference FROM s GROUP BY nth),
m AS (SELECT nth, max(apart) AS distance FROM f GROUP BY nth)
SELECT ds, 'value' AS "column", records, reference, CASE WHEN reference > 0 THEN round(distance, 6) END AS distance,
  CASE WHEN reference > 0 THEN distance > greatest(0.1, 1.63 * sqrt((records + reference) / (records * reference))) END AS drifted
FROM d JOIN n USING (nth) JOIN m USING (nth)
""")
def value_drift(spark, sf_dir):
    """Values against the days before; those of one day are raised, while counts and NULLs stay the same."""
    raised = F.when(F.to_date("ts") == F.lit("2024-01-20").cast("date"), F.col("value") + 3).otherwise(F.col("value"))
    events = table(spark, sf_dir, "events").select("ts", raised.alias("value"))
    return rounded(quality.value_drift(events, "ts", ["value"], sketch_size=32_768), ["distance"])


@query("""
SELECT max(ts) AS last_ts,
       date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-01-31 01:00:00') AS lag_seconds,
       date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-01-31 01:00:00') < 7200 AS fresh FROM events
""")
def freshness(spark, sf_dir):
    return quality.freshness(table(spark, sf_dir, "events"), "ts", "2024-01-31 01:00:00")


@query("""
SELECT event_type AS job, CAST(ts AS DATE) AS day, count(*) AS runs,
       round(count(*) FILTER (WHERE value > 1) / count(*), 6) AS success_rate,
       round(avg(value), 6) AS mean_duration_s, max(value) AS max_duration_s,
       round(quantile_disc(value, 0.5), 6) AS median_duration_s,
       count(*) FILTER (WHERE value > 1) / count(*) >= 0.995 AS meets_goal
FROM events GROUP BY ALL
""")
def run_metrics(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("job"),
        F.to_date("ts").alias("day"),
        (F.col("value") > 1).alias("success"),
        F.col("value").alias("duration_s"),
    )
    return rounded(quality.run_metrics(log), ["success_rate", "mean_duration_s", "median_duration_s"])
