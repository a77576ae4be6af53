"""Queries that run streams and whole jobs over stored layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calltide.operators.regression import unpenalised
from calltide.params import Params
from calltide.plans import jobs
from calltide.plans.ingest_queries import CLEAN, SILVER, new_layer, raw_requests
from calltide.plans.registry import BOROUGHS, DAILY, REQ, TOTAL, fit_sql, forecast_sql, ols_ahead_sql, ols_sql, query, rounded, with_sql
from calltide.plans.series_queries import BAND, GOLD, OLS_BAND, ROUND_BAND, STREAK, Z50, Z95
from calltide.sources import layers
from calltide.sources.pages import read_landed_pages
from calltide.sources.requests import requests, table
from calltide.sources.scratch import shared_dir
from calltide.streaming import streams

AS_OF = "2001-08-02"


def finished(query) -> None:
    query.awaitTermination()


@query("""
SELECT CAST(ts AS DATE) AS ds, event_type, count(*) AS y FROM events
WHERE CAST(ts AS DATE) + 1 <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY ALL
""")
def stream_daily_counts(spark, sf_dir):
    out = shared_dir(spark, "stream")
    counts = streams.stream_daily_counts(
        streams.read_stream(spark, sf_dir, "events.parquet"), "ts", ["event_type"], overlap_days=1
    )
    finished(streams.write_stream(counts, f"{out}/rows", f"{out}/checkpoint"))
    return spark.read.schema("ds date, event_type string, y bigint").parquet(f"{out}/rows")


@query("SELECT event_id, event_type, value FROM events")
def stream_dedup(spark, sf_dir):
    out = shared_dir(spark, "stream")
    once = streams.read_stream(spark, sf_dir, "events.parquet")
    twice = once.unionByName(streams.read_stream(spark, sf_dir, "events.parquet"))
    unique = streams.stream_dedup(twice.select("event_id", "ts", "event_type", "value"), "event_id", "ts")
    finished(streams.write_stream(unique.drop("ts"), f"{out}/rows", f"{out}/checkpoint"))
    return spark.read.schema("event_id bigint, event_type string, value double").parquet(f"{out}/rows")


LATE = """parts AS (SELECT *, event_id % 5 = 0 AS second FROM events),
closed AS (SELECT CAST(max(ts) - INTERVAL 5 DAY AS DATE) AS day FROM parts WHERE NOT second AND ts < TIMESTAMP '2024-01-20'),
first_open AS (SELECT * FROM parts WHERE NOT second AND ts < TIMESTAMP '2024-01-20')"""


@query(f"""
WITH {LATE},
rest AS (SELECT *, CAST(ts AS DATE) < day AS late FROM parts, closed WHERE second OR ts >= TIMESTAMP '2024-01-20')
SELECT CAST(ts AS DATE) AS ds, event_type, count(*) FILTER (NOT late) AS y, count(*) FILTER (late) AS late
FROM (SELECT ts, event_type, FALSE AS late FROM first_open UNION ALL SELECT ts, event_type, late FROM rest) GROUP BY ALL
""")
def stream_daily_totals(spark, sf_dir):
    """Two batches, the second one with new days and with late rows of old ones."""
    out = shared_dir(spark, "stream")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    first = "event_id % 5 <> 0 AND ts < TIMESTAMP_NTZ '2024-01-20'"
    for part in (events.filter(first), events.filter(f"NOT ({first})")):
        part.write.mode("append").parquet(f"{out}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{out}/in")
        finished(streams.stream_daily_totals(stream, f"{out}/layers", "ts", ["event_type"], f"{out}/checkpoint", overlap_days=5))
    counts, late = [layers.read_layer(spark, layers.Layer(f"{out}/layers", n)) for n in ("counts", "late")]
    both = counts.select("ds", "event_type", "y", F.lit(0).cast("bigint").alias("late")).unionByName(
        late.select("ds", "event_type", F.lit(0).cast("bigint").alias("y"), F.col("y").alias("late"))
    )
    return both.groupBy("ds", "event_type").agg(F.sum("y").alias("y"), F.sum("late").alias("late"))


@query("""
WITH marked AS (SELECT *, ts > lag(ts) OVER w + INTERVAL 1 DAY OR lag(ts) OVER w IS NULL AS opens FROM events
  WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)),
numbered AS (SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS session FROM marked),
newest AS (SELECT user_id, event_type, session, max(struct_pack(value := value, event_id := event_id, ts := ts)) AS row, max(ts) AS last FROM numbered GROUP BY ALL)
SELECT user_id, event_type, row.event_id AS event_id, row.value AS value FROM newest
WHERE last + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)
""")
def stream_latest(spark, sf_dir):
    """The largest value of each user and kind in every spell without a day's pause."""
    out = shared_dir(spark, "stream")
    events = streams.read_stream(spark, sf_dir, "events.parquet").select("user_id", "event_type", "value", "event_id", "ts")
    latest = streams.stream_latest(events, ["user_id", "event_type"], "ts", ["value", "event_id"])
    finished(streams.write_stream(latest.drop("ts"), f"{out}/rows", f"{out}/checkpoint"))
    return spark.read.schema("user_id bigint, event_type string, value double, event_id bigint").parquet(f"{out}/rows")


@query("SELECT event_id, ts, value, CAST(ts AS DATE) AS day FROM events")
def stream_upsert(spark, sf_dir):
    layer = new_layer(spark, "streamed")
    early = table(spark, sf_dir, "events").select("event_id", "ts", (-F.col("value")).alias("value"))
    early = early.filter("ts < TIMESTAMP_NTZ '2024-01-16'").withColumn("day", F.to_date("ts"))
    layers.upsert_layer(early, layer, ["event_id"], ["ts"], ["day"])
    stream = streams.read_stream(spark, sf_dir, "events.parquet")
    rows = stream.select("event_id", "ts", "value", F.to_date("ts").alias("day"))
    checkpoint = shared_dir(spark, "checkpoint")
    finished(streams.stream_upsert(rows, layer, ["event_id"], ["ts"], checkpoint, ["day"]))
    return layers.read_layer(spark, layer)


def new_layers(spark: SparkSession) -> jobs.Layers:
    return jobs.Layers(shared_dir(spark, "layers"))


def up_to_gold(spark: SparkSession, sf_dir: str, where: jobs.Layers) -> None:
    """Bronze, Silver and Gold of the well-formed requests."""
    jobs.bronze_job(requests(spark, sf_dir, closed=True), where, AS_OF)
    jobs.silver_job(spark, where, AS_OF)
    jobs.gold_job(spark, where)


@query(
    with_sql(
        REQ,
        CLEAN,
        select=f"""
SELECT unique_key, created_date, status, CAST(year(created_date) AS INTEGER) AS received_year,
       CAST(month(created_date) AS INTEGER) AS received_month, DATE '{AS_OF}' AS ingestion_date
FROM (SELECT unique_key % 97 = 0 AS bad_key, * EXCLUDE (unique_key, created_date, status),
             CASE WHEN unique_key % 97 = 0 THEN 'x' ELSE '' END || CAST(unique_key AS VARCHAR) AS unique_key,
             CASE WHEN unique_key % 89 = 0 THEN NULL ELSE created_date END AS created_date, status FROM req)
""",
    )
)
def bronze_job(spark, sf_dir):
    landed = shared_dir(spark, "pages")
    raw = raw_requests(spark, sf_dir)
    raw.write.json(landed)
    bronze = jobs.bronze_job(read_landed_pages(spark, landed, raw.columns), new_layers(spark), AS_OF)
    return bronze.select(
        "unique_key",
        F.col("created_date").try_cast("timestamp_ntz").alias("created_date"),
        "status",
        "received_year",
        "received_month",
        "ingestion_date",
    )


SILVER_ROWS = with_sql(
    REQ,
    CLEAN,
    SILVER,
    select=f"""
SELECT *, DATE '{AS_OF}' AS bronze_date, DATE '{AS_OF}' AS ingestion_date,
       CAST(date_trunc('month', created_ts_utc) AS DATE) AS created_month FROM silver WHERE unique_key IS NOT NULL
""",
)


@query(SILVER_ROWS)
def silver_job(spark, sf_dir):
    where = new_layers(spark)
    jobs.bronze_job(raw_requests(spark, sf_dir), where, AS_OF)
    return jobs.silver_job(spark, where, AS_OF)


@query(SILVER_ROWS)
def silver_job_rerun(spark, sf_dir):
    """Three runs over the same Bronze, the last one over all of it."""
    where = new_layers(spark)
    jobs.bronze_job(raw_requests(spark, sf_dir), where, AS_OF)
    jobs.silver_job(spark, where, AS_OF)
    jobs.silver_job(spark, where, AS_OF)
    return jobs.silver_job(spark, where, AS_OF, full=True)


@query(with_sql(REQ, select=f"SELECT 'x' || unique_key AS unique_key, DATE '{AS_OF}' AS ingestion_date FROM req WHERE unique_key % 97 = 0"))
def silver_rejects(spark, sf_dir):
    """Rows with an unreadable key, after two runs and a reload of their load date."""
    where = new_layers(spark)
    jobs.bronze_job(raw_requests(spark, sf_dir), where, AS_OF)
    for dates in (None, None, (AS_OF, AS_OF)):
        jobs.silver_job(spark, where, AS_OF, load_dates=dates)
    rejects = layers.read_layer(spark, where.rejects)
    return rejects.select(F.get_json_object("raw", "$.unique_key").alias("unique_key"), "ingestion_date")


@query(
    with_sql(
        REQ,
        select="""
SELECT unique_key, status, CASE WHEN created_date < TIMESTAMP '1996-01-01' THEN DATE '2001-03-01' ELSE DATE '2001-03-05' END AS bronze_date
FROM req WHERE unique_key % 97 <> 0
""",
    )
)
def silver_job_late_load(spark, sf_dir):
    """A load that arrives after a Silver run and bears an earlier date than that run."""
    where, raw = new_layers(spark), raw_requests(spark, sf_dir)
    rows = requests(spark, sf_dir).select("unique_key", "created_date")
    early = rows.filter("created_date < TIMESTAMP_NTZ '1996-01-01'").select(F.col("unique_key").alias("early"))
    key = F.regexp_replace("unique_key", "x", "").cast("bigint")
    jobs.bronze_job(raw.join(early, key == F.col("early"), "left_semi"), where, "2001-03-01")
    jobs.silver_job(spark, where, "2001-03-10")
    jobs.bronze_job(raw.join(early, key == F.col("early"), "left_anti"), where, "2001-03-05")
    jobs.silver_job(spark, where, "2001-03-10")
    return jobs.silver_job(spark, where, "2001-03-11").select("unique_key", "status", "bronze_date")


APPENDED = """loads AS (
  SELECT *, 'first' AS state, DATE '2001-03-01' AS bronze_date, 1 AS nth FROM req
  UNION ALL SELECT *, 'second', DATE '2001-03-08', 2 FROM req WHERE unique_key % 3 = 0
  UNION ALL SELECT *, 'third', DATE '2001-03-05', 3 FROM req WHERE unique_key % 6 = 0)"""


@query(
    with_sql(
        REQ,
        APPENDED,
        select="""
SELECT CAST(unique_key AS VARCHAR) AS unique_key, arg_max(state, nth) AS status, arg_max(bronze_date, nth) AS bronze_date, FALSE AS rejected
FROM loads WHERE unique_key % 97 <> 0 GROUP BY unique_key
UNION ALL SELECT 'x' || unique_key, state, bronze_date, TRUE FROM loads WHERE unique_key % 97 = 0
""",
    )
)
def silver_job_append_only(spark, sf_dir):
    """Three loads of many keys into append-only Bronze, the last under an earlier date, and the first one read again."""
    where, raw = new_layers(spark), raw_requests(spark, sf_dir)
    key = F.regexp_replace("unique_key", "x", "").cast("bigint")
    loads = (("first", "2001-03-01", 1), ("second", "2001-03-08", 3), ("third", "2001-03-05", 6))
    for state, as_of, nth in loads:
        jobs.bronze_job(raw.filter(key % nth == 0).withColumn("status", F.lit(state)), where, as_of, append_only=True)
        jobs.silver_job(spark, where, "2001-03-10")
    silver = jobs.silver_job(spark, where, "2001-03-11", load_dates=("2001-03-01", "2001-03-01"))
    rejects = layers.read_layer(spark, where.rejects)
    text = lambda c: F.get_json_object("raw", f"$.{c}").alias(c)
    return silver.select(F.col("unique_key").cast("string"), "status", "bronze_date", F.lit(False).alias("rejected")).unionByName(
        rejects.select(text("unique_key"), text("status"), F.col("ingestion_date").alias("bronze_date"), F.lit(True).alias("rejected"))
    )


CORRECTED = """req AS (SELECT * REPLACE (CASE WHEN created_date >= TIMESTAMP '1997-03-01' AND created_date < TIMESTAMP '1997-04-01'
  THEN 'other' ELSE complaint_type END AS complaint_type) FROM req0)"""


@query(
    with_sql(
        REQ.replace("req AS", "req0 AS", 1),
        CORRECTED,
        DAILY,
        GOLD,
        select="SELECT *, CAST(date_trunc('month', ds) AS DATE) AS month FROM gold",
    )
)
def gold_job_backfill(spark, sf_dir):
    """A correction of one month, loaded under an earlier date than the first load."""
    where, rows = new_layers(spark), requests(spark, sf_dir, closed=True)
    up_to_gold(spark, sf_dir, where)
    month = rows.filter("created_date >= TIMESTAMP_NTZ '1997-03-01' AND created_date < TIMESTAMP_NTZ '1997-04-01'")
    jobs.bronze_job(month.withColumn("complaint_type", F.lit("other")), where, "2001-07-01")
    jobs.silver_job(spark, where, "2001-07-01")
    return rounded(jobs.gold_job(spark, where), ["y_ma7"])


CHANGED = """req AS (
  SELECT * REPLACE (
    CASE WHEN unique_key % 50 = 1 THEN created_date + INTERVAL 40 DAY ELSE created_date END AS created_date,
    CASE WHEN unique_key % 50 = 2 THEN NULL ELSE agency END AS agency)
  FROM req0 WHERE unique_key % 50 <> 4)"""


@query(
    with_sql(
        REQ.replace("req AS", "req0 AS", 1),
        CHANGED,
        DAILY,
        GOLD,
        select="SELECT *, CAST(date_trunc('month', ds) AS DATE) AS month FROM gold",
    )
)
def gold_job_delta(spark, sf_dir):
    """Gold after new, moved and corrected requests, a load under an earlier date, and deletions, by their changes alone."""
    where, rows = new_layers(spark), requests(spark, sf_dir, closed=True)
    kind = F.col("unique_key") % 50

    def silver(part: DataFrame, as_of: str) -> None:
        jobs.bronze_job(part, where, as_of)
        jobs.silver_job(spark, where, as_of)

    silver(rows.filter(kind != 3), "2001-07-01")
    jobs.gold_job(spark, where)
    silver(rows.filter(kind == 1).withColumn("created_date", F.col("created_date") + F.expr("interval 40 days")), "2001-07-02")
    silver(rows.filter(kind == 2).withColumn("agency", F.lit(None).cast("string")), "2001-07-03")
    jobs.gold_job(spark, where)
    silver(rows.filter(kind == 3), "2001-06-01")
    jobs.forget_job(spark, where, rows.filter(kind == 4).select("unique_key"))
    return rounded(jobs.gold_job(spark, where), ["y_ma7"])


@query(with_sql(REQ, DAILY, GOLD, select="SELECT *, CAST(date_trunc('month', ds) AS DATE) AS month FROM gold"))
def gold_job(spark, sf_dir):
    where = new_layers(spark)
    up_to_gold(spark, sf_dir, where)
    return rounded(layers.read_layer(spark, where.gold), ["y_ma7"])


@query(
    with_sql(REQ, DAILY, TOTAL, fit_sql("total", []), forecast_sql([], 14, Z95), select=f"SELECT ds, {ROUND_BAND} FROM f")
)
def forecast_job(spark, sf_dir):
    where = new_layers(spark)
    up_to_gold(spark, sf_dir, where)
    return rounded(jobs.forecast_job(spark, where, method="trend"), BAND)


@query(
    with_sql(
        REQ, DAILY, BOROUGHS, ols_sql("line", "boroughs", ["borough"]),
        select=f"""
SELECT borough, ds, {OLS_BAND} FROM (SELECT borough, ds, yhat FROM line_f UNION ALL SELECT * FROM {ols_ahead_sql("line", 14)})
JOIN line_s USING (borough)""",
    )
)
def forecast_job_regression(spark, sf_dir):
    """The regression without penalties, which is least squares, so that SQL gives its numbers."""
    where = new_layers(spark)
    up_to_gold(spark, sf_dir, where)
    return rounded(jobs.forecast_job(spark, where, ["borough"], model_params=unpenalised()), BAND)


TOTAL_FLAGS = """flags AS (
  SELECT total.ds, y, round(yhat_upper, 6) AS yhat_upper, y > yhat_upper AS is_anomaly
  FROM total LEFT JOIN f USING (ds))"""
ANOMALIES = with_sql(
    REQ,
    DAILY,
    TOTAL,
    fit_sql("total", []),
    forecast_sql([], 14, Z50),
    TOTAL_FLAGS,
    STREAK.format(source="flags", keys="1"),
    select="SELECT *, anomaly_streak >= 3 AS alert FROM streaks",
)
NARROW_BAND = Params(interval_width=0.5)


@query(ANOMALIES)
def anomaly_job(spark, sf_dir):
    where = new_layers(spark)
    up_to_gold(spark, sf_dir, where)
    jobs.forecast_job(spark, where, params=NARROW_BAND, method="trend")
    return rounded(jobs.anomaly_job(spark, where), ["yhat_upper"])


LINES = [unpenalised(), unpenalised(weekly=False)]
LINE_SCORES = ",\n".join([
    "cut AS (SELECT boroughs.*, max(ds) OVER (PARTITION BY borough) - 14 AS cutoff FROM boroughs)",
    *[ols_sql(f"try{i}", "cut", ["borough"], weekly=i == 0, train="ds <= cutoff") for i in range(2)],
    """scores AS (SELECT borough, trial, avg(abs(y - yhat) / greatest(y, 1)) AS mape FROM (
    SELECT 0 AS trial, borough, ds, cutoff, CAST(y AS DOUBLE) AS y, yhat FROM try0_f UNION ALL SELECT 1, borough, ds, cutoff, CAST(y AS DOUBLE), yhat FROM try1_f)
  WHERE ds > cutoff GROUP BY ALL)""",
])


@query(with_sql(REQ, DAILY, select="""
SELECT DISTINCT 'requests/' || replace(borough, '/', '\\/') AS model_name, TRUE AS promoted, TRUE AS is_lowest, CAST(20 AS BIGINT) AS versions,
       CAST(20 AS BIGINT) AS models FROM daily
"""))
def tune_job(spark, sf_dir):
    """Each series: the promoted version has the lowest score, and every version has a stored model."""
    where = new_layers(spark)
    up_to_gold(spark, sf_dir, where)
    decided = jobs.tune_job(spark, where, ["borough"])
    runs = layers.read_layer(spark, where.model_runs).groupBy("model_name").agg(
        F.min(F.col("mape").cast("double")).alias("lowest"), F.count(F.lit(1)).alias("versions")
    )
    models = layers.read_layer(spark, where.coefficients).groupBy("model_name").agg(F.countDistinct("version").alias("models"))
    joined = decided.join(runs, "model_name").join(models, "model_name")
    return joined.select("model_name", "promoted", (F.col("best_mape") == F.col("lowest")).alias("is_lowest"), "versions", "models")


@query(
    with_sql(
        REQ, DAILY, BOROUGHS, LINE_SCORES,
        select="""SELECT 'requests/' || replace(borough, '/', '\\/') AS model_name, CAST(trial + 1 AS BIGINT) AS version, round(mape, 6) AS mape,
  CASE WHEN row_number() OVER (PARTITION BY borough ORDER BY mape, trial) = 1 THEN 'Staging' ELSE 'None' END AS stage FROM scores""",
    )
)
def tune_job_numbers(spark, sf_dir):
    """Held-out scores and stages of two settings whose fits SQL can solve."""
    where = new_layers(spark)
    up_to_gold(spark, sf_dir, where)
    jobs.tune_job(spark, where, ["borough"], trials=LINES)
    runs = layers.read_layer(spark, where.model_runs)
    return rounded(runs.select("model_name", "version", F.col("mape").cast("double").alias("mape"), "stage"), ["mape"])


@query(
    with_sql(
        REQ, DAILY, BOROUGHS, LINE_SCORES, *[ols_sql(f"line{i}", "boroughs", ["borough"], weekly=i == 0) for i in range(2)],
        "best AS (SELECT borough, trial FROM scores QUALIFY row_number() OVER (PARTITION BY borough ORDER BY mape, trial) = 1)",
        select=f"""SELECT borough, ds, {OLS_BAND} FROM (
  SELECT 0 AS trial, a.*, sigma FROM {ols_ahead_sql("line0", 14)} a JOIN line0_s USING (borough)
  UNION ALL SELECT 1, a.*, sigma FROM {ols_ahead_sql("line1", 14)} a JOIN line1_s USING (borough)) JOIN best USING (borough, trial)""",
    )
)
def infer_job(spark, sf_dir):
    """Tune, promote, set the stage, and forecast from the stored models."""
    where = new_layers(spark)
    up_to_gold(spark, sf_dir, where)
    jobs.tune_job(spark, where, ["borough"], trials=LINES)
    jobs.stage_job(spark, where)
    return rounded(jobs.infer_job(spark, where, ["borough"]), BAND).drop("model_name", "version")


@query(ANOMALIES)
def run_all(spark, sf_dir):
    raw: DataFrame = requests(spark, sf_dir, closed=True)
    result = jobs.run_all(spark, raw, new_layers(spark), AS_OF, params=NARROW_BAND, method="trend")
    return rounded(result, ["yhat_upper"])
