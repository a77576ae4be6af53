"""Queries on sources, sinks, slices, cleaning and merging."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calltide.functions.columns import join_series
from calltide.functions.columns import normalize_columns as normalize_names
from calltide.functions.times import NTZ
from calltide.functions.times import parse_utc as parse_utc_text
from calltide.functions.times import to_utc as to_utc_wall
from calltide.operators import conform as conforming
from calltide.operators import merge
from calltide.plans.registry import REQ, query, with_sql
from calltide.sources import layers, pages, slices, tables
from calltide.sources.requests import requests, table
from calltide.sources.scratch import shared_dir

ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.read_layer(spark, f"{sf_dir}/orders.parquet")


def new_layer(spark: SparkSession, name: str) -> layers.Layer:
    return layers.Layer(shared_dir(spark, "layers"), name)


def raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests as they arrive: all text, some keys and times malformed."""
    key = F.col("unique_key")
    return requests(spark, sf_dir, closed=True).select(
        F.when(key % 97 == 0, F.concat(F.lit("x"), key)).otherwise(key.cast("string")).alias("unique_key"),
        F.when(key % 89 == 0, F.lit("not a date"))
        .otherwise(F.date_format("created_date", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .alias("created_date"),
        F.date_format("closed_date", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("closed_date"),
        "agency",
        "agency_name",
        "complaint_type",
        "borough",
        "status",
        F.lit("unused").alias("extra_column"),
    )


# Cleaned keys and times of raw_requests.
CLEAN = """clean AS (
  SELECT CASE WHEN unique_key % 97 = 0 THEN NULL ELSE unique_key END AS unique_key,
         CASE WHEN unique_key % 89 = 0 THEN NULL ELSE created_date END AS created_date, closed_date,
         agency, agency_name, complaint_type, CAST(NULL AS VARCHAR) AS descriptor, borough,
         CAST(NULL AS VARCHAR) AS incident_zip, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
         status
  FROM req
)"""


@query(f"SELECT {ORDERS} FROM orders")
def read_layer(spark, sf_dir):
    return orders(spark, sf_dir)


@query(
    "SELECT o_orderkey, o_orderdate FROM orders "
    "WHERE o_orderdate >= TIMESTAMP '1999-10-02' AND o_orderdate < TIMESTAMP '2000-01-01 12:34:56'"
)
def trailing_window(spark, sf_dir):
    rows = orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    return slices.trailing_window(rows, "o_orderdate", "2000-01-01T12:34:56", sample_days=90, overlap_days=1)


@query(
    "SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders "
    "WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'"
)
def slice_time(spark, sf_dir):
    rows = orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "o_orderstatus")
    return slices.slice_time(rows, "o_orderdate", "1996-01-01", "1997-01-01")


@query("SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, value, props FROM events")
def read_landed_pages(spark, sf_dir):
    landed = shared_dir(spark, "pages")
    events = table(spark, sf_dir, "events")
    events.select("event_id", "user_id", "event_type", "value", "props").write.json(landed)
    read = pages.read_landed_pages(spark, landed, ["event_id", "user_id", "event_type", "value", "props"])
    return read.withColumns(
        {"event_id": F.col("event_id").try_cast("bigint"), "value": F.col("value").try_cast("double")}
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw records whose headings vary in case and spacing."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS ` Event ID`", "event_type AS `EVENT TYPE`", "value AS `Value\t`", "to_date(ts) AS day"
    )


PAGE = 1000  # records of a page, as a mean; hashes deal them out


def _paged(rows: DataFrame) -> DataFrame:
    """Records of a day and event type in pages of bounded size, as many as the group's count asks for."""
    group = ["day", "EVENT TYPE"]
    n = rows.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / PAGE).alias("pages"))
    numbered = join_series(rows, n, group).withColumn("number", F.pmod(F.xxhash64("` Event ID`"), F.col("pages")))
    record = F.struct("` Event ID`", "`EVENT TYPE`", "`Value\t`")
    return numbered.groupBy(*group, "number").agg(F.collect_list(record).alias("page"))


@query("SELECT event_id, event_type, value FROM events")
def read_array_pages(spark, sf_dir):
    """Pages as arrays on a line, as indented arrays that fill a file, and as lines of records, one third of the days each."""
    rows, folded = _events(spark, sf_dir), ["event_id", "event_type", "value"]
    third = F.pmod(F.datediff("day", F.lit("2024-01-01")), F.lit(3))
    record = F.struct("` Event ID`", "`EVENT TYPE`", "`Value\t`")
    paged = _paged(rows).withColumn("third", third)
    lines, files, loose = (shared_dir(spark, f"pages-{i}") for i in range(3))
    paged.filter("third = 0").select(F.to_json("page")).write.text(lines)
    indented = paged.filter("third = 1").select(F.to_json("page", {"pretty": "true"}))
    indented.write.option("maxRecordsPerFile", 1).text(files)
    rows.filter(third == 2).select(F.to_json(record)).write.text(loose)
    read = pages.read_landed_pages(spark, [lines, loose], folded, fold_names=True).unionByName(
        pages.read_landed_pages(spark, files, folded, fold_names=True, multiline=True)
    )
    return read.withColumns({"event_id": F.col("event_id").try_cast("bigint"), "value": F.col("value").try_cast("double")})


@query("""
SELECT CASE WHEN value < 5 THEN 'no record' ELSE 'name given twice' END AS reason, count(*) AS records
FROM events WHERE value < 10 GROUP BY ALL
""")
def landed_rejects(spark, sf_dir):
    """Lines cut short and lines that name a column twice among whole ones."""
    whole = F.to_json(F.struct("event_id", "event_type", "value"))
    twice = F.concat(F.lit('{"Value": "0", '), F.substring(whole, 2, 100_000))
    line = F.when(F.col("value") < 5, F.substring(whole, 1, 12)).when(F.col("value") < 10, twice).otherwise(whole)
    landed = shared_dir(spark, "pages")
    table(spark, sf_dir, "events").select(line).write.text(landed)
    rejects = pages.landed_rejects(spark, landed, ["event_id", "event_type", "value"], fold_names=True)
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


def new_table(spark: SparkSession, name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def overwrite_table(spark, sf_dir):
    name = new_table(spark, "replaced")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    tables.overwrite_table(lines.withColumn("l_quantity", -F.col("l_quantity")), name, ["l_returnflag"])
    tables.overwrite_table(spark.table(name).withColumn("l_quantity", -F.col("l_quantity")), name, ["l_returnflag"])
    return spark.table(name)


@query("""
SELECT event_id, event_type, NULL AS note, CAST(ts AS DATE) AS day FROM events
UNION ALL SELECT event_id, event_type, 'late', CAST(ts AS DATE) FROM events
""")
def append_table(spark, sf_dir):
    name = new_table(spark, "appended")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    tables.append_table(events, name)
    tables.append_table(events.withColumn("note", F.lit("late")), name)
    return spark.table(name)


@query("""
SELECT o_orderkey AS unique_key, o_orderdate AS created_date, o_orderstatus AS status, NULL AS event_type FROM orders
UNION ALL SELECT event_id, ts, NULL, event_type FROM events
""")
def union_pages(spark, sf_dir):
    first = orders(spark, sf_dir).selectExpr(
        "o_orderkey AS unique_key", "o_orderdate AS created_date", "o_orderstatus AS status"
    )
    second = table(spark, sf_dir, "events").selectExpr("ts AS created_date", "event_type", "event_id AS unique_key")
    return pages.union_pages([first, second])


@query("""
SELECT event_id, event_type, value, CAST(ts AS DATE) AS day FROM events
UNION ALL SELECT l_orderkey, l_returnflag, l_quantity, DATE '2024-02-01' FROM lineitem
""")
def append_layer(spark, sf_dir):
    layer = new_layer(spark, "appended")
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.to_date("ts").alias("day")
    )
    late = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS event_id", "l_returnflag AS event_type", "l_quantity AS value", "DATE '2024-02-01' AS day"
    )
    layers.append_layer(events, layer, ["day"])
    layers.append_layer(late, layer)
    return layers.read_layer(spark, layer)


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def overwrite_layer(spark, sf_dir):
    layer = new_layer(spark, "replaced")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    layers.overwrite_layer(lines.withColumn("l_quantity", -F.col("l_quantity")), layer, ["l_returnflag"])
    layers.overwrite_layer(lines, layer, ["l_returnflag"], only_present=True)
    return layers.read_layer(spark, layer)


TWO_BATCHES = with_sql(
    REQ,
    select="""
SELECT unique_key, created_date, status, NULL AS note FROM req WHERE created_date < TIMESTAMP '1998-06-01'
UNION ALL SELECT unique_key, created_date, 'R', 'late' FROM req WHERE created_date >= TIMESTAMP '1998-06-01'
""",
)


def two_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two loads whose time ranges overlap by seven months; the second one changes the status."""
    rows = requests(spark, sf_dir).select("unique_key", "created_date", "status")
    created = F.col("created_date")
    target = rows.filter(created.isNull() | (created < F.lit("1999-01-01").cast(NTZ)))
    staged = rows.filter(created >= F.lit("1998-06-01").cast(NTZ)).withColumn("status", F.lit("R"))
    return target, staged


@query(TWO_BATCHES)
def upsert(spark, sf_dir):
    target, staged = two_batches(spark, sf_dir)
    return merge.upsert(target, staged.withColumn("note", F.lit("late")), ["unique_key"])


@query(TWO_BATCHES.replace(", NULL AS note", "").replace(", 'late'", ""))
def upsert_table(spark, sf_dir):
    name = new_table(spark, "merged")
    for batch in two_batches(spark, sf_dir):
        tables.upsert_table(batch, name, ["unique_key"], ["created_date"])
    return spark.table(name)


@query(
    with_sql(
        REQ,
        select="""
SELECT unique_key, created_date, CASE WHEN created_date < TIMESTAMP '1998-06-01' THEN status ELSE 'R' END AS status,
       CAST(date_trunc('month', created_date) AS DATE) AS month FROM req
""",
    )
)
def upsert_table_bucketed(spark, sf_dir):
    """Into a table partitioned by month and bucketed by key, which a merge does not shuffle."""
    name = new_table(spark, "bucketed")
    for batch in two_batches(spark, sf_dir):
        staged = batch.select("unique_key", "created_date", "status").withColumn("month", F.trunc("created_date", "month"))
        tables.upsert_table(staged, name, ["unique_key"], ["created_date"], ["month"], buckets=8)
    return spark.table(name)


@query(
    with_sql(
        REQ,
        select="""
SELECT unique_key, created_date, CASE WHEN created_date < TIMESTAMP '1998-06-01' THEN status ELSE 'R' END AS status,
       CAST(date_trunc('month', created_date) AS DATE) AS month FROM req
""",
    )
)
def upsert_layer(spark, sf_dir):
    layer = new_layer(spark, "merged")
    for batch in two_batches(spark, sf_dir):
        staged = batch.withColumn("month", F.trunc("created_date", "month"))
        layers.upsert_layer(staged, layer, ["unique_key"], ["created_date"], ["month"])
    return layers.read_layer(spark, layer)


@query(
    with_sql(
        REQ,
        select="""
SELECT unique_key, created_date, CASE WHEN created_date < TIMESTAMP '1998-06-01' THEN status ELSE 'R' END AS status,
       CAST(year(created_date) AS INTEGER) AS received_year, CAST(month(created_date) AS INTEGER) AS received_month FROM req
""",
    )
)
def write_bronze(spark, sf_dir):
    layer = new_layer(spark, "bronze")
    for batch in two_batches(spark, sf_dir):
        layers.write_bronze(pages.add_received_parts(batch), layer)
    return layers.read_layer(spark, layer)


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def compact_layer(spark, sf_dir):
    layer = new_layer(spark, "compacted")
    layers.overwrite_layer(orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "o_totalprice"), layer)
    layers.compact_layer(spark, layer)
    return layers.read_layer(spark, layer)


@query(f"SELECT {ORDERS} FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 5")
def preview(spark, sf_dir):
    rows = orders(spark, sf_dir)
    return slices.preview(rows, [F.desc("o_orderdate"), F.asc("o_orderkey")], 5)


@query("SELECT count(*) AS records, min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts FROM orders")
def ingest_summary(spark, sf_dir):
    return slices.ingest_summary(orders(spark, sf_dir), "o_orderdate")


@query(f"SELECT {ORDERS} FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-07-17'")
def load_day(spark, sf_dir):
    return slices.load_day(orders(spark, sf_dir), "o_orderdate", "1998-07-17")


@query("""
SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-05-04' AND o_orderdate < TIMESTAMP '1998-08-02'
""")
def backfill(spark, sf_dir):
    layer = new_layer(spark, "backfilled")
    rows = slices.backfill(orders(spark, sf_dir), "o_orderdate", "1998-08-02T06:00:00", days=90)
    dated = rows.select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    layers.overwrite_layer(dated, layer, ["day"], only_present=True)
    return layers.read_layer(spark, layer)


@query("""
SELECT count(*) AS records FROM orders
WHERE CAST(o_orderdate AS DATE) > DATE '1998-07-26' AND CAST(o_orderdate AS DATE) <= DATE '1998-08-02'
""")
def recent_count(spark, sf_dir):
    dated = orders(spark, sf_dir).select(F.to_date("o_orderdate").alias("day"))
    return slices.recent_count(dated, "day", "1998-08-02", days=7)


@query("""
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '2000-06-01') - INTERVAL 1 DAY
""")
def incremental_slice(spark, sf_dir):
    rows = orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    loaded = rows.filter(F.col("o_orderdate") < F.lit("2000-06-01").cast(NTZ))
    return slices.incremental_slice(rows, loaded, "o_orderdate", overlap_days=1)


@query("SELECT p_partkey AS part_key, p_name AS part_name, p_retailprice AS retail_price FROM part")
def normalize_columns(spark, sf_dir):
    messy = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS ` Part Key`", "p_name AS `PART NAME `", "p_retailprice AS `Retail Price`"
    )
    return normalize_names(messy)


@query(
    with_sql(
        REQ,
        select="""
SELECT unique_key AS request, CASE WHEN unique_key % 89 = 0 THEN NULL ELSE created_date END AS created_utc,
       closed_date AS closed_utc FROM req
""",
    )
)
def parse_utc(spark, sf_dir):
    raw = raw_requests(spark, sf_dir)
    return raw.select(
        F.regexp_replace("unique_key", "x", "").cast("bigint").alias("request"),
        parse_utc_text(F.col("created_date")).alias("created_utc"),
        parse_utc_text(F.col("closed_date")).alias("closed_utc"),
    )


@query("""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS received_year, CAST(month(o_orderdate) AS INTEGER) AS received_month
FROM orders
""")
def add_received_parts(spark, sf_dir):
    rows = orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    return pages.add_received_parts(rows, "o_orderdate").drop("o_orderdate")


@query("SELECT o_orderkey, DATE '2001-08-02' AS ingestion_date FROM orders")
def stamp_ingestion(spark, sf_dir):
    return pages.stamp_ingestion(orders(spark, sf_dir).select("o_orderkey"), "2001-08-02T03:00:00")


@query(with_sql(REQ, CLEAN, select="SELECT * FROM clean"))
def conform(spark, sf_dir):
    return conforming.conform(raw_requests(spark, sf_dir))


@query("""
SELECT event_id, ts AS local_ts, (ts AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS utc_ts FROM events
""")
def to_utc(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("local_ts"), to_utc_wall(F.col("ts"), "America/New_York").alias("utc_ts")
    )


SILVER = """silver AS (
  SELECT * EXCLUDE (created_date, closed_date), created_date AS created_ts_utc, closed_date AS closed_ts_utc,
         closed_date IS NOT NULL AS is_closed FROM clean
)"""


@query(with_sql(REQ, CLEAN, SILVER, select="SELECT * FROM silver"))
def silver(spark, sf_dir):
    return conforming.to_silver(conforming.conform(raw_requests(spark, sf_dir)))


@query("""
SELECT l_orderkey, l_shipdate, l_linenumber, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_shipdate DESC, l_linenumber DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn = 1
""")
def dedup_latest(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", "l_quantity")
    return merge.dedup_latest(lines, ["l_orderkey"], ["l_shipdate"], one_pass=False)


@query("""
SELECT c_custkey, c_nationkey AS nation_key, n_name, n_regionkey
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def enrich_lookup(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_nationkey AS nation_key")
    places = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "nation_key")
    return conforming.enrich_lookup(customers, places, "nation_key")
