"""Physical plans: pushdown, pruning, shuffles, early reduction of hot keys."""

import re
from contextlib import redirect_stdout
from datetime import date
from io import StringIO

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from calltide.operators import conform, merge, series
from calltide.sources import layers, slices
from calltide.sources.requests import requests, table


def plan(df) -> str:
    out = StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def exchanges(text: str) -> int:
    return len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition)", text))


def test_time_range_and_columns_reach_the_scan(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    text = plan(slices.trailing_window(rows, "o_orderdate", "2000-01-01T00:00:00").select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_daily_counts_read_only_their_columns(spark, sf_dir):
    text = plan(series.daily_counts(requests(spark, sf_dir), "created_date"))
    assert "o_totalprice" not in text and "lineitem" not in text and "c_acctbal" not in text
    assert "partial_count" in text


def test_conform_reads_only_core_columns(spark, tmp_path):
    layers.overwrite_layer(
        spark.createDataFrame([("1", "x", "y")], "unique_key string, borough string, junk string"),
        layers.Layer(str(tmp_path), "raw"),
    )
    text = plan(conform.conform(layers.read_layer(spark, layers.Layer(str(tmp_path), "raw"))))
    assert "junk" not in text.split("ReadSchema")[1]


def test_incremental_slice_prunes_partitions(spark, tmp_path):
    layer = layers.Layer(str(tmp_path), "bronze")
    df = spark.createDataFrame([(i, date(2024, 1, 1 + i)) for i in range(5)], "k int, ingestion_date date")
    layers.overwrite_layer(df, layer, ["ingestion_date"])
    bronze = layers.read_layer(spark, layer)
    text = plan(slices.incremental_slice(bronze, bronze.filter("k < 3"), "ingestion_date"))
    scan = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "ingestion_date" in scan and "ubquery" in scan
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_jobs_read_only_partitions_that_changed(spark, sf_dir, tmp_path):
    """On the layout the jobs write: Bronze by month of receipt, Silver by month of creation."""
    from calltide.params import Params
    from calltide.plans import jobs

    where = jobs.Layers(str(tmp_path / "layers"))
    raw = requests(spark, sf_dir, closed=True)
    month = raw.filter("created_date >= TIMESTAMP_NTZ '1997-03-01' AND created_date < TIMESTAMP_NTZ '1997-04-01'")
    jobs.bronze_job(raw, where, "2001-07-01")
    jobs.silver_job(spark, where, "2001-07-01")
    jobs.gold_job(spark, where)
    jobs.bronze_job(month.withColumn("complaint_type", F.lit("other")), where, "2001-08-01")
    _, rows, _ = jobs._bronze_slice(spark, where, Params(overlap_days=0), False, None)
    assert rows.count() == month.count()
    assert "dynamicpruning" in plan(rows).split("/bronze/")[0]
    jobs.silver_job(spark, where, "2001-08-01", Params(overlap_days=0))
    changes = jobs._net_changes(spark, where, jobs._open_runs(spark, where))
    months = changes.select("month").distinct().withColumn("kind", F.lit("x")).filter("kind = 'x'").select("month")
    assert [str(r.month) for r in months.collect()] == ["1997-03-01"]
    months = layers.parked(months.withColumn("kind", F.lit("x")), "months").filter("kind = 'x'").select("month")
    counts = jobs.gold_changes(layers.read_layer(spark, where.daily), changes, months)
    assert "dynamicpruning" in plan(counts).split("/daily/")[0]
    assert "/silver/" not in plan(counts) and "/bronze/" not in plan(counts)


def test_dedup_drops_losers_before_the_shuffle(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    text = plan(merge.dedup_latest(lines, ["l_orderkey"], ["l_shipdate"], null_keys="drop"))
    below = text.split("Exchange hashpartitioning")[1]
    assert "partial_max" in below


def test_hot_key_reaches_the_reducer_as_one_row_per_task(spark, tmp_path):
    df = spark.range(0, 60_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("t")
    )
    latest = merge.dedup_latest(df, ["k"], ["t"])
    assert latest.filter("k = -1").collect() == [(-1, 59_997)]
    assert latest.count() == 40_001


def test_two_features_share_one_window(spark, sf_dir):
    text = plan(series.gold_features(requests(spark, sf_dir), "created_date"))
    assert text.count("+- Window [") == 1


@pytest.mark.parametrize(
    "name", ["gold_features", "breach_streak", "forecast_trend_seasonal", "backtest", "rolling_origin_backtest"]
)
def test_keyed_queries_never_gather_in_one_partition(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert "SinglePartition" not in text
    assert "Python" not in text and "Pandas" not in text


def test_backtest_needs_no_join_after_the_daily_totals(spark, sf_dir):
    daily = series.series_total(series.daily_counts(requests(spark, sf_dir), "created_date"), ["borough"])
    from calltide.operators.evaluate import backtest

    text = plan(backtest(daily, ["borough"]))
    assert text.count("Join") == plan(daily).count("Join")


def test_python_only_where_planned(spark, sf_dir):
    lazy = [n for n in entry.queries() if not n.endswith("_job") and n not in ("run_all",)]
    python = set()
    for name in ("conform", "upsert", "quality_report", "missing_dates", "forecast_metrics", "promote_if_better"):
        assert name in lazy
        if "Pandas" in plan(entry.queries()[name](spark, sf_dir)):
            python.add(name)
    assert not python
    assert "FlatMapGroupsInPandas" in plan(entry.queries()["forecast_regression"](spark, sf_dir))


def test_regression_fit_shuffles_each_series_once(spark):
    from calltide.operators.regression import fit_regression

    daily = spark.createDataFrame([("a", date(2024, 1, 1), 1)], "k string, ds date, y bigint")
    assert exchanges(plan(fit_regression(daily, ["k"]))) == 1


def test_null_keys_do_not_meet_in_one_reducer(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = spark.range(0, 8000, 1, 8).selectExpr("CASE WHEN id % 2 = 0 THEN id + 100 END AS k", "id AS v")
        staged = spark.range(0, 10).select(F.col("id").alias("k"), F.col("id").alias("v"))
        merged = merge.upsert(target, staged, ["k"])
        assert merged.count() == 8010
        text = plan(merged)
        assert "__apart" in text.split("Exchange hashpartitioning(")[1].split(")")[0]
        assert exchanges(text) == 2  # the two sides of the join
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedup_and_upsert_read_each_input_once(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    assert plan(merge.dedup_latest(lines, ["l_orderkey"], ["l_shipdate"])).count("FileScan") == 1
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("l_shipdate"))
    text = plan(merge.upsert(lines, orders, ["l_orderkey"]))
    assert text.count("lineitem.parquet") == 1


@pytest.mark.parametrize("name", ["gold_features", "upsert", "breach_streak", "dedup_latest"])
def test_result_does_not_depend_on_partitioning(spark, sf_dir, rows, name):
    few = rows(entry.queries()[name](spark, sf_dir))
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert rows(entry.queries()[name](spark, sf_dir)) == few
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_hot_customer_is_split_over_tasks(spark, tmp_path):
    """A customer with a third of all orders: adaptive execution splits its join partition."""
    n = 120_000
    tables = {
        "orders": spark.range(n).selectExpr(
            "id AS o_orderkey",
            "CASE WHEN id % 3 = 0 THEN 7L ELSE id % 1000 END AS o_custkey",
            "'F' AS o_orderstatus",
            "TIMESTAMP_NTZ '1998-01-01' + make_interval(0, 0, 0, CAST(id % 90 AS INT)) AS o_orderdate",
            "'1-URGENT' AS o_orderpriority",
        ),
        "customer": spark.range(1000).selectExpr("id AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey", "'A' AS c_mktsegment"),
        "nation": spark.range(25).selectExpr("CAST(id AS INT) AS n_nationkey", "'N' || id AS n_name", "CAST(id % 5 AS INT) AS n_regionkey"),
        "region": spark.range(5).selectExpr("CAST(id AS INT) AS r_regionkey", "'R' || id AS r_name"),
    }
    for name, df in tables.items():
        df.repartition(8).write.parquet(f"{tmp_path}/{name}.parquet")
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        daily = series.daily_counts(requests(spark, str(tmp_path)), "created_date")
        assert daily.agg(F.sum("y")).first()[0] == n
        daily.collect()
        assert "skew=true" in plan(daily)
    finally:
        for k in small:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_no_rows_travel_through_the_driver():
    """Only the failed rules of a quality report, the names of emptied folders and one model without coefficients are collected."""
    from pathlib import Path

    import calltide

    found = []
    for path in Path(calltide.__file__).parent.rglob("*.py"):
        if "llm" in path.parts:  # has its own bounds and checks
            continue
        for line in path.read_text().splitlines():
            if re.search(r"\.(collect|toPandas|toLocalIterator|localCheckpoint|crossJoin|rdd|take|first|head)\(", line):
                found.append(f"{path.name}: {line.strip()}")
    allowed = ("one row per failed rule", "folder names", "limit(1).first()")
    assert len(found) == 3 and all(any(a in f for a in allowed) for f in found), found


def test_customers_are_not_broadcast_for_their_nations(spark, sf_dir):
    """Spark takes the product of two file sizes for that of a join, which well compressed customers can stay below."""
    for closed in (False, True):
        text = plan(requests(spark, sf_dir, closed))
        assert re.search(r"BroadcastHashJoin \[c_nationkey#\d+L?\], \[n_nationkey#\d+L?\], Inner, BuildRight", text), text


def test_a_hundred_thousand_keys_are_not_broadcast(spark, sf_dir):
    """180,000 keys made relations of 21 MB on the driver."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    assert "SortMergeJoin" in plan(merge.upsert(orders, orders, ["o_orderkey"], n=180_000))
    assert "BroadcastHashJoin" in plan(merge.upsert(orders, orders, ["o_orderkey"], n=1_000))
