"""Upserts into partitioned and bucketed catalog tables."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from calltide.sources import tables

SCHEMA = "k long, v string, p string"


@pytest.fixture
def name(spark):
    made = f"t_{uuid.uuid4().hex}"
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made}")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def state(spark, name):
    return sorted(map(tuple, spark.table(name).select("k", "v", "p").collect()), key=str)


@pytest.mark.parametrize("buckets", [0, 3])
def test_upsert_equals_a_dictionary(spark, name, buckets):
    rng = random.Random(buckets)
    held, loose = {}, []
    for step in range(4):
        keys = rng.sample(range(30), 8)
        rows = [(k, f"v{step}", rng.choice(["a", "b", "c", None])) for k in keys] + [(None, f"n{step}", "a")]
        if step == 3:
            rows = [(k, "last", "z") for k in held] + [(None, "n3", None)]  # all move, which empties partitions
        tables.upsert_table(frame(spark, rows), name, ["k"], [], ["p"], buckets)
        held.update({k: (k, v, p) for k, v, p in rows if k is not None})
        loose += [r for r in rows if r[0] is None]
        assert state(spark, name) == sorted([*held.values(), *loose], key=str)
    assert {r.p for r in spark.table(name).select("p").distinct().collect()} == {"a", "z", None}
    if not buckets:
        return
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert told["Num Buckets"] == "3" and told["Bucket Columns"] == "[`k`]"


def test_new_columns_join_and_lost_ones_raise(spark, name):
    tables.upsert_table(frame(spark, [(1, "a", "x"), (2, "b", "y")]), name, ["k"], None, ["p"], 2)
    tables.upsert_table(frame(spark, [(1, "c", "x")]).withColumn("w", F.lit(7)), name, ["k"], None, ["p"], 2)
    assert sorted((r.k, r.v, r.w) for r in spark.table(name).collect()) == [(1, "c", 7), (2, "b", None)]
    with pytest.raises(ValueError, match="lack"):
        tables.upsert_table(frame(spark, [(1, "c", "x")]), name, ["k"], None, ["p"], 2)


def test_a_bucketed_target_is_not_shuffled(spark, name):
    rows = spark.range(5000).selectExpr("id AS k", "CAST(id AS STRING) AS v", "CAST(id % 4 AS STRING) AS p")
    tables.overwrite_table(rows, name, ["p"], ["k"], 8)
    staged = tables.parked(rows.limit(10).unionByName(rows.filter("k = 4999")), "staged")
    target = spark.table(name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = tables.homes(target, staged, ["k"], ["p"])
        touched = tables.parked(found.withColumn("kind", F.lit("x")), "x").filter("kind = 'x'").select("p")
        for df in (found, target.join(staged.select("k"), ["k"], "left_anti")):
            text = df._jdf.queryExecution().executedPlan().toString()
            above = [line for line in text.splitlines() if name in line or "Exchange hashpartitioning(k" in line]
            assert sum("Exchange hashpartitioning(k" in line for line in above) == 1, text  # the staged side
            assert "Bucketed: true" in text
        assert tables.merged(target, staged, ["k"], touched, ["p"]).count() == 5000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_untouched_partitions_keep_their_files(spark, name):
    rows = spark.range(400).selectExpr("id AS k", "CAST(id AS STRING) AS v", "CAST(id % 4 AS STRING) AS p")
    tables.upsert_table(rows, name, ["k"], None, ["p"], 2)
    files = lambda: {r.f for r in spark.table(name).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    before = files()
    tables.upsert_table(frame(spark, [(1, "new", "1"), (401, "new", "3")]), name, ["k"], None, ["p"], 2)
    gone = {f.split("p=")[1][0] for f in before - files()}
    assert gone == {"1", "3"} and spark.table(name).count() == 401
