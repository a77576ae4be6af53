"""Stored layers: appends, overwrites, upserts, commits."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from calltide.operators.quality import QualityError, SILVER_RULES, enforce
from calltide.sources import layers
from calltide.sources.layers import Layer


@pytest.fixture
def layer(tmp_path):
    return Layer(str(tmp_path), "t")


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, t int, v string, p int")


def read(spark, layer):
    return sorted((tuple(r) for r in layers.read_layer(spark, layer).collect()), key=str)


def folders(layer):
    from pathlib import Path

    return sorted(p.name for p in Path(layer.path).iterdir() if p.name.startswith("data-"))


def test_missing_layer(spark, layer):
    assert not layers.layer_exists(spark, layer)
    with pytest.raises(FileNotFoundError):
        layers.read_layer(spark, layer)


def test_preview_layer(spark, layer):
    assert layers.preview_layer(spark, layer, ["k"]) is None
    layers.overwrite_layer(frame(spark, [(k, 1, "a", 1) for k in range(9, 0, -1)]), layer)
    assert [r.k for r in layers.preview_layer(spark, layer, ["k"], 3).collect()] == [1, 2, 3]


def test_append_widens_schema_and_rejects_type_changes(spark, layer):
    layers.append_layer(spark.createDataFrame([(1, "a")], "k int, v string"), layer)
    layers.append_layer(spark.createDataFrame([(2, "b", 7)], "k int, v string, w int"), layer)
    layers.append_layer(spark.createDataFrame([(3,)], "k int"), layer)
    assert read(spark, layer) == [(1, "a", None), (2, "b", 7), (3, None, None)]
    with pytest.raises(ValueError, match="v"):
        layers.append_layer(spark.createDataFrame([(1, 2)], "k int, v int"), layer)


def test_overwrite_replaces_schema_and_keeps_old_folder_until_expired(spark, layer):
    layers.overwrite_layer(frame(spark, [(1, 1, "a", 1)]), layer, ["p"])
    old = layers.read_layer(spark, layer)
    layers.overwrite_layer(spark.createDataFrame([("x",)], "n string"), layer)
    assert read(spark, layer) == [("x",)]
    assert old.count() == 1
    assert layers.expire_folders(spark, layer) == ["data-00000001"]
    assert read(spark, layer) == [("x",)]


def test_partition_values_keep_their_types(spark, layer):
    df = spark.createDataFrame(
        [(1, "007", date(2024, 1, 1)), (2, None, None)], "k int, code string, d date"
    )
    layers.overwrite_layer(df, layer, ["code", "d"])
    assert read(spark, layer) == [(1, "007", date(2024, 1, 1)), (2, None, None)]
    assert layers.read_layer(spark, layer).schema == df.schema


def test_overwrite_only_present_partitions(spark, layer):
    layers.overwrite_layer(frame(spark, [(1, 1, "a", 1), (2, 1, "b", 2)]), layer, ["p"])
    layers.overwrite_layer(frame(spark, [(9, 1, "z", 2)]), layer, only_present=True)
    assert read(spark, layer) == [(1, 1, "a", 1), (9, 1, "z", 2)]


def test_upsert_rewrites_only_touched_partitions(spark, layer):
    base = [(k, 1, "old", k % 3) for k in range(9)]
    layers.upsert_layer(frame(spark, base), layer, ["k"], ["t"], ["p"])
    before = {f for f in file_names(spark, layer, "p <> 1")}
    layers.upsert_layer(frame(spark, [(1, 2, "new", 1), (1, 1, "late", 1), (10, 1, "in", 1)]), layer, ["k"], ["t"])
    assert folders(layer) == ["data-00000001"]
    assert {f for f in file_names(spark, layer, "p <> 1")} == before
    want = [r for r in base if r[0] != 1] + [(1, 2, "new", 1), (10, 1, "in", 1)]
    assert read(spark, layer) == sorted(want, key=str)


def file_names(spark, layer, where):
    df = layers.read_layer(spark, layer)
    return [r[0] for r in df.filter(where).select("_metadata.file_path").distinct().collect()]


@pytest.mark.parametrize("others", [True, False])
def test_upsert_of_a_key_that_changes_partition(spark, layer, others):
    base = [(1, 1, "a", 1), (2, 1, "b", 2)] + ([(3, 1, "c", 1)] if others else [])
    layers.upsert_layer(frame(spark, base), layer, ["k"], ["t"], ["p"])
    layers.upsert_layer(frame(spark, [(1, 2, "moved", 2)]), layer, ["k"], ["t"])
    assert read(spark, layer) == sorted([(1, 2, "moved", 2), *base[1:]], key=str)
    assert folders(layer) == ["data-00000001"]


def test_upsert_out_of_the_null_partition(spark, layer):
    layers.upsert_layer(frame(spark, [(1, 1, "a", None), (2, 1, "b", 2)]), layer, ["k"], ["t"], ["p"])
    layers.upsert_layer(frame(spark, [(1, 2, "dated", 5)]), layer, ["k"], ["t"])
    assert read(spark, layer) == [(1, 2, "dated", 5), (2, 1, "b", 2)]


def test_upsert_twice_changes_nothing_and_null_keys_insert(spark, layer):
    layers.upsert_layer(frame(spark, [(1, 1, "a", 1), (None, 1, "n", 1)]), layer, ["k"], ["t"], ["p"])
    batch = frame(spark, [(1, 2, "b", 1), (2, 2, "c", 3)])
    layers.upsert_layer(batch, layer, ["k"], ["t"])
    once = read(spark, layer)
    layers.upsert_layer(batch, layer, ["k"], ["t"])
    assert read(spark, layer) == once == sorted([(1, 2, "b", 1), (2, 2, "c", 3), (None, 1, "n", 1)], key=str)


def test_upsert_with_new_column(spark, layer):
    layers.upsert_layer(frame(spark, [(1, 1, "a", 1)]), layer, ["k"], ["t"], ["p"])
    layers.upsert_layer(frame(spark, [(2, 1, "b", 1)]).withColumn("w", F.lit(5)), layer, ["k"], ["t"])
    assert sorted((r.k, r.w) for r in layers.read_layer(spark, layer).collect()) == [(1, None), (2, 5)]
    assert folders(layer) == ["data-00000001"]
    with pytest.raises(ValueError, match="w"):
        layers.upsert_layer(frame(spark, [(3, 1, "c", 1)]), layer, ["k"], ["t"])


def test_failed_check_leaves_the_layer_alone(spark, layer):
    good = spark.createDataFrame([(1, "Noise")], "k int, complaint_type string")
    layers.upsert_layer(good, layer, ["k"])
    bad = spark.createDataFrame([(1, None)], "k int, complaint_type string")
    with pytest.raises(QualityError):
        layers.upsert_layer(bad, layer, ["k"], check=lambda df: enforce(df, SILVER_RULES[:1]))
    assert read(spark, layer) == [(1, "Noise")]


def test_write_bronze_chooses_by_key(spark, tmp_path):
    keyed, loose = Layer(str(tmp_path), "keyed"), Layer(str(tmp_path), "loose")
    rows = spark.createDataFrame([("1", "a", date(2024, 1, 1))], "unique_key string, v string, ingestion_date date")
    for _ in range(2):
        layers.write_bronze(rows, keyed)
        layers.write_bronze(rows.drop("unique_key"), loose)
    assert layers.read_layer(spark, keyed).count() == 1
    assert layers.read_layer(spark, loose).count() == 2


def test_compact_layer(spark, layer):
    for i in range(4):
        layers.append_layer(frame(spark, [(i, 1, "a", 1)]).repartition(3), layer)
    layers.compact_layer(spark, layer, 1)
    assert len(file_names(spark, layer, "true")) == 1
    assert layers.read_layer(spark, layer).count() == 4


def test_unpublished_data_is_invisible(spark, layer):
    """A run that dies before its commit leaves the old version readable."""
    layers.overwrite_layer(frame(spark, [(1, 1, "a", 1)]), layer)
    frame(spark, [(2, 1, "half", 1)]).write.parquet(f"{layer.path}/data-00000002")
    assert read(spark, layer) == [(1, 1, "a", 1)]
    layers.overwrite_layer(frame(spark, [(3, 1, "done", 1)]), layer)
    assert read(spark, layer) == [(3, 1, "done", 1)]


def test_upsert_into_a_new_folder(spark, layer):
    layers.upsert_layer(frame(spark, [(1, 1, "a", 1), (2, 1, "b", 2)]), layer, ["k"], ["t"], ["p"])
    layers.upsert_layer(frame(spark, [(1, 2, "moved", 2)]), layer, ["k"], ["t"], in_place=False)
    assert read(spark, layer) == [(1, 2, "moved", 2), (2, 1, "b", 2)]
    assert len(folders(layer)) == 2


def test_read_layer_by_table_name_and_path(spark, layer, sf_dir):
    layers.overwrite_layer(frame(spark, [(1, 1, "a", 1)]), layer)
    layers.read_layer(spark, layer).createOrReplaceTempView("requests_view")
    assert layers.read_layer(spark, "requests_view").count() == 1
    assert layers.read_layer(spark, f"{sf_dir}/region.parquet").count() == 5


@pytest.mark.parametrize("seed", range(3))
def test_random_upserts_equal_a_dictionary(spark, layer, seed):
    """Batches with moved keys and repeated keys against a plain Python merge."""
    import random

    rng = random.Random(seed)
    state = {}
    for step in range(3):
        batch = {}
        for i in range(12):
            k, p = rng.randrange(15), rng.choice([None, 1, 2, 3, 4])
            batch.setdefault(k, []).append((k, 100 * step + i, f"v{step}-{i}", p))
        layers.upsert_layer(frame(spark, [r for rows in batch.values() for r in rows]), layer, ["k"], ["t"], ["p"])
        state.update({k: max(rows, key=lambda r: r[1]) for k, rows in batch.items()})
        assert read(spark, layer) == sorted(state.values(), key=str)


def test_empty_and_mistyped_batches(spark, layer):
    layers.upsert_layer(frame(spark, [(1, 1, "a", 1)]), layer, ["k"], ["t"], ["p"])
    layers.upsert_layer(frame(spark, []), layer, ["k"], ["t"])
    assert read(spark, layer) == [(1, 1, "a", 1)] and folders(layer) == ["data-00000001"]
    with pytest.raises(ValueError, match="t"):
        layers.upsert_layer(frame(spark, [(1, 1, "a", 1)]).withColumn("t", F.lit("x")), layer, ["k"])


def test_every_partition_is_rewritten_in_place(spark, layer):
    """The way of an upsert does not depend on how many partitions it touches."""
    base = [(k, 1, "old", k) for k in range(60)]
    layers.upsert_layer(frame(spark, base), layer, ["k"], ["t"], ["p"])
    layers.upsert_layer(frame(spark, [(k, 2, "new", k + 1) for k in range(59)]), layer, ["k"], ["t"])
    assert read(spark, layer) == sorted([(k, 2, "new", k + 1) for k in range(59)] + base[59:], key=str)
    assert folders(layer) == ["data-00000001"]


def test_null_partitions_can_be_selected(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 6)], "k int, p int")
    wanted = spark.createDataFrame([(None,), (6,)], "p int")
    assert sorted(r.k for r in layers.in_partitions(df, wanted, ["p"]).collect()) == [1, 3]


def test_small_upsert_reads_only_touched_partitions(spark, layer):
    from tests.test_plans import plan

    layers.upsert_layer(frame(spark, [(k, 1, "old", k % 5) for k in range(50)]), layer, ["k"], ["t"], ["p"])
    touched = layers.parked(spark.createDataFrame([(2, "rewritten")], "p int, kind string"), "touched")
    text = plan(layers.in_partitions(layers.read_layer(spark, layer), touched.filter("kind = 'rewritten'"), ["p"]))
    assert "dynamicpruning" in text


def test_replayed_rows_without_key_enter_once_when_asked(spark, layer):
    batch = frame(spark, [(1, 1, "a", 1), (None, 1, "n", 1), (None, 2, "m", 2)])
    for _ in range(3):
        layers.upsert_layer(batch, layer, ["k"], ["t"], ["p"], null_keys="once")
    assert read(spark, layer) == sorted([(1, 1, "a", 1), (None, 1, "n", 1), (None, 2, "m", 2)], key=str)


def test_bronze_keeps_sparse_rows_without_a_key_apart(spark, layer):
    """The same value in one column or another: a hash that skips NULLs cannot tell such rows apart."""
    schema = "unique_key string, status string, city string, created_date string"
    for row in [(None, "x", None, None), (None, None, "x", None), (None, "x", None, None)]:
        layers.write_bronze(spark.createDataFrame([row], schema), layer)
    assert read(spark, layer) == sorted([(None, "x", None, None), (None, None, "x", None)], key=str)


def test_bronze_without_a_time_column_has_one_row_per_key(spark, layer):
    rows = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c")], "unique_key string, v string")
    layers.write_bronze(rows, layer)
    assert read(spark, layer) == [("1", "b"), ("2", "c")]


def test_catalog_tables(spark):
    import uuid

    from calltide.sources import tables

    name = f"t_{uuid.uuid4().hex}"
    assert not tables.table_exists(spark, name)
    tables.append_table(spark.createDataFrame([(1, "a")], "k int, v string"), name)
    tables.append_table(spark.createDataFrame([("x", 2)], "w string, k int"), name)
    assert tables.table_exists(spark, name)
    assert sorted(map(tuple, spark.table(name).select("k", "v", "w").collect())) == [(1, "a", None), (2, None, "x")]
    with pytest.raises(ValueError, match="k"):
        tables.append_table(spark.createDataFrame([("y",)], "k string"), name)
    tables.upsert_table(spark.createDataFrame([(1, "b", None), (3, "c", None)], "k int, v string, w string"), name, ["k"], ["v"])
    assert sorted((r.k, r.v) for r in spark.table(name).collect()) == [(1, "b"), (2, None), (3, "c")]
    spark.sql(f"DROP TABLE {name}")


def test_many_stored_keys_are_not_sent_through_the_driver(spark, layer):
    """Their files are far smaller than a broadcast of them, which this setting bounds."""
    rows = lambda t: spark.range(400_000).select(F.col("id").cast("int").alias("k"), F.lit(t).alias("t"), F.lit("v" * 40).alias("v"), (F.col("id") % 2).cast("int").alias("p"))
    spark.conf.set("spark.sql.maxBroadcastTableSize", "8m")
    try:
        for t in (1, 2):
            layers.upsert_layer(rows(t), layer, ["k"], [], ["p"], changes=lambda old, new: old and old.count())
        assert layers.read_layer(spark, layer).groupBy("t").count().collect() == [(2, 400_000)]
        layers.delete_keys(rows(2).filter("k > 9"), layer, ["k"])
        assert sorted(r.k for r in layers.read_layer(spark, layer).collect()) == list(range(10))
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
