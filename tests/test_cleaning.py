"""Columns, times, schema enforcement, merge and quality on hand-written rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from calltide.functions.columns import join_series, nan_to_null, normalize_columns
from calltide.functions.times import instant, parse_utc, to_utc, utc_wall, wall_seconds
from calltide.operators import conform, merge, quality
from calltide.params import Params
from calltide.plans import ingest_queries
from calltide.sources import pages, slices


def test_normalize_columns_folds_and_rejects_clashes(spark):
    df = spark.createDataFrame([(1, 2)], [" Unique Key", "BOROUGH "])
    assert normalize_columns(df).columns == ["unique_key", "borough"]
    with pytest.raises(ValueError, match="unique_key"):
        normalize_columns(spark.createDataFrame([(1, 2)], ["Unique Key", "unique_key"]))


def test_nan_to_null(spark, rows):
    df = spark.createDataFrame([(1, float("nan")), (2, 3.0)], "id int, v double")
    assert rows(nan_to_null(df)) == [(1, None), (2, 3.0)]


def test_parse_utc_edges(spark):
    text = [
        "2024-05-01T10:00:00.000",
        "2024-05-01 10:00:00",
        "2024-05-01",
        "2024-05-01T10:00:00Z",
        "2024-05-01T10:00:00+02:00",
        "nonsense",
        "",
        None,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(parse_utc(F.col("s"))).collect()]
    ten = datetime(2024, 5, 1, 10)
    assert got == [ten, ten, datetime(2024, 5, 1), ten, datetime(2024, 5, 1, 8), None, None, None]
    local = [r[0] for r in df.orderBy("i").select(parse_utc(F.col("s"), "America/New_York")).collect()]
    assert local[0] == datetime(2024, 5, 1, 14)
    assert local[3:5] == got[3:5]  # an explicit offset wins


def test_to_utc_handles_clock_changes(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP_NTZ '2024-03-10 02:30:00'), (TIMESTAMP_NTZ '2024-07-01 00:00:00') AS t(w)"
    )
    got = {r[0] for r in df.select(to_utc(F.col("w"), "America/New_York")).collect()}
    assert got == {datetime(2024, 3, 10, 7, 30), datetime(2024, 7, 1, 4)}
    assert df.select(to_utc(F.col("w"))).collect() == df.collect()


def test_instant_and_wall_are_inverse(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 02:30:00.123456' AS w")
    r = df.select("w", utc_wall(instant(F.col("w"))).alias("back"), wall_seconds(F.col("w")).alias("s")).first()
    assert r.w == r.back
    assert r.s == 1710037800


def test_conform_casts_and_fills(spark):
    raw = spark.createDataFrame(
        [("1", "2024-01-02T03:00:00", "40.5", "010"), ("x2", "bad", "NaN", None)],
        "unique_key string, created_date string, latitude string, incident_zip string",
    ).withColumn("other", F.lit(1))
    df = conform.conform(raw)
    assert df.columns == list(conform.CORE_TYPES)
    assert "closed_date" in conform.missing_columns(raw)
    first, second = df.orderBy(F.col("unique_key").asc_nulls_last()).collect()
    assert (first.unique_key, first.created_date, first.latitude) == (1, datetime(2024, 1, 2, 3), 40.5)
    assert first.incident_zip == "010"
    assert (second.unique_key, second.created_date, second.latitude) == (None, None, None)
    assert df.schema["closed_date"].dataType.simpleString() == "timestamp_ntz"


def test_silver_marks_closed_rows(spark):
    raw = spark.createDataFrame(
        [("1", "2024-01-02", "2024-01-01"), ("2", "2024-01-02", None)],
        "unique_key string, created_date string, closed_date string",
    )
    df = conform.to_silver(conform.conform(raw))
    assert {(r.unique_key, r.is_closed) for r in df.collect()} == {(1, True), (2, False)}
    assert "created_date" not in df.columns


def test_union_pages_by_name(spark, rows):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, k int")
    empty = spark.createDataFrame([], "k int")
    assert rows(pages.union_pages([a, b, empty])) == [(1, "x", None), (2, None, "y")]


def test_read_landed_pages(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"unique_key": 1, "props": {"a": 1}}\n{"unique_key": "2"}\n')
    (tmp_path / "2.json").write_text('{"unique_key": "3", "extra": true}\n')
    (tmp_path / "3.json").write_text("")
    df = pages.read_landed_pages(spark, str(tmp_path), ["unique_key", "props"])
    assert sorted(tuple(r) for r in df.collect()) == [("1", '{"a": 1}'), ("2", None), ("3", None)]


def test_pages_with_differing_headings(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"Unique Key": "1", " BOROUGH": "Bronx"}\n')
    (tmp_path / "2.json").write_text('{"unique_key": "2", "borough": "Queens", "location": {"lat": 1}}\n')
    df = pages.read_landed_pages(spark, str(tmp_path), ["unique_key", "borough", "location"], fold_names=True)
    assert sorted(tuple(r)[:2] for r in df.collect()) == [("1", "Bronx"), ("2", "Queens")]
    found = pages.read_landed_pages(spark, str(tmp_path))
    assert {"Unique Key", "unique_key"} <= set(found.columns)
    split = [spark.read.json(f"{tmp_path}/{n}.json") for n in (1, 2)]
    assert sorted(r.unique_key for r in pages.union_pages(split).collect()) == ["1", "2"]


def test_pages_of_a_hot_group_are_bounded(spark):
    """One event type holds all records of a day; pages grow in number and not in size."""
    events = spark.range(20_000).selectExpr("id AS ` Event ID`", "'hot' AS `EVENT TYPE`", "1.0D AS `Value\t`", "DATE '2024-01-01' AS day")
    sizes = [r[0] for r in ingest_queries._paged(events).select(F.size("page")).collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 2 * ingest_queries.PAGE


def test_received_parts_need_a_creation_time(spark):
    df = spark.createDataFrame([("2024-02-03",), ("?",)], "created_date string")
    got = {(r.received_year, r.received_month) for r in pages.add_received_parts(df).collect()}
    assert got == {(2024, 2), (None, None)}
    other = spark.createDataFrame([(1,)], "k int")
    assert pages.add_received_parts(other).columns == ["k"]


def test_window_bounds_and_half_open_slice(spark, rows):
    start, end = slices.window_bounds("2024-03-10T05:06:07.89", 7, 1)
    assert (start, end) == (datetime(2024, 3, 2), datetime(2024, 3, 10, 5, 6, 7))
    df = spark.createDataFrame([(start,), (end,)], "ts timestamp_ntz")
    assert rows(slices.slice_time(df, "ts", start, end)) == [(start,)]


def test_incremental_slice_of_empty_target_is_everything(spark):
    source = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 5),), (date(2024, 1, 6),)], "d date")
    assert slices.incremental_slice(source, source.limit(0), "d").count() == 3
    loaded = source.filter("d < DATE '2024-01-06'")
    assert slices.incremental_slice(source, loaded, "d", overlap_days=0).count() == 2


def test_params_bounds():
    assert Params().horizon_days == 14
    for bad in ({"sample_days": 6}, {"horizon_days": 61}, {"overlap_days": 8}):
        with pytest.raises(ValueError):
            Params(**bad)


# merge


def test_dedup_keeps_latest_and_all_null_keys(spark, rows):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "d"), (None, 9, "e"), (None, 9, "e")],
        "k int, t int, v string",
    )
    assert rows(merge.dedup_latest(df, ["k"], ["t"])) == [(1, 2, "c"), (2, None, "d"), (None, 9, "e"), (None, 9, "e")]
    assert rows(merge.dedup_latest(df, ["k"], ["t"], null_keys="drop")) == [(1, 2, "c"), (2, None, "d")]
    assert rows(merge.dedup_latest(df, ["k"], ["t"], one_pass=False)) == rows(merge.dedup_latest(df, ["k"], ["t"]))


def test_dedup_carries_columns_without_an_order(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1, map('a', 1)), (1, 2, map('b', 2)) AS t(k, t, m)")
    assert [tuple(r) for r in merge.dedup_latest(df, ["k"], ["t"]).collect()] == [(1, 2, {"b": 2})]


def test_upsert_replaces_inserts_and_widens(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    staged = spark.createDataFrame([(2, "B", 9), (3, "C", 9), (None, "m", 9)], "k int, v string, extra int")
    assert rows(merge.upsert(target, staged, ["k"])) == [
        (1, "a", None),
        (2, "B", 9),
        (3, "C", 9),
        (None, "m", 9),
        (None, "n", None),
    ]
    with pytest.raises(ValueError, match="extra"):
        merge.upsert(staged, target, ["k"])


def test_upsert_is_idempotent_and_disjoint_batches_commute(spark, rows):
    target = spark.range(100).selectExpr("id AS k", "id * 2 AS v")
    one = spark.range(50, 120).selectExpr("id AS k", "id * 3 AS v")
    two = spark.range(120, 150).selectExpr("id AS k", "id * 5 AS v")
    once = merge.upsert(target, one, ["k"])
    assert rows(merge.upsert(once, one, ["k"])) == rows(once)
    assert rows(merge.upsert(merge.upsert(target, one, ["k"]), two, ["k"])) == rows(
        merge.upsert(merge.upsert(target, two, ["k"]), one, ["k"])
    )


def test_unlike_rows_without_a_key_all_enter_once(spark, rows):
    """Rows that hash alike because hashes skip NULLs, and rows that differ only in a map or variant."""
    made = lambda values: spark.sql(
        "SELECT CAST(k AS INT) AS k, a, b, m, parse_json(v) AS v FROM VALUES " + values + " t(k, a, b, m, v)"
    )
    shown = lambda df: rows(df.selectExpr("k", "a", "b", "to_json(m) AS m", "to_json(v) AS v"))
    held = made("(NULL, NULL, 'x', map('p', 1, 'q', 2), '{\"n\": 1}')")
    batch = made("""
        (NULL, 'x', NULL, map('p', 1, 'q', 2), '{"n": 1}'), (NULL, NULL, 'x', map('p', 1, 'q', 3), '{"n": 1}'),
        (NULL, NULL, 'x', map('p', 1, 'q', 2), '{"n": "1"}'), (NULL, NULL, 'x', NULL, '{"n": 1}'),
        (NULL, NULL, 'x', map('p', 1, 'q', 2), NULL), (NULL, NULL, 'x', map('q', 2, 'p', 1), '{"n": 1}')""")
    once = merge.upsert(held, batch, ["k"], null_keys="once")
    assert once.count() == 6
    assert shown(merge.upsert(once, batch, ["k"], null_keys="once")) == shown(once)
    wider = held.withColumn("w", F.lit(1))
    assert merge.upsert(held, wider, ["k"], null_keys="once").count() == 2


def test_upsert_takes_latest_of_a_batch(spark, rows):
    target = spark.createDataFrame([(1, 0, "old")], "k int, t int, v string")
    staged = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, t int, v string")
    assert rows(merge.upsert(target, staged, ["k"], latest_by=["t"])) == [(1, 2, "b")]


# quality


def test_between_ignores_missing_values_and_includes_bounds(spark):
    ok = [(90.0,), (-90.0,), (None,), (float("nan"),)]
    df = spark.createDataFrame(ok, "latitude double")
    r = quality.expect_between(df, "latitude", -90, 90, mostly=0.99).first()
    assert (r.rule, r.total, r.failed, r.ratio, r.success) == ("latitude_between", 2, 0, 1.0, True)


@pytest.mark.parametrize("bad, success", [(9, True), (10, True), (11, False)])
def test_between_tolerance(spark, bad, success):
    df = spark.range(1000).selectExpr(f"CASE WHEN id < {bad} THEN 91.0D ELSE 1.0D END AS latitude")
    assert quality.expect_between(df, "latitude", -90, 90, mostly=0.99).first().success is success


def test_rule_without_values_passes(spark):
    df = spark.createDataFrame([(None, None, "Noise")], "latitude double, longitude double, complaint_type string")
    assert quality.enforce(df) is df
    empty = df.limit(0)
    assert [r.success for r in quality.quality_report(empty).collect()] == [True] * 3


def test_enforce_names_failed_rules(spark):
    df = spark.createDataFrame(
        [(None, 1.0, 200.0), ("Noise", 1.0, 2.0)], "complaint_type string, latitude double, longitude double"
    )
    with pytest.raises(quality.QualityError) as e:
        quality.enforce(df)
    assert "complaint_type_not_null" in str(e.value) and "longitude_between" in str(e.value)
    assert "latitude_between" not in str(e.value).replace("longitude_between", "")


def test_split_valid(spark):
    df = spark.createDataFrame(
        [(1, None, 1.0, 1.0), (2, "Noise", 99.0, 1.0), (3, "Noise", None, 1.0)],
        "id int, complaint_type string, latitude double, longitude double",
    )
    valid, rejects = quality.split_valid(df)
    assert [r.id for r in valid.collect()] == [3]
    assert {r.id: r.failed_rules for r in rejects.collect()} == {
        1: ["complaint_type_not_null"],
        2: ["latitude_between"],
    }
    assert valid.columns == df.columns


def test_missing_dates_per_series_with_null_key(spark, rows):
    days = [("a", 1), ("a", 4), ("b", 2), (None, 1), (None, 3)]
    df = spark.createDataFrame([(k, date(2024, 1, d)) for k, d in days], "k string, ds date")
    assert rows(quality.missing_dates(df, ["k"])) == [
        ("a", date(2024, 1, 2)),
        ("a", date(2024, 1, 3)),
        (None, date(2024, 1, 2)),
    ]


def test_join_series_matches_null_keys(spark, rows):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    right = spark.createDataFrame([(None, 20), ("b", 30)], "k string, w int")
    assert rows(join_series(left, right, ["k"], "left")) == [("a", 1, None), (None, 2, 20)]


def test_drift_flags_a_jump(spark):
    days = [(date(2024, 1, d), 1 if d % 2 else None) for d in range(1, 31) for _ in range(10 + d % 3)]
    jump = [(date(2024, 1, 31), 1)] * 500
    df = spark.createDataFrame(days + jump, "ts date, v int")
    report = {r.ds.day: r for r in quality.drift_report(df, "ts", "v").collect()}
    assert report[31].drifted and not report[30].drifted
    assert report[1].drifted is None


def test_run_metrics(spark):
    runs = [("silver", True, 10.0), ("silver", False, 30.0), ("silver", True, 20.0)]
    df = spark.createDataFrame(
        [(j, date(2024, 1, 1), s, d) for j, s, d in runs], "job string, day date, success boolean, duration_s double"
    )
    r = quality.run_metrics(df).first()
    assert (r.runs, round(r.success_rate, 6), r.median_duration_s, r.meets_goal) == (3, 0.666667, 20.0, False)
