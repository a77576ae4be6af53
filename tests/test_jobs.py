"""Streams and whole jobs."""

from unittest import mock

import pytest
from pyspark.sql import functions as F

from calltide.operators.quality import QualityError
from calltide.operators.series import daily_counts
from calltide.params import Params
from calltide.plans import jobs
from calltide.sources import layers
from calltide.sources.layers import Layer
from calltide.sources.requests import requests, table
from calltide.sources.scratch import shared_dir
from calltide.streaming import streams


@pytest.fixture
def where(tmp_path):
    return jobs.Layers(str(tmp_path / "layers"))


def half_year(spark, sf_dir):
    return requests(spark, sf_dir, closed=True).filter("created_date BETWEEN DATE '1998-01-01' AND DATE '1998-06-30'")


def snapshot(spark, layer, columns):
    return sorted(map(tuple, layers.read_layer(spark, layer).select(*columns).collect()), key=str)


def test_rerun_changes_nothing(spark, sf_dir, where):
    raw = half_year(spark, sf_dir)
    states = []
    for _ in range(2):
        result = jobs.run_all(spark, raw, where, "2001-08-02", method="trend")
        states.append([
            snapshot(spark, where.bronze, ["unique_key", "status"]),
            snapshot(spark, where.silver, ["unique_key", "status", "created_ts_utc", "ingestion_date"]),
            snapshot(spark, where.gold, ["ds", "complaint_type", "borough", "agency", "y", "y_lag7"]),
            sorted(map(tuple, result.withColumn("yhat_upper", F.round("yhat_upper", 9)).collect()), key=str),
        ])
    assert states[0] == states[1]
    assert len(states[0][0]) == raw.count()
    assert result.columns == ["ds", "y", "yhat_upper", "is_anomaly", "anomaly_streak", "alert"]


def test_late_batch_updates_silver_and_gold(spark, sf_dir, where):
    raw = half_year(spark, sf_dir)
    first = raw.filter(F.col("created_date") < F.lit("1998-05-01").cast("timestamp_ntz"))
    late = raw.filter(F.col("created_date") >= F.lit("1998-03-15").cast("timestamp_ntz")).withColumn("status", F.lit("R"))
    jobs.bronze_job(first, where, "1999-06-01")
    jobs.silver_job(spark, where, "1999-06-01")
    jobs.bronze_job(late, where, "2001-08-02")
    silver = jobs.silver_job(spark, where, "2001-08-02")
    assert silver.count() == raw.count()
    assert silver.filter("status = 'R'").count() == late.count()
    assert silver.filter("ingestion_date = DATE '1999-06-01'").count() < first.count()
    assert jobs.gold_job(spark, where).agg(F.sum("y")).first()[0] == raw.count()


def gold_rows(spark, where):
    return snapshot(spark, where.gold, ["ds", "complaint_type", "borough", "agency", "y", "y_lag7", "y_ma7", "month"])


def load(spark, where, rows, as_of):
    jobs.bronze_job(rows, where, as_of)
    return jobs.silver_job(spark, where, as_of)


@pytest.mark.parametrize("as_of", ["2001-08-02", "2001-08-03"])
def test_incremental_gold_equals_full_recount(spark, sf_dir, where, as_of):
    raw = half_year(spark, sf_dir)
    load(spark, where, raw, "2001-08-02")
    jobs.gold_job(spark, where)

    a, b, c, d = [r.unique_key for r in raw.orderBy("created_date").limit(4).collect()]
    changes = [
        (a, "created_date", "TIMESTAMP_NTZ '1998-05-03'"),  # moves to another month
        (b, "complaint_type", "'other'"),
        (c, "created_date", "CAST(NULL AS TIMESTAMP_NTZ)"),
        (d, "unique_key", "-1L"),  # new request
    ]
    batch = [raw.filter(f"unique_key = {k}").withColumn(column, F.expr(value)) for k, column, value in changes]
    for changed in batch[1:]:
        batch[0] = batch[0].unionByName(changed)
    silver = load(spark, where, batch[0], as_of)
    jobs.gold_job(spark, where)
    incremental = gold_rows(spark, where)
    jobs.gold_job(spark, where, full=True)
    assert incremental == gold_rows(spark, where)
    assert sum(r[4] for r in incremental) == silver.count() == raw.count() + 1


def test_incremental_gold_reads_only_changed_months(spark, sf_dir, where):
    """Changes are logged by what is counted, so a changed status leaves all months alone."""
    raw = half_year(spark, sf_dir)
    one = raw.orderBy("created_date").limit(1)
    load(spark, where, raw, "2001-07-01")
    jobs.gold_job(spark, where)
    stale = lambda: sorted({str(r.month) for r in jobs._net_changes(spark, where, jobs._open_runs(spark, where)).collect()})
    load(spark, where, one.withColumn("status", F.lit("R")), "2001-08-05")
    assert stale() == []
    load(spark, where, one.withColumn("agency", F.lit("R")), "2001-06-05")
    assert stale() == ["1998-01-01"]


def test_late_loads_reach_silver(spark, sf_dir, where):
    raw = half_year(spark, sf_dir)
    first = raw.filter("unique_key % 2 = 0")
    jobs.bronze_job(first, where, "2001-03-01")
    jobs.silver_job(spark, where, "2001-03-10")
    jobs.bronze_job(raw.filter("unique_key % 2 = 1"), where, "2001-03-05")
    assert jobs.silver_job(spark, where, "2001-03-10").count() == raw.count()
    assert jobs.silver_job(spark, where, "2001-03-11").count() == raw.count()


def test_unreadable_keys_are_rejected_and_never_doubled(spark, sf_dir, where):
    raw = half_year(spark, sf_dir).withColumn("unique_key", F.col("unique_key").cast("string"))
    bad = raw.limit(2).withColumn("unique_key", F.concat(F.lit("x"), "unique_key"))
    none = raw.limit(1).withColumn("unique_key", F.lit(None).cast("string"))
    rows = raw.unionByName(bad).unionByName(none)
    for _ in range(3):
        jobs.bronze_job(rows, where, "2001-03-01")
        silver = jobs.silver_job(spark, where, "2001-03-01")
        assert silver.count() == raw.count()
        assert layers.read_layer(spark, where.rejects).count() == 3
        assert jobs.gold_job(spark, where).agg(F.sum("y")).first()[0] == raw.count()
    jobs.silver_job(spark, where, "2001-03-02", full=True)
    jobs.silver_job(spark, where, "2001-03-02", load_dates=("2001-03-01", "2001-03-01"))
    assert layers.read_layer(spark, where.silver).count() == raw.count()
    assert layers.read_layer(spark, where.rejects).count() == 3


def test_backfilled_correction_reaches_gold(spark, sf_dir, where):
    raw = half_year(spark, sf_dir)
    load(spark, where, raw, "2001-08-02")
    jobs.gold_job(spark, where)
    some = raw.limit(10).withColumn("complaint_type", F.lit("Heat"))
    load(spark, where, some, "2001-07-01")
    assert jobs.gold_job(spark, where).filter("complaint_type = 'Heat'").agg(F.sum("y")).first()[0] == 10


def test_value_moved_to_a_missing_key_reaches_gold(spark, sf_dir, where):
    """Counts stay the same and only the column that holds the value changes."""
    raw = half_year(spark, sf_dir).limit(10)
    load(spark, where, raw.withColumns({"agency": F.lit("X"), "borough": F.lit(None).cast("string")}), "2001-08-02")
    jobs.gold_job(spark, where)
    load(spark, where, raw.withColumns({"agency": F.lit(None).cast("string"), "borough": F.lit("X")}), "2001-08-03")
    jobs.gold_job(spark, where)
    incremental = gold_rows(spark, where)
    jobs.gold_job(spark, where, full=True)
    assert incremental == gold_rows(spark, where)


def test_bronze_records_its_loads(spark, sf_dir, where):
    raw = half_year(spark, sf_dir)
    for _ in range(2):
        jobs.bronze_job(raw, where, "1998-07-01", only_window=True, params=Params(sample_days=30))
    summary = layers.read_layer(spark, where.ingest_summaries).collect()
    expected = raw.filter("created_date >= TIMESTAMP_NTZ '1998-05-31'").count()
    assert [r.records for r in summary] == [expected] * 2 and layers.read_layer(spark, where.bronze).count() == expected
    assert layers.read_layer(spark, where.bronze_loads).select("load_id").distinct().count() == 2


def test_append_only_bronze_keeps_every_load_and_silver_takes_the_newest(spark, sf_dir, where):
    raw = half_year(spark, sf_dir)
    jobs.bronze_job(raw, where, "2001-08-02", append_only=True)
    bronze = jobs.bronze_job(raw.withColumn("status", F.lit("R")), where, "2001-08-03", append_only=True)
    assert bronze.count() == 2 * raw.count()
    silver = jobs.silver_job(spark, where, "2001-08-03")
    assert silver.count() == raw.count()
    assert [r.status for r in silver.select("status").distinct().collect()] == ["R"]


def test_bad_rows_stop_the_silver_job(spark, sf_dir, where):
    raw = half_year(spark, sf_dir).withColumn("complaint_type", F.lit(None).cast("string"))
    jobs.bronze_job(raw, where, "2001-08-02")
    with pytest.raises(QualityError):
        jobs.silver_job(spark, where, "2001-08-02")
    assert not layers.layer_exists(spark, where.silver)
    report = {r.rule: r for r in layers.read_layer(spark, where.quality).collect()}
    assert not report["complaint_type_not_null"].success
    assert {"latitude_column_missing", "descriptor_column_missing"} <= set(report)
    assert "status_column_missing" not in report


def test_lookup_enriches_silver(spark, sf_dir, where):
    jobs.bronze_job(half_year(spark, sf_dir), where, "2001-08-02")
    lookup = table(spark, sf_dir, "region").selectExpr("r_name AS borough", "r_regionkey AS borough_code")
    silver = jobs.silver_job(spark, where, "2001-08-02", lookup=lookup)
    assert silver.filter("borough_code IS NULL").count() == 0


def test_every_stage_runs_once(spark):
    stages = ["bronze_job", "silver_job", "gold_job", "forecast_job", "anomaly_job"]
    with mock.patch.multiple(jobs, **{s: mock.DEFAULT for s in stages}) as called:
        jobs.run_all(spark, mock.Mock(), jobs.Layers("/nowhere"), "2001-08-02")
    assert [called[s].call_count for s in stages] == [1] * 5


def test_tuned_versions_go_live_with_their_models(spark, sf_dir, where):
    load(spark, where, half_year(spark, sf_dir), "2001-08-02")
    jobs.gold_job(spark, where)
    keys = ["borough"]
    for _ in range(2):
        forecast = jobs.forecast_job(spark, where, keys)
    assert forecast.columns == ["borough", "ds", "yhat", "yhat_lower", "yhat_upper"]
    assert layers.read_layer(spark, where.training_log).count() == 10
    assert not layers.layer_exists(spark, where.model_runs)  # training scores are no versions
    assert jobs.anomaly_job(spark, where, keys).count() > 0

    few = Params(horizon_days=7)
    decision = {d.model_name: d for d in jobs.tune_job(spark, where, keys, n_trials=4, params=few).collect()}
    assert len(decision) == 5 and all(d.promoted for d in decision.values())
    again = {d.model_name: d for d in jobs.tune_job(spark, where, keys, n_trials=4, params=few).collect()}
    assert not any(d.promoted for d in again.values())  # the same trials cannot beat themselves
    assert {n: d.best_version for n, d in again.items()} == {n: d.best_version for n, d in decision.items()}
    assert layers.read_layer(spark, where.coefficients).count() == 5 * 8

    with pytest.raises(ValueError, match="Production"):
        jobs.infer_job(spark, where, keys, few)
    jobs.stage_job(spark, where)
    ahead = jobs.infer_job(spark, where, keys, few)
    assert ahead.count() == 5 * 7
    live = {(r.model_name, r.version) for r in ahead.select("model_name", "version").distinct().collect()}
    assert live == {(n, d.best_version) for n, d in decision.items()}
    layers.overwrite_layer(layers.read_layer(spark, where.coefficients).filter("version > 4"), where.coefficients)
    with pytest.raises(ValueError, match="no stored model"):
        jobs.infer_job(spark, where, keys, few)


def test_model_names_keep_keys_apart(spark):
    rows = [("a/b", "c"), ("a", "b/c"), (None, "c"), ("NULL", "c"), ("\\N", "c"), ("a\\", "b")]
    names = spark.createDataFrame(rows, "x string, y string").select(jobs._model_name("m", ["x", "y"])).distinct()
    assert names.count() == len(rows)


def test_empty_gold_is_an_error(spark, where):
    empty = spark.createDataFrame([], "ds date, complaint_type string, borough string, agency string, y bigint")
    layers.overwrite_layer(empty, where.gold)
    with pytest.raises(ValueError, match="daily table"):
        jobs.forecast_job(spark, where)


# streams


def test_closed_stream_windows_equal_batch(spark, sf_dir, tmp_path):
    out = str(tmp_path)
    stream = streams.read_stream(spark, sf_dir, "events.parquet")
    counts = streams.stream_daily_counts(stream, "ts", ["event_type"], overlap_days=2)
    streams.write_stream(counts, f"{out}/rows", f"{out}/cp").awaitTermination()
    got = spark.read.parquet(f"{out}/rows")
    batch = daily_counts(table(spark, sf_dir, "events"), "ts", ["event_type"])
    last = got.agg(F.max("ds")).first()[0]
    assert sorted(map(tuple, got.select("ds", "event_type", "y").collect())) == sorted(
        map(tuple, batch.filter(F.col("ds") <= F.lit(last)).collect())
    )
    newest = batch.agg(F.max("ds")).first()[0]
    assert (newest - last).days in (2, 3)


def test_stream_dedup_across_batches(spark, sf_dir, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    events.write.mode("append").parquet(source)
    hot = events.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("n")
    events.unionByName(hot).repartition(7).write.mode("append").parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(source)
    unique = streams.stream_dedup(stream, "event_id", "ts", overlap_days=60)
    streams.write_stream(unique, f"{out}/rows", f"{out}/cp").awaitTermination()
    got = spark.read.parquet(f"{out}/rows")
    assert got.count() == events.count() == got.select("event_id").distinct().count()


def test_stream_keeps_rows_without_a_key(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.sql("SELECT CAST(NULL AS BIGINT) AS k, TIMESTAMP_NTZ '2024-01-01' AS ts FROM range(5) UNION ALL SELECT 1, TIMESTAMP_NTZ '2024-01-01' FROM range(3)")
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    streams.write_stream(streams.stream_dedup(stream, "k", "ts", salts=3), f"{out}/rows", f"{out}/cp").awaitTermination()
    assert spark.read.parquet(f"{out}/rows").count() == 6


def test_stream_upsert_resumes_from_its_checkpoint(spark, sf_dir, tmp_path):
    layer = Layer(str(tmp_path), "events")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    source = str(tmp_path / "in")
    events.write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(events.schema).parquet(source)
        streams.stream_upsert(stream, layer, ["event_id"], ["ts"], str(tmp_path / "cp")).awaitTermination()
        return layers.read_layer(spark, layer)

    assert run().count() == events.count()
    events.withColumn("value", F.lit(-1.0)).limit(10).write.mode("append").parquet(source)
    assert run().count() == events.count()
    assert layers.read_layer(spark, layer).filter("value = -1").count() == 10


def test_shared_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = shared_dir(spark, "x")
    assert path != shared_dir(spark, "x")
    if base:
        assert path.startswith(base)
