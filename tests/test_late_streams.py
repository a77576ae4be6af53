"""Streams with late rows, repeated batches and the latest row per key."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from calltide.operators.merge import dedup_latest
from calltide.sources import layers
from calltide.sources.layers import Layer
from calltide.streaming import streams

SCHEMA = "k string, ts timestamp_ntz, v long"


def rows_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def run(spark, tmp_path, days=2):
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    streams.stream_daily_totals(stream, str(tmp_path / "out"), "ts", ["k"], str(tmp_path / "cp"), days).awaitTermination()


def state(spark, tmp_path):
    read = lambda n, *c: sorted(map(tuple, layers.read_layer(spark, Layer(str(tmp_path / "out"), n)).select(*c).collect()), key=str)
    return read("counts", "ds", "k", "y"), read("late", "ds", "k", "y")


def at(day, hour=0):
    return datetime(2024, 1, 1) + timedelta(days=day, hours=hour)


BATCHES = [
    [("a", at(0), 1), ("a", at(0, 5), 2), (None, at(3), 3), ("b", None, 4), ("a", at(40), 5)],
    [("a", at(37, 23), 6), ("a", at(38), 7), ("a", at(0), 8), ("b", None, 9), ("c", at(60), 10), ("a", at(39), 11)],
    [("a", at(41), 12), ("c", at(58), 13), ("c", at(59), 14)],
]


def test_counted_and_late_rows_add_up(spark, tmp_path):
    for batch in BATCHES:
        rows_of(spark, batch).write.mode("append").parquet(str(tmp_path / "in"))
        run(spark, tmp_path)
    counts, late = state(spark, tmp_path)
    day = lambda n: at(n).date()
    assert sorted(counts, key=str) == sorted(
        [(day(0), "a", 2), (day(3), None, 1), (None, "b", 2), (day(40), "a", 1), (day(38), "a", 1), (day(39), "a", 1), (day(60), "c", 1), (day(58), "c", 1), (day(59), "c", 1)],
        key=str,
    )
    assert sorted(late, key=str) == sorted([(day(37), "a", 1), (day(0), "a", 1), (day(41), "a", 1)], key=str)
    assert sum(r[2] for r in counts + late) == sum(map(len, BATCHES))


def test_a_batch_that_is_run_again_changes_nothing(spark, tmp_path, monkeypatch):
    """The second batch fails after its counts are swapped, and is run again with the same number."""
    whole = streams.replace_partitions
    for n, batch in enumerate(BATCHES):
        rows_of(spark, batch).write.mode("append").parquet(str(tmp_path / "in"))
        if n:

            def breaks(df, layer, partitions):
                whole(df, layer, partitions)
                if layer.name == "counts":
                    raise OSError("lost")

            monkeypatch.setattr(streams, "replace_partitions", breaks)
            with pytest.raises(Exception, match="lost"):
                run(spark, tmp_path)
            monkeypatch.undo()
        run(spark, tmp_path)
    again = state(spark, tmp_path)
    other = tmp_path / "other"
    for batch in BATCHES:
        rows_of(spark, batch).write.mode("append").parquet(str(other / "in"))
        run(spark, other)
    assert again == state(spark, other)


def test_latest_row_per_key_equals_batch(spark, tmp_path):
    """Shuffled arrivals in several batches; state holds open keys only."""
    import random

    rng = random.Random(3)
    rows = [(f"k{i % 40}" if i % 9 else None, at(i % 40, rng.randrange(4)), i) for i in range(400)]
    groups = [rows[i::4] for i in range(4)]  # all of a key within hours
    for n, group in enumerate(groups):
        rng.shuffle(group)
        rows_of(spark, group).write.mode("append").parquet(str(tmp_path / "in"))
    rows_of(spark, [("end", at(200), 0)]).write.mode("append").parquet(str(tmp_path / "in"))

    def stream(overlap):
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
        return streams.stream_latest(source, ["k"], "ts", ["ts", "v"], overlap)

    query = streams.write_stream(stream(45), str(tmp_path / "rows"), str(tmp_path / "cp"))
    query.awaitTermination()
    got = spark.read.schema(SCHEMA).parquet(str(tmp_path / "rows"))
    want = dedup_latest(rows_of(spark, rows), ["k"], ["ts", "v"])
    as_rows = lambda df: sorted(map(tuple, df.select("k", "ts", "v").collect()), key=str)
    assert as_rows(got) == as_rows(want) and got.filter("k IS NULL").count() == sum(r[0] is None for r in rows)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 1  # the end alone


def test_state_of_latest_rows_stays_bounded(spark, tmp_path):
    """Many keys one after the other: state follows the overlap and not the number of keys."""
    for part in range(6):
        rows = [(f"k{i}", at(i // 20), i) for i in range(part * 200, part * 200 + 200)]
        rows_of(spark, rows).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        query = streams.write_stream(streams.stream_latest(source, ["k"], "ts", ["v"], 1), str(tmp_path / "rows"), str(tmp_path / "cp"))
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3 * 20
    assert spark.read.parquet(str(tmp_path / "rows")).count() >= 1200 - 60
