"""Gold kept up from Silver's signed changes, and Silver over append-only Bronze."""

import random
from datetime import date, datetime, timedelta
from functools import partial
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from calltide.operators import merge
from calltide.operators.carry import months_to_redo, rows_after, tails, with_features
from calltide.params import Params
from calltide.plans import jobs
from calltide.sources import layers

COLUMNS = ["ds", "complaint_type", "borough", "agency", "y", "y_lag7", "y_ma7", "month"]
SCHEMA = "unique_key string, created_date timestamp_ntz, complaint_type string, borough string, agency string, status string"


@pytest.fixture
def where(tmp_path):
    return jobs.Layers(str(tmp_path / "layers"))


def rows_of(spark, layer, columns):
    return sorted(map(tuple, layers.read_layer(spark, layer).select(*columns).collect()), key=str)


def requests_of(spark, rows):
    return spark.createDataFrame([(str(k), t, c, b, a, s) for k, t, c, b, a, s in rows], SCHEMA)


def load(spark, where, rows, as_of, **how):
    jobs.bronze_job(requests_of(spark, rows), where, as_of, **how)
    return jobs.silver_job(spark, where, as_of)


def random_rows(rng, keys):
    """Sparse series, NULL keys and NULL times among them."""
    start = datetime(2020, 1, 1)
    return [
        (k, None if rng.random() < 0.02 else start + timedelta(days=rng.randrange(500)), rng.choice(["a", "b"]), rng.choice([None, "x"]), "g", "O")
        for k in keys
    ]


def test_changes_add_up_to_a_full_recount(spark, where):
    rng = random.Random(4)
    load(spark, where, random_rows(rng, range(300)), "2021-06-01")
    jobs.gold_job(spark, where)
    for step in range(3):
        changed = random_rows(rng, rng.sample(range(320), 6))
        load(spark, where, changed, f"2021-0{4 + step}-03")
        if step == 1:
            gone = spark.createDataFrame([(k,) for k in rng.sample(range(300), 5)] + [(None,)], "unique_key long")
            jobs.forget_job(spark, where, gone)
        jobs.gold_job(spark, where)
        kept = rows_of(spark, where.gold, COLUMNS), rows_of(spark, where.daily_tails, ["month", "complaint_type", "borough", "n", "tail"])
        assert sum(r[4] for r in kept[0]) == layers.read_layer(spark, where.silver).count()
        jobs.gold_job(spark, where, full=True)
        assert kept == (rows_of(spark, where.gold, COLUMNS), rows_of(spark, where.daily_tails, ["month", "complaint_type", "borough", "n", "tail"]))


def files(where, name):
    return {str(p): p.stat().st_mtime_ns for p in Path(f"{where.root}/{name}").rglob("*.parquet")}


def test_other_months_keep_their_files_and_silver_is_not_read(spark, where, monkeypatch):
    daily = [(f"{n}{k}", datetime(2020, 1, 1) + timedelta(days=n), c, "x", "g", "O") for n in range(200) for k, c in enumerate("ab")]
    load(spark, where, daily, "2021-01-01")
    jobs.gold_job(spark, where)
    before = {n: files(where, n) for n in ("gold", "daily")}
    load(spark, where, [("970", datetime(2020, 4, 6), "a", "x", "g", "O")], "2021-01-02")  # one day earlier
    read = layers.read_layer

    def watched(session, layer):
        assert getattr(layer, "name", "") not in ("silver", "bronze")
        return read(session, layer)

    monkeypatch.setattr(jobs, "read_layer", watched)
    jobs.gold_job(spark, where)
    monkeypatch.undo()
    changed = {n: {p.split("month=")[1][:7] for p in set(before[n]) ^ set(files(where, n))} for n in before}
    assert changed == {"gold": {"2020-04"}, "daily": {"2020-04"}}
    incremental = rows_of(spark, where.gold, COLUMNS)
    jobs.gold_job(spark, where, full=True)
    assert incremental == rows_of(spark, where.gold, COLUMNS)


def test_a_gold_run_that_was_cut_off_is_counted_again(spark, where, monkeypatch):
    rng = random.Random(6)
    load(spark, where, random_rows(rng, range(200)), "2021-06-01")
    jobs.gold_job(spark, where)
    load(spark, where, random_rows(rng, range(10)), "2021-06-02")
    whole = jobs.replace_partitions
    seen = []

    def breaks(df, layer, partitions):
        whole(df, layer, partitions)
        seen.append(layer.name)
        raise OSError("lost")

    monkeypatch.setattr(jobs, "replace_partitions", breaks)
    with pytest.raises(OSError):
        jobs.gold_job(spark, where)
    assert seen == ["daily"]
    monkeypatch.undo()
    jobs.gold_job(spark, where)
    kept = rows_of(spark, where.gold, COLUMNS)
    jobs.gold_job(spark, where, full=True)
    assert kept == rows_of(spark, where.gold, COLUMNS)


def test_a_silver_run_that_was_cut_off_is_counted_again(spark, where, monkeypatch):
    rng = random.Random(7)
    load(spark, where, random_rows(rng, range(200)), "2021-06-01")
    jobs.gold_job(spark, where)

    def breaks(*a, **k):
        raise OSError("lost")

    monkeypatch.setattr(layers, "drop_folders", breaks)  # after the swap, before the run is marked as done
    with pytest.raises(OSError):
        load(spark, where, random_rows(rng, range(10)), "2021-06-02")
    monkeypatch.undo()
    jobs.gold_job(spark, where)
    jobs.silver_job(spark, where, "2021-06-02")
    jobs.gold_job(spark, where)
    kept = rows_of(spark, where.gold, COLUMNS)
    jobs.gold_job(spark, where, full=True)
    assert kept == rows_of(spark, where.gold, COLUMNS)


def test_scratch_tables_are_dropped(spark, where):
    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(base.iterdir())
    load(spark, where, random_rows(random.Random(1), range(20)), "2021-06-01")
    jobs.gold_job(spark, where)
    assert set(base.iterdir()) == before


def test_months_to_redo_reach_seven_rows(spark):
    days = [date(2020, 1, 1), date(2020, 2, 1), date(2020, 2, 9), date(2020, 4, 1), *[date(2020, 5, d) for d in range(1, 6)], date(2020, 7, 1), date(2020, 8, 1)]
    daily = spark.createDataFrame([(d, "s", 1, d.replace(day=1)) for d in days], "ds date, k string, y long, month date")
    changed = daily.filter("month = DATE '2020-02-01'").selectExpr("k", "month", "0L AS after").distinct()
    got = {r.month.month: r.state for r in months_to_redo(tails(daily, ["k"]), changed, ["k"]).collect()}
    assert got == {1: "before", 2: "redo", 4: "redo", 5: "redo", 7: "redo"}
    changed = daily.filter("month = DATE '2020-05-01'").groupBy("k", "month").agg(F.lit(date(2020, 5, 2)).alias("last"))
    assert [r.after for r in rows_after(daily, changed, ["k"]).collect()] == [3]
    got = {r.month.month: r.state for r in months_to_redo(tails(daily, ["k"]), rows_after(daily, changed, ["k"]), ["k"]).collect()}
    assert got == {1: "before", 2: "before", 4: "before", 5: "redo", 7: "redo", 8: "redo"}
    changed = daily.filter("month = DATE '2020-08-01'").selectExpr("k", "month", "0L AS after").distinct()
    got = {r.month.month: r.state for r in months_to_redo(tails(daily, ["k"]), changed, ["k"]).collect()}
    assert got == {4: "before", 5: "before", 7: "before", 8: "redo"}
    assert with_features(daily, ["k"]).filter("y_lag7 = 1").count() == len(days) - 7


def request(key, status, day=1):
    return (key, datetime(2020, 1, day), "c", "b", "a", status)


@pytest.mark.parametrize("append_only", [True, False])
@pytest.mark.parametrize(("precedence", "want"), [("arrival", ("late", date(2021, 1, 5))), ("load_date", ("new", date(2021, 1, 12)))])
def test_both_layouts_of_bronze_follow_one_rule(spark, where, append_only, precedence, want):
    params = Params(precedence=precedence)
    for status, as_of in (("old", "2021-01-10"), ("new", "2021-01-12"), ("late", "2021-01-05")):
        jobs.bronze_job(requests_of(spark, [request(1, status)]), where, as_of, append_only, params)
        silver = jobs.silver_job(spark, where, "2021-01-12", params)
    assert [tuple(r) for r in silver.select("status", "bronze_date").collect()] == [want]
    first = ("2021-01-10", "2021-01-10") if append_only else ("2021-01-05", "2021-01-05")
    silver = jobs.silver_job(spark, where, "2021-01-13", params, load_dates=first)
    assert [tuple(r) for r in silver.select("status", "bronze_date").collect()] == [want]


def test_rejects_of_other_loads_stay(spark, where):
    stored = lambda: rows_of(spark, where.rejects, ["raw", "ingestion_date"])
    load(spark, where, [request(1, "a"), request("x5", "a")], "2021-01-01", append_only=True)
    first = stored()
    assert len(first) == 1 and first[0][1] == date(2021, 1, 1)
    load(spark, where, [request(1, "b")], "2021-01-02", append_only=True)
    load(spark, where, [request(1, "c"), request("x6", "c"), request(None, "c")], "2021-01-03", append_only=True)
    assert [r for r in stored() if r[1] == date(2021, 1, 1)] == first and len(stored()) == 3
    for how in ({"load_dates": ("2021-01-01", "2021-01-02")}, {"full": True}):
        silver = jobs.silver_job(spark, where, "2021-01-04", **how)
        assert len(stored()) == 3
        assert [r.status for r in silver.collect()] == ["c"]


def test_rejects_of_an_earlier_layout_are_carried_over(spark, where):
    old = spark.createDataFrame([("{}", "unreadable key", date(2020, 1, 1))], "raw string, reason string, ingestion_date date")
    layers.overwrite_layer(old, where.rejects)
    load(spark, where, [request("x1", "a"), request(2, "a")], "2021-01-01")
    assert {r[1] for r in rows_of(spark, where.rejects, ["raw", "ingestion_date"])} == {date(2020, 1, 1), date(2021, 1, 1)}


def test_many_series_are_not_sent_through_the_driver(spark, where, monkeypatch):
    """Days and months of changed series are as many as the tables ask for, and take little room in files."""
    rows = [(k, datetime(2020, 1, 1) + timedelta(days=k), "a", None, "g", "O") for k in range(40)]
    load(spark, where, rows, "2021-06-01")
    jobs.gold_job(spark, where)
    load(spark, where, [(k, t, "b", *rest) for k, t, _, *rest in rows[:2]], "2021-06-02")
    plans = []

    def seen(df, *args, into):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return into(df, *args)

    for name in ("parked", "replace_partitions"):
        monkeypatch.setattr(jobs, name, partial(seen, into=getattr(jobs, name)))
    monkeypatch.setattr(merge, "FEW_KEYS", 0)
    jobs.gold_job(spark, where)
    joins = [line for p in plans for line in p.splitlines() if "Join" in line and "complaint_type" in line]
    assert len(joins) >= 4 and all("SortMergeJoin" in j for j in joins), joins
