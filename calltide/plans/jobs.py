"""Bronze, Silver, Gold, forecast, anomaly and tuning jobs.

Each job reads layers, composes operators and writes one layer. No rows pass
through the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calltide.functions.columns import all_of
from calltide.functions.times import NTZ, as_utc, ntz
from calltide.operators.anomaly import actual_vs_forecast, breach_streak, flag_breaches
from calltide.operators.conform import CORE_TYPES, conform, enrich_lookup, missing_columns, to_silver
from calltide.operators.evaluate import calibrated_band, mape_tail, rolling_origin_forecasts
from calltide.operators.forecast import forecast_trend_seasonal, require_rows
from calltide.operators.merge import dedup_latest, sized
from calltide.operators.models import apply_promotions, promote_if_better, register_runs, set_stage
from calltide.operators.origins import origin_forecasts
from calltide.operators.quality import SILVER_RULES, Rule, enforce_report, missing_notes, quality_report
from calltide.operators.regression import (
    draw_trials,
    fit_regression,
    fit_trials,
    forecast_infer,
    predict_regression,
    require_models,
    tune,
)
from calltide.operators.carry import months_to_redo, rows_after, tails, with_features
from calltide.operators.series import DAILY_KEYS, series_total
from calltide.params import Params
from calltide.sources.layers import (
    Layer,
    append_layer,
    append_only_layer,
    delete_keys,
    in_partitions,
    layer_exists,
    layer_partitions,
    overwrite_layer,
    parked,
    read_layer,
    replace_partitions,
    upsert_layer,
    write_bronze,
)
from calltide.sources.pages import raw_to_bronze, stamp_ingestion
from calltide.sources.scratch import own_scratch
from calltide.sources.slices import ingest_summary, window_bounds

REGISTRY_SCHEMA = "model_name string, version bigint, params map<string,string>, mape string, stage string"


@dataclass(frozen=True)
class Layers:
    """The layers of one environment below a common root."""

    root: str

    def __getattr__(self, name: str) -> Layer:
        if name.startswith("_"):
            raise AttributeError(name)
        return Layer(self.root, name)


def _stored(spark: SparkSession, layer: Layer, schema: str) -> DataFrame:
    """The layer, or an empty table before its first write."""
    return read_layer(spark, layer) if layer_exists(spark, layer) else spark.createDataFrame([], schema)


def _load_columns(df: DataFrame) -> list[str]:
    """Load date and, where rows have them, the parts of their time of receipt."""
    return [c for c in ("ingestion_date", "received_year", "received_month") if c in df.columns]


@own_scratch
def bronze_job(
    raw: DataFrame,
    layers: Layers,
    as_of: str,
    append_only: bool = False,
    params: Params = Params(),
    only_window: bool = False,
) -> DataFrame:
    """Land raw pages: names, received parts, load date, then merge by key or append.

    Raw rows are read once. Each load is recorded with a number of its own and
    the partitions it has rows in, which the Silver job looks for, and with its
    record count and time range. With ``only_window`` just the rows created in
    the trailing ``sample_days`` (and overlap) before ``as_of`` are taken. Rows
    of an append-only layer carry the number of their load, which says what
    arrived last.
    """
    spark = raw.sparkSession
    rows = raw_to_bronze(raw, as_of)
    first = F.lit(1).cast("bigint")
    if layer_exists(spark, layers.bronze_loads) and "load_number" in read_layer(spark, layers.bronze_loads).columns:
        before = read_layer(spark, layers.bronze_loads).agg(F.max("load_number").alias("last"))
        first = F.coalesce(before.select("last").scalar(), F.lit(0).cast("bigint")) + 1
    if append_only or "unique_key" not in rows.columns:
        rows = rows.withColumn("load_number", first)
    if only_window:
        created = as_utc(rows, "created_date", params.source_tz)
        start, end = window_bounds(as_of, params.sample_days, params.overlap_days)
        rows = rows.filter((created >= ntz(start)) & (created < ntz(end)))
    arrived: list[DataFrame] = []
    write_bronze(rows, layers.bronze, append_only=append_only, in_place=params.in_place, check=arrived.append, precedence=params.precedence)
    number = F.lit(uuid.uuid4().hex).alias("load_id")
    load = arrived[0].select(*_load_columns(rows)).distinct()
    append_layer(load.select(number, "*", first.alias("load_number")), layers.bronze_loads)
    timed = arrived[0].select(
        "ingestion_date", (as_utc(rows, "created_date", params.source_tz) if "created_date" in rows.columns else F.lit(None).cast(NTZ)).alias("ts")
    )
    summary = ingest_summary(timed, "ts").select(number, F.lit(str(as_of)[:10]).cast("date").alias("ingestion_date"), "*")
    append_layer(summary, layers.ingest_summaries)
    return read_layer(spark, layers.bronze)


def _bronze_slice(
    spark: SparkSession, layers: Layers, params: Params, full: bool, load_dates: tuple[str, str] | None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bronze rows of the loads the Silver job takes over, all rows of their keys, and those loads.

    The loads are those not yet taken over, whatever their date, and those of
    the last ``overlap_days`` dates once more (1: the newest date). A load names its partitions, so no
    others are read. In append-only Bronze a key may have rows in other loads,
    and the latest of all of them counts.
    """
    bronze = read_layer(spark, layers.bronze)
    loads = _stored(spark, layers.bronze_loads, "load_id string, ingestion_date date")
    columns = _load_columns(loads)
    done = _stored(spark, layers.silver_loads, "load_id string, ingestion_date date")
    if load_dates is not None:
        low, high = [F.lit(d).cast("date") for d in load_dates]
        wanted = loads.filter(F.col("ingestion_date").between(low, high))
        own = bronze.filter(F.col("ingestion_date").between(low, high))
    elif full or not layer_exists(spark, layers.silver) or not layer_exists(spark, layers.silver_loads):
        return bronze, bronze, loads
    else:
        recent = done.agg(F.date_sub(F.max("ingestion_date"), params.overlap_days).alias("low")).select("low").scalar()
        seen = loads.join(done.select("load_id").distinct().withColumn("old", F.lit(True)), "load_id", "left")
        due = F.col("old").isNull() | (F.col("ingestion_date") > recent)
        # A filter on stored rows, not a finished list, is what makes Spark prune the other side of a join.
        judged = parked(seen.select(*loads.columns, F.when(due, "due").otherwise("done").alias("state")), "loads")
        wanted = judged.filter("state = 'due'").drop("state")
        own = in_partitions(bronze, wanted.select(*columns).distinct(), columns)
    if not append_only_layer(spark, layers.bronze) or "unique_key" not in bronze.columns:
        return own, own, wanted
    keys = own.select(F.col("unique_key").alias("__key")).distinct()
    rows = bronze.join(sized(keys, own.count()), F.col("unique_key") == F.col("__key"), "left_semi")
    return own, rows.unionByName(own.filter(F.col("unique_key").isNull())), wanted


_REJECT_PARTS = {"ingestion_date": "date", "received_year": "int", "received_month": "int"}


def _replace_rejects(own: DataFrame, loads: DataFrame, layers: Layers) -> None:
    """Store rows without a readable key as raw text, in place of those of the loads they come from, and of no others.

    The layer is laid out by load date and only the dates of these loads are
    rewritten.
    """
    spark, columns = own.sparkSession, list(_REJECT_PARTS)
    part = lambda df, c: F.col(c) if c in df.columns else F.lit(None)
    parts = lambda df: [part(df, c).cast(k).alias(c) for c, k in _REJECT_PARTS.items()]
    text = F.to_json(F.struct(*[c for c in own.columns if c not in (*columns, "load_number")])).alias("raw")
    readable = F.col("unique_key").try_cast("bigint").isNotNull() if "unique_key" in own.columns else F.lit(False)
    rejected = own.filter(~readable).select(text, F.lit("unreadable key").alias("reason"), *parts(own))
    if not layer_exists(spark, layers.rejects):
        overwrite_layer(rejected, layers.rejects, ["ingestion_date"])
        return
    if layer_partitions(spark, layers.rejects) != ["ingestion_date"]:  # written by an earlier version
        stored = read_layer(spark, layers.rejects)
        overwrite_layer(stored.select("raw", "reason", *parts(stored)), layers.rejects, ["ingestion_date"])
    wanted = parked(loads.select(*parts(loads)).distinct().withColumn("kind", F.lit("reread")), "reread").filter("kind = 'reread'")
    dates = wanted.select("ingestion_date").distinct()
    named = wanted.select(*[F.col(c).alias(f"__{c}") for c in columns])
    old = in_partitions(read_layer(spark, layers.rejects), dates, ["ingestion_date"])
    other = old.join(named, all_of([old[c].eqNullSafe(named[f"__{c}"]) for c in columns]), "left_anti")
    replace_partitions(other.unionByName(rejected).select(*old.columns), layers.rejects, dates)


def _log_changes(spark: SparkSession, layers: Layers, run: str) -> Callable[[DataFrame | None, DataFrame | None], None]:
    """Record what a run changes in Silver: rows that leave count -1, rows that come count +1, per day and series.

    The run is marked as started before anything is written and as done after
    Silver has changed, so that Gold can tell a run that was cut off.
    """

    def counted(df: DataFrame, sign: int) -> DataFrame:
        day = F.to_date("created_ts_utc").alias("ds")
        return df.groupBy(day, *DAILY_KEYS).agg((F.count(F.lit(1)) * sign).alias("delta"))

    def log(old: DataFrame | None, new: DataFrame | None) -> None:
        _mark(spark, layers.silver_runs, run, "started")
        if old is None and not layer_exists(spark, layers.daily):
            return  # the first load, all of which the first Gold run counts
        sides = [counted(df, sign) for df, sign in ((old, -1), (new, 1)) if df is not None]
        both = sides[0].unionByName(sides[1]) if len(sides) == 2 else sides[0]
        net = both.groupBy("ds", *DAILY_KEYS).agg(F.sum("delta").alias("delta")).filter("delta <> 0")
        append_layer(net.select("*", F.trunc("ds", "month").alias("month"), F.lit(run).alias("run")), layers.silver_changes, ["run"])

    return log


def _mark(spark: SparkSession, layer: Layer, run: str, state: str) -> None:
    append_layer(spark.range(1).select(F.lit(run).alias("run"), F.lit(state).alias("state")), layer)


@own_scratch
def silver_job(
    spark: SparkSession,
    layers: Layers,
    as_of: str,
    params: Params = Params(),
    rules: Sequence[Rule] = SILVER_RULES,
    lookup: DataFrame | None = None,
    full: bool = False,
    load_dates: tuple[str, str] | None = None,
) -> DataFrame:
    """Conform new Bronze rows, check every one of them, and merge them by key.

    New are loads that no run has taken over yet, also those with an earlier
    load date; ``full`` reads all of Bronze and ``load_dates`` (first and last)
    a range of loads again. ``bronze_date`` keeps Bronze's own load date. Of
    several rows of a key that of the load which arrived last counts, or with
    ``precedence="load_date"`` that of the latest load date, whichever loads are
    read again and however Bronze is laid out. Rows without a readable key
    cannot be merged: they go to the layer ``rejects`` as text, replaced
    whenever their load is read again.

    What a run changes is logged as signed counts per day and series
    (``silver_changes``), which the Gold job adds up.

    The quality report is stored before it is enforced and names core columns
    the input lacked.

    Silver is laid out by month of creation, which a request keeps for life, so
    a daily run rewrites only the months its rows fall in.
    """
    own, rows, loads = _bronze_slice(spark, layers, params, full, load_dates)
    typed = conform(rows, {**CORE_TYPES, "ingestion_date": "date", "load_number": "bigint"}, params.source_tz)
    keyed = to_silver(typed).filter(F.col("unique_key").isNotNull()).withColumnRenamed("ingestion_date", "bronze_date")
    newest = ["load_number", "bronze_date"] if params.precedence == "arrival" else ["bronze_date", "load_number"]
    latest = dedup_latest(keyed, ["unique_key"], [*newest, "created_ts_utc"], null_keys="drop").drop("load_number")
    if lookup is not None:
        latest = enrich_lookup(latest, lookup, "borough")
    stamped = stamp_ingestion(latest, as_of).withColumn("created_month", F.trunc("created_ts_utc", "month"))
    notes = missing_notes(missing_columns(rows))
    run = uuid.uuid4().hex

    def check(staged: DataFrame) -> None:
        overwrite_layer(quality_report(staged, [*rules, *notes]), layers.quality)
        enforce_report(read_layer(spark, layers.quality))

    upsert_layer(
        stamped, layers.silver, ["unique_key"], partition_by=["created_month"], in_place=params.in_place, check=check,
        changes=_log_changes(spark, layers, run),
    )
    _mark(spark, layers.silver_runs, run, "done")
    _replace_rejects(own, loads, layers)
    append_layer(loads.select("load_id", "ingestion_date").distinct(), layers.silver_loads)
    return read_layer(spark, layers.silver)


@own_scratch
def forget_job(spark: SparkSession, layers: Layers, gone: DataFrame) -> DataFrame:
    """Delete the requests whose ``unique_key`` is in ``gone`` from Silver; the next Gold run takes their counts back.

    Bronze is left alone: a load of theirs that is read again brings them back.
    """
    run = uuid.uuid4().hex
    delete_keys(gone, layers.silver, ["unique_key"], _log_changes(spark, layers, run))
    _mark(spark, layers.silver_runs, run, "done")
    return read_layer(spark, layers.silver)


def _counted(silver: DataFrame) -> DataFrame:
    counts = silver.groupBy(F.to_date("created_ts_utc").alias("ds"), *DAILY_KEYS).agg(F.count(F.lit(1)).alias("y"))
    return counts.withColumn("month", F.trunc("ds", "month"))


_RUNS = "run string, state string"
_CHANGES = "ds date, complaint_type string, borough string, agency string, delta bigint, month date, run string"


def _open_runs(spark: SparkSession, layers: Layers) -> DataFrame:
    """Silver runs that Gold has not taken over, one row each, stored.

    ``add`` is the state of a run whose changes can be added. ``recount`` is
    that of a run which was cut off, in Silver or in an earlier Gold run: the
    months it names are counted again.
    """
    silver = _stored(spark, layers.silver_runs, _RUNS).groupBy("run").agg(F.max((F.col("state") == "done").cast("int")).alias("whole"))
    gold = _stored(spark, layers.gold_runs, _RUNS).groupBy(F.col("run").alias("seen")).agg(F.max((F.col("state") == "done").cast("int")).alias("taken"))
    left = silver.join(gold, F.col("run") == F.col("seen"), "left").filter("taken IS NULL OR taken = 0")
    whole = (F.col("whole") == 1) & F.col("taken").isNull()
    return parked(left.select("run", F.when(whole, "add").otherwise("recount").alias("state")), "runs")


def _net_changes(spark: SparkSession, layers: Layers, runs: DataFrame) -> DataFrame:
    """Day, series, month and signed count of the changes of these runs, stored; ``state`` says how its month is renewed."""
    changes = _stored(spark, layers.silver_changes, _CHANGES)
    renamed = runs.filter("state IS NOT NULL").withColumnRenamed("run", "__run")
    net = changes.join(renamed, F.col("run") == F.col("__run")).groupBy("ds", *DAILY_KEYS, "month").agg(
        F.sum("delta").alias("delta"), F.max("state").alias("state")  # recount is the greater word
    )
    return parked(net.filter("delta <> 0 OR state = 'recount'"), "changes")


def gold_changes(daily: DataFrame, changes: DataFrame, months: DataFrame) -> DataFrame:
    """Daily counts of the touched months after the changes: what there was plus the signed counts."""
    columns = ["ds", *DAILY_KEYS, "month"]
    held = in_partitions(daily, months, ["month"]).select(*columns, "y")
    added = changes.select(*columns, F.col("delta").alias("y"))
    return held.unionByName(added).groupBy(*columns).agg(F.sum("y").alias("y")).filter("y <> 0").select("ds", *DAILY_KEYS, "y", "month")


@own_scratch
def gold_job(spark: SparkSession, layers: Layers, full: bool = False) -> DataFrame:
    """Daily counts with lag and mean, laid out by month.

    Silver's runs log what they change. Those that Gold has not taken over are
    added to the counts of the months they name; Silver itself is not read.
    Features depend on the rows before, so the last rows of every month and
    series are kept as well (``daily_tails``): only series that changed are
    computed again, in their changed months and as far as seven rows beyond.
    Other months keep their files. The result equals that of ``full``, which
    counts all of Silver.

    A run that was cut off has its months counted again from Silver. ``full``
    is needed only when Silver was changed by other means than these jobs.
    """
    runs = _open_runs(spark, layers)
    if full or not all(layer_exists(spark, x) for x in (layers.daily, layers.daily_tails, layers.gold)):
        overwrite_layer(_counted(read_layer(spark, layers.silver)), layers.daily, ["month"])
        daily = read_layer(spark, layers.daily)
        overwrite_layer(tails(daily), layers.daily_tails, ["year"])
        overwrite_layer(with_features(daily), layers.gold, ["month"])
        append_layer(runs.select("run", F.lit("done").alias("state")), layers.gold_runs)
        return read_layer(spark, layers.gold)
    if runs.isEmpty():
        return read_layer(spark, layers.gold)
    changes = _net_changes(spark, layers, runs)
    if not changes.isEmpty():
        append_layer(runs.select("run", F.lit("started").alias("state")), layers.gold_runs)
        _add_changes(spark, layers, changes)
    append_layer(runs.select("run", F.lit("done").alias("state")), layers.gold_runs)
    return read_layer(spark, layers.gold)


def _add_changes(spark: SparkSession, layers: Layers, changes: DataFrame) -> None:
    daily, held = read_layer(spark, layers.daily), read_layer(spark, layers.daily_tails)
    months = parked(changes.groupBy("month").agg(F.max("state").alias("state")), "months")
    add, recount = [months.filter(F.col("state") == s).select("month") for s in ("add", "recount")]
    touched = months.filter("state IS NOT NULL").select("month")
    counts = gold_changes(daily, in_partitions(changes, add, ["month"]), add)
    changed = changes.select(*DAILY_KEYS, "month", F.when(F.col("state") == "add", F.col("ds")).alias("last"))
    whole = lambda df: in_partitions(df, recount, ["month"]).select(*DAILY_KEYS, "month", F.last_day("month").alias("last"))
    if not recount.isEmpty():
        silver = read_layer(spark, layers.silver)
        counts = counts.unionByName(_counted(in_partitions(silver, recount.withColumnRenamed("month", "created_month"), ["created_month"])))
        changed = changed.unionByName(whole(daily))
    fresh = parked(counts, "counts")
    if not recount.isEmpty():
        changed = changed.unionByName(whole(fresh))
    changed = changed.groupBy(*DAILY_KEYS, "month").agg(F.max("last").alias("last"))
    changed = parked(rows_after(fresh, changed, n=fresh.count()), "changed")  # counts are from the files' footers
    replace_partitions(fresh, layers.daily, touched)
    years = parked(touched.select(F.year("month").alias("year")).distinct().withColumn("kind", F.lit("touched")), "years").filter("kind = 'touched'")
    named = touched.withColumnRenamed("month", "__month")
    stay = in_partitions(held, years, ["year"]).join(named, F.col("month").eqNullSafe(F.col("__month")), "left_anti")
    replace_partitions(stay.unionByName(tails(fresh)).select(*held.columns), layers.daily_tails, years)

    series = parked(months_to_redo(read_layer(spark, layers.daily_tails), changed, n=changed.count()), "series")
    redo = series.filter("state = 'redo'")
    stale = parked(redo.select("month").unionByName(touched).distinct().withColumn("kind", F.lit("stale")), "stale").filter("kind = 'stale'").select("month")
    same = lambda a, b: all_of([a[c].eqNullSafe(b[f"__{c}"]) for c in ("month", *DAILY_KEYS)])
    mine = sized(redo.select(*[F.col(c).alias(f"__{c}") for c in ("month", *DAILY_KEYS)]), redo.count())
    gold, daily = read_layer(spark, layers.gold), read_layer(spark, layers.daily)
    counted = in_partitions(daily, stale, ["month"])
    rows = counted.join(mine, same(counted, mine), "left_semi").withColumn("state", F.lit("redo"))
    before = series.filter("state = 'before'").select(*DAILY_KEYS, "month", F.inline("tail"), "state")
    computed = with_features(rows.unionByName(before.select(*rows.columns))).filter("state = 'redo'").drop("state")
    old = in_partitions(gold, stale, ["month"])
    kept = old.join(mine, same(old, mine), "left_anti")
    replace_partitions(kept.unionByName(computed).select(*gold.columns), layers.gold, stale)


def _registry(spark: SparkSession, layers: Layers) -> DataFrame:
    return _stored(spark, layers.model_runs, REGISTRY_SCHEMA)


def _model_name(prefix: str, keys: Sequence[str]):
    """Prefix and key values joined by "/"; a "/" or "\\" inside a value is escaped and NULL is a mark of its own."""
    escaped = [F.replace(F.replace(F.col(k).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("/"), F.lit("\\/")) for k in keys]
    return F.concat_ws("/", F.lit(prefix), *[F.coalesce(e, F.lit("\\N")) for e in escaped])


def forecast_job(
    spark: SparkSession,
    layers: Layers,
    keys: Sequence[str] = (),
    params: Params = Params(),
    method: str = "regression",
    model_prefix: str = "requests",
    model_params: dict[str, str] | None = None,
    calibrated: bool = False,
    origins: int = 6,
) -> DataFrame:
    """Forecast the daily totals, store the forecast, and log the training score.

    The score is in-sample and says nothing against the held-out scores of
    tuned versions, so it goes to ``training_log`` and not to the registry.
    ``calibrated`` takes the band ahead from held-out residuals at that many
    ``origins`` instead of the spread of the fit.
    """
    series = require_rows(series_total(read_layer(spark, layers.gold), keys), "daily table")
    if method == "regression":
        overwrite_layer(fit_regression(series, keys, model_params), layers.latest_fit)
        fitted = read_layer(spark, layers.latest_fit)
        forecast = predict_regression(fitted, keys, params.horizon_days, interval_width=params.interval_width)
    else:
        forecast = forecast_trend_seasonal(
            series, keys, params.horizon_days, interval_width=params.interval_width
        )
    if calibrated:
        days = params.horizon_days
        if method == "regression":
            held = origin_forecasts(series, keys, origins, days, None, days, model_params)
        else:
            held = rolling_origin_forecasts(series, keys, origins, days, 90, days)
        forecast = calibrated_band(forecast, held, keys, params.interval_width)
    overwrite_layer(forecast, layers.forecasts)
    stored = read_layer(spark, layers.forecasts)

    score = mape_tail(stored, series, keys, params.horizon_days, more_than=28)
    settings = F.create_map(
        F.lit("horizon_days"), F.lit(str(params.horizon_days)), F.lit("method"), F.lit(method)
    )
    run = F.lit(uuid.uuid4().hex).alias("run_id")
    append_layer(score.select(run, _model_name(model_prefix, keys).alias("model_name"), settings.alias("params"), "mape"), layers.training_log)
    return stored


def anomaly_job(
    spark: SparkSession, layers: Layers, keys: Sequence[str] = (), params: Params = Params()
) -> DataFrame:
    """Compare daily totals with the forecast's upper bound and store breaches and alerts."""
    actual = series_total(read_layer(spark, layers.gold), keys)
    joined = actual_vs_forecast(actual, read_layer(spark, layers.forecasts), keys)
    overwrite_layer(breach_streak(flag_breaches(joined), keys, params.alert_after), layers.anomalies)
    return read_layer(spark, layers.anomalies)


@own_scratch
def tune_job(
    spark: SparkSession,
    layers: Layers,
    keys: Sequence[str] = (),
    params: Params = Params(),
    n_trials: int = 20,
    model_prefix: str = "requests",
    trials: list[dict[str, str]] | None = None,
) -> DataFrame:
    """Score all trials, register them with their fitted models, and promote the best version when it is better.

    Every trial is scored on held-out days and then fitted on all days; its
    coefficients are stored under the version it is registered as. Without
    ``trials`` there are ``n_trials`` of a seeded draw.
    """
    series = require_rows(series_total(read_layer(spark, layers.gold), keys), "daily table")
    settings = trials or draw_trials(n_trials)
    trials = tune(series, keys, settings, params.horizon_days).withColumn("model_name", _model_name(model_prefix, keys))
    overwrite_layer(register_runs(_registry(spark, layers), trials, keep=["trial"]), layers.latest_trials)
    numbered = read_layer(spark, layers.latest_trials)
    append_layer(numbered.drop("trial"), layers.model_runs)
    fitted = fit_trials(series, keys, settings).withColumn("model_name", _model_name(model_prefix, keys))
    versions = numbered.select("model_name", "trial", "version")
    append_layer(fitted.join(versions, ["model_name", "trial"]).drop("trial"), layers.coefficients)
    registry = _registry(spark, layers)
    overwrite_layer(promote_if_better(registry), layers.promotions)
    require_rows(read_layer(spark, layers.promotions), "model versions with a score")
    overwrite_layer(apply_promotions(registry), layers.model_runs)
    return read_layer(spark, layers.promotions)


def stage_job(spark: SparkSession, layers: Layers, stage: str = "Production", source: str = "Staging") -> DataFrame:
    """Move the newest version in ``source`` of every model to ``stage``."""
    registry = _registry(spark, layers)
    newest = registry.filter(F.col("stage") == source).groupBy("model_name").agg(F.max("version").alias("version"))
    changed = set_stage(registry, newest.withColumn("stage", F.lit(stage)))
    overwrite_layer(changed, layers.model_runs)
    return _registry(spark, layers)


def infer_job(
    spark: SparkSession, layers: Layers, keys: Sequence[str] = (), params: Params = Params(), stage: str = "Production"
) -> DataFrame:
    """Forecast the days after the data from the stored models in ``stage``, without fitting.

    Raises when a live version has no stored model.
    """
    registry, coefficients = _registry(spark, layers), read_layer(spark, layers.coefficients)
    require_models(coefficients, registry, stage)
    forecast = forecast_infer(coefficients, registry, keys, params.horizon_days, stage, params.interval_width)
    overwrite_layer(forecast, layers.inferred)
    return read_layer(spark, layers.inferred)


def run_all(
    spark: SparkSession,
    raw: DataFrame,
    layers: Layers,
    as_of: str,
    keys: Sequence[str] = (),
    params: Params = Params(),
    method: str = "regression",
) -> DataFrame:
    """Every stage once: Bronze, Silver, Gold, forecast, anomalies."""
    bronze_job(raw, layers, as_of, params=params)
    silver_job(spark, layers, as_of, params)
    gold_job(spark, layers)
    forecast_job(spark, layers, keys, params, method)
    return anomaly_job(spark, layers, keys, params)


__all__ = [
    "DAILY_KEYS",
    "Layers",
    "anomaly_job",
    "bronze_job",
    "forecast_job",
    "forget_job",
    "gold_job",
    "infer_job",
    "run_all",
    "silver_job",
    "stage_job",
    "tune_job",
]
