"""Streaming daily counts, deduplication and upsert.

For large state use the RocksDB state store
(``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from calltide.functions.columns import any_null
from calltide.functions.times import instant, utc_wall
from calltide.operators.series import daily_counts
from calltide.sources.layers import Layer, in_partitions, layer_exists, overwrite_layer, parked, read_layer, replace_partitions, upsert_layer
from calltide.sources.scratch import own_scratch


def watermarked(stream: DataFrame, ts: str, overlap_days: int) -> DataFrame:
    """Accept rows up to ``overlap_days`` late. A wall clock becomes the zoned time watermarks need."""
    if isinstance(stream.schema[ts].dataType, T.TimestampNTZType):
        stream = stream.withColumn(ts, instant(F.col(ts)))
    return stream.withWatermark(ts, f"{overlap_days} days")


def stream_daily_counts(stream: DataFrame, ts: str, keys: Sequence[str], overlap_days: int = 1) -> DataFrame:
    """Rows per day and series, each day emitted once it is ``overlap_days`` past."""
    return (
        watermarked(stream, ts, overlap_days)
        .groupBy(F.window(ts, "1 day").alias("__w"), *keys)
        .agg(F.count(F.lit(1)).alias("y"))
        .select(utc_wall(F.col("__w.start")).cast("date").alias("ds"), *keys, "y")
    )


@own_scratch
def _take_batch(batch: DataFrame, number: int, root: str, ts: str, keys: Sequence[str], overlap_days: int) -> DataFrame:
    spark = batch.sparkSession
    counts, late, seen = [Layer(root, n) for n in ("counts", "late", "batches")]
    number_col = F.lit(number).cast("bigint").alias("batch_id")
    wall = F.col(ts) if isinstance(batch.schema[ts].dataType, T.TimestampNTZType) else utc_wall(F.col(ts))
    daily = parked(daily_counts(batch.select(wall.alias("__ts"), *keys), "__ts", keys), "daily")
    newest = batch.agg(F.max(wall).alias("newest"), F.count(F.lit(1)).alias("records")).select(number_col, "newest", "records")
    if layer_exists(spark, seen):
        before = read_layer(spark, seen).filter(F.col("batch_id") < number)
        closed = before.agg(F.to_date(F.max("newest") - F.expr(f"interval {overlap_days} days")).alias("closed")).select("closed").scalar()
        is_late = F.coalesce(F.col("ds") < closed, F.lit(False))
    else:
        is_late = F.lit(False)
    split = parked(daily.withColumn("__late", is_late), "split")
    _swap_batch(split.filter("__late").select("ds", *keys, "y", number_col), late, number)
    _swap_batch(newest, seen, number)

    fresh = split.filter("NOT __late").drop("__late")
    if not layer_exists(spark, counts):
        first = fresh.select("ds", *keys, "y", number_col, F.lit(0).cast("bigint").alias("y_before"), F.trunc("ds", "month").alias("month"))
        overwrite_layer(first, counts, ["month"])
        return read_layer(spark, counts)
    months = parked(fresh.select(F.trunc("ds", "month").alias("month")).distinct().withColumn("kind", F.lit("open")), "months").filter("kind = 'open'")
    held = in_partitions(read_layer(spark, counts), months.select("month"), ["month"])
    # A batch that is run again starts from the counts before it.
    again = F.col("batch_id") == number
    base = held.select("ds", *keys, "y", "batch_id", F.when(again, F.col("y_before")).otherwise(F.col("y")).alias("y_before"), F.lit(None).cast("bigint").alias("more"))
    none = F.lit(None).cast("bigint")
    both = base.unionByName(fresh.select("ds", *keys, none.alias("y"), none.alias("batch_id"), none.alias("y_before"), F.col("y").alias("more")))
    added = both.groupBy("ds", *keys).agg(
        F.max("y").alias("__y"), F.max("batch_id").alias("__batch"), F.coalesce(F.max("y_before"), F.lit(0)).alias("y_before"), F.max("more").alias("__more")
    )
    changed = F.col("__more").isNotNull()
    rows = added.select(
        "ds", *keys,
        F.when(changed, F.col("y_before") + F.col("__more")).otherwise(F.col("__y")).alias("y"),
        F.when(changed, F.lit(number)).otherwise(F.col("__batch")).cast("bigint").alias("batch_id"),
        "y_before", F.trunc("ds", "month").alias("month"),
    )
    replace_partitions(rows, counts, months.select("month"))
    return read_layer(spark, counts)


def _swap_batch(rows: DataFrame, layer: Layer, number: int) -> None:
    """Store the rows of a batch, in place of those of an earlier try."""
    spark = rows.sparkSession
    if not layer_exists(spark, layer):
        overwrite_layer(rows, layer, ["batch_id"])
        return
    replace_partitions(rows, layer, spark.range(number, number + 1).select(F.col("id").alias("batch_id")))


def stream_daily_totals(
    stream: DataFrame, root: str, ts: str, keys: Sequence[str], checkpoint: str, overlap_days: int = 1
) -> StreamingQuery:
    """Keep rows per day and series up to date while they arrive, and report the rows that come too late.

    Three layers below ``root``: ``counts`` (``ds``, keys, ``y``) holds every day as it stands after the last batch, so open
    days can be read at once. A row whose day had closed before its batch, ``overlap_days`` before the newest time of all
    earlier batches, is not counted: ``late`` has the number of such rows per batch, day and series. ``batches`` has the newest
    time and the number of records of each batch. Counted and late rows add up to the input.

    The layers are the state, laid out by month and by batch, and a batch swaps only what it touches; nothing is held in
    memory between batches. A batch that is run again after a failure gives the same result, since each count keeps the value
    it had before its last batch. Rows without a time are counted under a NULL day.
    """

    def apply(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            _take_batch(batch, number, root, ts, keys, overlap_days)

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_latest(
    stream: DataFrame, keys: Sequence[str], ts: str, latest_by: Sequence[str], overlap_days: int = 1
) -> DataFrame:
    """The latest row per key, emitted once the key has been quiet for the overlap; later rows of the key start anew.

    ``latest_by`` decides, ties are broken by all other columns, as in ``dedup_latest``. The rows of a key belong together as long as
    no two neighbours in time are further apart than ``overlap_days``: a session. State is one row per open session, and is
    dropped when the watermark passes its end. Rows are combined per input partition first, so that a key with very many rows
    reaches its task as one row per input partition. Rows without a key are all kept, each as a key of its own.
    """
    timed = watermarked(stream, ts, overlap_days)
    others = [c for c in timed.columns if c not in (*keys, *latest_by)]
    own = F.when(any_null(keys), F.expr("uuid()")).alias("__own")
    row = F.struct(*latest_by, *others)
    window = F.session_window(ts, f"{overlap_days} days").alias("__session")
    newest = timed.select("*", own).groupBy(window, *keys, "__own").agg(F.max(row).alias("__row"))
    back = newest.select(*keys, "__row.*").select(*timed.columns)
    if isinstance(stream.schema[ts].dataType, T.TimestampNTZType):
        back = back.withColumn(ts, utc_wall(F.col(ts)))
    return back


def stream_dedup(stream: DataFrame, key: str, ts: str, overlap_days: int = 1, salts: int = 32) -> DataFrame:
    """First row per key within the overlap; rows without a key are all kept.

    Duplicates are dropped in two steps, first per key and input partition
    group (``salts`` of them), so a key with very many copies does not load one
    task. A row without a key gets a name of its own, which equals no other.
    """
    own = F.when(F.col(key).isNull(), F.expr("uuid()"))
    return (
        watermarked(stream, ts, overlap_days)
        .withColumns({"__own": own, "__salt": F.pmod(F.spark_partition_id(), F.lit(salts))})
        .dropDuplicatesWithinWatermark([key, "__own", "__salt"])
        .drop("__salt")
        .dropDuplicatesWithinWatermark([key, "__own"])
        .drop("__own")
    )


def stream_upsert(
    stream: DataFrame,
    layer: Layer,
    keys: Sequence[str],
    latest_by: Sequence[str],
    checkpoint: str,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Upsert every micro-batch into a layer; a replayed batch changes nothing.

    A row without a key enters once: it is left out when an equal row is there.
    """

    @own_scratch
    def apply(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            upsert_layer(batch, layer, keys, latest_by, partition_by, null_keys="once")

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write an append-mode stream to Parquet files until the available input is used up."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def read_stream(
    spark: SparkSession, folder: str, file_name: str, files_per_batch: int | None = None
) -> DataFrame:
    """Stream the Parquet files of a folder that match ``file_name``.

    ``files_per_batch`` bounds a micro-batch; rows of files read later than the
    watermark allows are then late.
    """
    schema = spark.read.parquet(f"{folder}/{file_name}").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", file_name)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    return stream.parquet(folder)
