"""Writes to catalog tables by qualified name, through Spark's own writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calltide.functions.columns import any_null
from calltide.operators.merge import dedup_latest, upsert
from calltide.sources.layers import by_partitions, drop_left, files_of, parked
from calltide.sources.scratch import own_scratch


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


@own_scratch
def overwrite_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), bucket_by: Sequence[str] = (), buckets: int = 0
) -> None:
    """Create the table, or replace it with its schema.

    The rows are written to the shared folder first, so they may come from the
    table itself. With ``buckets`` rows of a key in ``bucket_by`` lie in the
    same one of so many files of a partition, sorted, which joins on the key
    make use of.
    """
    rows = parked(df, "table")
    if buckets:
        rows = rows.repartition(buckets, *bucket_by)  # the hash of the buckets: a task writes one bucket
    writer = rows.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)


def append_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to the table, created if missing; columns are matched by name.

    New columns join the table and are NULL on older rows; a column that
    arrives with another type raises.
    """
    spark = df.sparkSession
    if not table_exists(spark, name):
        overwrite_table(df, name, partition_by)
        return
    _widen(df, name)
    columns = spark.table(name).schema
    rows = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in columns])
    rows.write.insertInto(name)


def _widen(df: DataFrame, name: str) -> None:
    """Add new columns to the table; raises when a column arrives with another type."""
    spark = df.sparkSession
    held = spark.table(name).schema
    changed = [f.name for f in df.schema if f.name in held.names and f.dataType != held[f.name].dataType]
    if changed:
        raise ValueError(f"columns change type: {changed}")
    added = [f for f in df.schema if f.name not in held.names]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")


def homes(target: DataFrame, staged: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Partitions of the target that hold a staged key.

    When the target is bucketed by the keys its rows stay where they are and
    only the staged keys are shuffled, however far apart they lie.
    """
    named = staged.select(*keys).filter(~any_null(keys))
    return target.select(*dict.fromkeys([*columns, *keys])).join(named, list(keys), "left_semi").select(*columns).distinct()


def merged(target: DataFrame, staged: DataFrame, keys: Sequence[str], touched: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of the touched partitions after the upsert; a bucketed target isn't shuffled."""
    named = staged.select(*keys).filter(~any_null(keys))
    kept = [part.join(named, list(keys), "left_anti").select(*target.columns) for part in by_partitions(target, touched, columns)]
    return kept[0].unionByName(kept[1]).unionByName(staged, allowMissingColumns=True).select(*target.columns)


@own_scratch
def upsert_table(
    staged: DataFrame,
    name: str,
    keys: Sequence[str],
    latest_by: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    buckets: int = 0,
) -> None:
    """Upsert into the table, created if missing, partitioned and bucketed by the keys as asked.

    Of a partitioned table only partitions that receive rows or hold a staged
    key are read in full and rewritten; emptied ones are dropped. Other tables are
    rewritten whole. New columns join the table. Rows with a NULL key are
    inserted each time.
    """
    spark = staged.sparkSession
    fresh = dedup_latest(staged, keys, latest_by) if latest_by is not None else staged
    if not table_exists(spark, name):
        overwrite_table(fresh, name, partition_by, keys, buckets)
        return
    columns = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if not columns:
        overwrite_table(upsert(spark.table(name), fresh, keys), name, (), keys, buckets)
        return
    lacking = [c for c in spark.table(name).columns if c not in staged.columns]
    if lacking:
        raise ValueError(f"staged rows lack target columns: {lacking}")
    _widen(fresh, name)
    fresh = parked(fresh, "staged")
    target = spark.table(name)
    arriving = fresh.select(*columns).distinct()
    touched = parked(homes(target, fresh, keys, columns).unionByName(arriving).distinct().withColumn("kind", F.lit("touched")), "touched")
    touched = touched.filter("kind = 'touched'").select(*columns)
    before = files_of(target, touched, columns, "before")
    setting = "spark.sql.sources.partitionOverwriteMode"
    mode = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        merged(target, fresh, keys, touched, columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(setting, mode)
    spark.catalog.refreshTable(name)
    drop_left(before, files_of(spark.table(name), touched, columns, "after"))
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
