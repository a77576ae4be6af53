"""Stored layers: partitioned Parquet folders with a small commit record.

A layer is ``<root>/<name>``. Each commit record names the folder that holds the
rows, their schema and the partition columns; readers follow the newest record,
so a rewrite goes to a new folder and is published by one small file at the
end. Appends and partition overwrites work in place. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from calltide.functions.columns import all_of, any_null
from calltide.operators.merge import dedup_latest, sized, upsert
from calltide.sources.scratch import shared_dir
from calltide.sources.slices import preview

@dataclass(frozen=True)
class Layer:
    root: str
    name: str

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/{self.name}"

    @property
    def commits(self) -> str:
        return f"{self.path}/_commits"


def _files(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _commit_numbers(spark: SparkSession, layer: Layer) -> list[int]:
    fs, path = _files(spark, layer.commits)
    if not fs.exists(path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def _current(spark: SparkSession, layer: Layer) -> dict | None:
    numbers = _commit_numbers(spark, layer)
    if not numbers:
        return None
    fs, path = _files(spark, f"{layer.commits}/{numbers[-1]:08d}.json")
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {**json.loads(text), "number": numbers[-1]}


def _publish(spark: SparkSession, layer: Layer, folder: str, schema: T.StructType, partition_by: Sequence[str]) -> None:
    """Write the next commit record and make it visible by a rename."""
    number = (_commit_numbers(spark, layer) or [0])[-1] + 1
    record = {"folder": folder, "schema": _nullable(schema).jsonValue(), "partition_by": list(partition_by)}
    fs, draft = _files(spark, f"{layer.commits}/_draft-{number:08d}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(record), "utf-8"))
    finally:
        out.close()
    _, final = _files(spark, f"{layer.commits}/{number:08d}.json")
    if not fs.rename(draft, final):
        raise RuntimeError(f"another writer has published commit {number} of {layer.path}")


def _nullable(kind: T.DataType) -> T.DataType:
    """The type as Parquet gives it back, with NULL allowed everywhere."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    return kind


def _next_folder(spark: SparkSession, layer: Layer) -> str:
    return f"data-{(_commit_numbers(spark, layer) or [0])[-1] + 1:08d}"


def _write(df: DataFrame, path: str, partition_by: Sequence[str], mode: str, dynamic: bool = False) -> None:
    """Write with files of even size.

    Rows of one partition value are brought together, and Spark splits a value
    that is much larger than the others over several tasks (rebalance hint).
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_only_layer(spark: SparkSession, layer: Layer) -> bool:
    """Whether Bronze was laid out for appends, so that it may hold a key more than once."""
    current = _current(spark, layer)
    return current is not None and current["partition_by"] == ["ingestion_date"]


def layer_partitions(spark: SparkSession, layer: Layer) -> list[str]:
    """Columns the layer is partitioned by."""
    return _current(spark, layer)["partition_by"]


def layer_exists(spark: SparkSession, layer: Layer) -> bool:
    return bool(_commit_numbers(spark, layer))


def read_layer(spark: SparkSession, source: Layer | str) -> DataFrame:
    """Read a stored layer, a Parquet path, or a catalog table by its qualified name."""
    if isinstance(source, str):
        return spark.read.parquet(source) if "/" in source else spark.table(source)
    current = _current(spark, source)
    if current is None:
        raise FileNotFoundError(f"no layer at {source.path}")
    schema = T.StructType.fromJson(current["schema"])
    return spark.read.schema(schema).parquet(f"{source.path}/{current['folder']}").select(*schema.names)


def preview_layer(spark: SparkSession, layer: Layer, order_by: list, n: int = 5) -> DataFrame | None:
    """First rows of a layer in a stated order, or None when there is no such layer."""
    return preview(read_layer(spark, layer), order_by, n) if layer_exists(spark, layer) else None


def overwrite_layer(
    df: DataFrame, layer: Layer, partition_by: Sequence[str] = (), only_present: bool = False
) -> None:
    """Replace the layer and its schema.

    With ``only_present`` just the partitions that occur in ``df`` are
    replaced, in place; the schema must then match.
    """
    spark = df.sparkSession
    current = _current(spark, layer)
    if only_present and current is not None:
        columns = T.StructType.fromJson(current["schema"]).names
        _write(df.select(*columns), f"{layer.path}/{current['folder']}", current["partition_by"], "overwrite", True)
        return
    folder = _next_folder(spark, layer)
    _write(df, f"{layer.path}/{folder}", partition_by, "overwrite")
    _publish(spark, layer, folder, df.schema, partition_by)


def _widen(spark: SparkSession, layer: Layer, current: dict, arriving: T.StructType) -> None:
    """Publish new columns of arriving rows; files written before give NULL for them.

    Raises when a column arrives with another type than the stored one.
    """
    stored = T.StructType.fromJson(current["schema"])
    fields = _nullable(arriving).fields
    changed = [f.name for f in fields if f.name in stored.names and f.dataType != stored[f.name].dataType]
    if changed:
        raise ValueError(f"columns change type: {changed}")
    added = [f for f in fields if f.name not in stored.names]
    if added:
        _publish(spark, layer, current["folder"], T.StructType(stored.fields + added), current["partition_by"])


def append_layer(df: DataFrame, layer: Layer, partition_by: Sequence[str] = ()) -> None:
    """Add rows; new columns join the schema and are NULL on older rows."""
    spark = df.sparkSession
    current = _current(spark, layer)
    if current is None:
        overwrite_layer(df, layer, partition_by)
        return
    _widen(spark, layer, current, df.schema)
    _write(df, f"{layer.path}/{current['folder']}", current["partition_by"], "append")


def in_partitions(df: DataFrame, partitions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``df`` in the given partitions, NULL being a value too.

    A semi-join with one row per partition. When Spark broadcasts that side and
    it has a filter, only those partitions are read.
    """
    whole, partly = by_partitions(df, partitions, columns)
    return whole.unionByName(partly)


def by_partitions(df: DataFrame, partitions: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` in the given partitions, apart for values without and with NULL, since only plain equality prunes."""
    named = partitions.select(*[F.col(c).alias(f"__{c}") for c in columns])
    whole = df.join(named, all_of([df[c] == named[f"__{c}"] for c in columns]), "left_semi")
    missing = named.filter(any_null([f"__{c}" for c in columns]))
    partly = df.filter(any_null(columns))
    return whole, partly.join(missing, all_of([partly[c].eqNullSafe(missing[f"__{c}"]) for c in columns]), "left_semi")


def _touched_partitions(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], partition_by: Sequence[str], n: int
) -> DataFrame:
    """Partitions an upsert changes, with ``kind``: rewritten, or emptied when all their rows leave.

    The target's keys are searched for staged keys in other partitions. The
    search reads the key and partition columns within the staged key range, a
    scalar subquery that prunes row groups.
    """
    spark = target.sparkSession
    arriving = staged.select(*partition_by).distinct()
    staged_keys = staged.select(*keys).filter(~any_null(keys))
    low, high = [staged_keys.agg(*[f(k).alias(k) for k in keys]) for f in (F.min, F.max)]
    in_range = all_of([F.col(k).between(low.select(k).scalar(), high.select(k).scalar()) for k in keys])
    held = target.select(*dict.fromkeys([*partition_by, *keys])).filter(in_range)
    giving = held.join(sized(staged_keys, n), list(keys), "left_semi").groupBy(*partition_by).agg(F.count(F.lit(1)).alias("moved"))
    elsewhere = all_of([giving[c].eqNullSafe(arriving[c]) for c in partition_by])
    moved = parked(giving.join(arriving, elsewhere, "left_anti"), "moved")
    sizes = in_partitions(target.select(*partition_by), moved, partition_by).groupBy(*partition_by).count()
    same = all_of([moved[c].eqNullSafe(sizes[c]) for c in partition_by])
    emptied = F.when(F.col("count") == F.col("moved"), "emptied").otherwise("rewritten").alias("kind")
    left = moved.join(sizes, same).select(*[moved[c] for c in partition_by], emptied)
    return parked(arriving.withColumn("kind", F.lit("rewritten")).unionByName(left), "touched")


def parked(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def upsert_layer(
    staged: DataFrame,
    layer: Layer,
    keys: Sequence[str],
    latest_by: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    in_place: bool = True,
    check: Callable[[DataFrame], object] | None = None,
    null_keys: str = "insert",
    changes: Callable[[DataFrame | None, DataFrame], object] | None = None,
) -> None:
    """Upsert into a layer, created if missing.

    With ``in_place`` only partitions that receive rows or hold a replaced key
    are read and rewritten, whatever their number. Give ``latest_by`` (an empty
    list will do) unless the keys of the batch are unique. ``check`` sees the
    staged rows and may raise before the layer is touched. Running the same
    batch twice gives the same layer as far as rows have keys; rows with a NULL
    key are inserted again unless ``null_keys="once"``. ``changes`` gets the
    rows about to be replaced (None where there is no layer yet) and the staged
    rows, before the layer is touched.

    Partitions are swapped one by one when the write job commits. A driver lost
    at that moment can leave a partition unswapped or missing, and running the
    batch again does not bring back rows that were deleted: restore them from
    the source layer. Where that must not happen use ``in_place=False``: the
    whole layer is rewritten and published at once.
    """
    spark = staged.sparkSession
    fresh = dedup_latest(staged, keys, latest_by) if latest_by is not None else staged
    if check is None and changes is None and not layer_exists(spark, layer):
        overwrite_layer(fresh, layer, partition_by)
        return
    fresh = parked(fresh, "staged")
    if check:
        check(fresh)
    current = _current(spark, layer)
    if current is None:
        if changes:
            changes(None, fresh)
        overwrite_layer(fresh, layer, partition_by)
    elif n := fresh.count():  # from the files' footers
        _widen(spark, layer, current, fresh.schema)
        target, columns = read_layer(spark, layer), current["partition_by"]
        if in_place and columns and set(fresh.columns) == set(target.columns):
            touched = _touched_partitions(target, fresh, keys, columns, n)
            if changes:
                changes(_held(in_partitions(target, touched, columns), fresh, keys, n), fresh)
            rewritten = in_partitions(target, touched.filter("kind = 'rewritten'"), columns)
            emptied = folders_of(target, touched.filter("kind = 'emptied'"), columns)
            overwrite_layer(upsert(rewritten, fresh, keys, null_keys=null_keys, n=n), layer, only_present=True)
            drop_folders(emptied)
        else:
            if changes:
                changes(_held(target, fresh, keys, n), fresh)
            overwrite_layer(upsert(target, fresh, keys, null_keys=null_keys, n=n), layer, columns)


def _held(target: DataFrame, staged: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Target rows whose key is one of the ``n`` staged ones."""
    return target.join(sized(staged.select(*keys).distinct(), n), list(keys), "left_semi")


def folders_of(target: DataFrame, partitions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Folders of the given partitions: an overwrite in place cannot clear one that receives no row."""
    placed = target.select(*columns, F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder"))
    return parked(in_partitions(placed, partitions, columns).select("folder").distinct(), "emptied")


def files_of(target: DataFrame, partitions: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Paths of the files of the given partitions, stored. No column is read."""
    placed = target.select(*columns, F.col("_metadata.file_path").alias("file"))
    return parked(in_partitions(placed, partitions, columns).select("file").distinct(), label)


def drop_left(before: DataFrame, after: DataFrame) -> None:
    """Delete the folders of files that an overwrite of their partition left, as it can't clear one that receives no row."""
    left = before.join(after, "file", "left_semi").select(F.regexp_replace("file", "/[^/]*$", "").alias("folder")).distinct()
    drop_folders(parked(left, "emptied"))


def replace_partitions(df: DataFrame, layer: Layer, partitions: DataFrame) -> None:
    """Swap the given partitions of a layer for the rows of ``df``, which has no others; those without rows are cleared.

    ``partitions`` has the partition columns. Other partitions keep their
    files. ``df`` may read the layer itself, and is written once.
    """
    spark = df.sparkSession
    columns = _current(spark, layer)["partition_by"]
    touched = parked(partitions.select(*columns).distinct().withColumn("kind", F.lit("touched")), "touched").filter("kind = 'touched'")
    before = files_of(read_layer(spark, layer), touched, columns, "before")
    overwrite_layer(df, layer, only_present=True)
    drop_left(before, files_of(read_layer(spark, layer), touched, columns, "after"))


def delete_keys(
    gone: DataFrame,
    layer: Layer,
    keys: Sequence[str],
    changes: Callable[[DataFrame | None, DataFrame | None], object] | None = None,
) -> None:
    """Delete the rows whose key is in ``gone``; only partitions that hold one are rewritten.

    ``changes`` gets the rows about to be deleted, before the layer is touched.
    """
    spark = gone.sparkSession
    named = parked(gone.select(*keys).filter(~any_null(keys)).distinct(), "gone")
    n = named.count()
    named = sized(named, n)
    current = _current(spark, layer)
    target, columns = read_layer(spark, layer), current["partition_by"]
    if changes:
        changes(_held(target, named, keys, n), None)
    if not columns:
        overwrite_layer(target.join(named, list(keys), "left_anti").select(*target.columns), layer)
        return
    touched = target.select(*dict.fromkeys([*columns, *keys])).join(named, list(keys), "left_semi").select(*columns).distinct()
    touched = parked(touched.withColumn("kind", F.lit("rewritten")), "touched").filter("kind = 'rewritten'")
    left = in_partitions(target, touched, columns).join(named, list(keys), "left_anti").select(*target.columns)
    replace_partitions(left, layer, touched)


def drop_folders(folders: DataFrame) -> None:
    """Delete folders; their names come to the driver one part at a time."""
    spark = folders.sparkSession
    for row in folders.toLocalIterator():  # folder names
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row["folder"]))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_bronze(
    df: DataFrame,
    layer: Layer,
    key: str = "unique_key",
    latest_by: Sequence[str] = ("created_date",),
    append_only: bool = False,
    in_place: bool = True,
    check: Callable[[DataFrame], object] | None = None,
    precedence: str = "arrival",
) -> None:
    """Upsert when the rows carry the key, else append.

    An append-only layer is partitioned by load date. A merged one is
    partitioned by month of receipt, which later loads of a key do not change,
    and holds a key once even when the rows have no column to order them by.
    A merged layer takes the rows of the load that arrives last, or with
    ``precedence="load_date"`` those of the load with the latest date: arriving
    rows whose key is stored with a later date are then left out.
    """
    if append_only or key not in df.columns:
        if check:
            df = parked(df, "arrived")
            check(df)
        append_layer(df, layer, [c for c in ["ingestion_date"] if c in df.columns])
        return
    months = [c for c in ("received_year", "received_month") if c in df.columns]
    spark = df.sparkSession
    if precedence == "load_date" and "ingestion_date" in df.columns and layer_exists(spark, layer):
        df = parked(df, "arrived")
        low = df.agg(F.min("ingestion_date").alias("low")).select("low").scalar()
        stored = read_layer(spark, layer).select(F.col(key).alias("__key"), F.col("ingestion_date").alias("__date")).filter(F.col("__date") > low)
        df = df.join(sized(stored, stored.count()), (F.col(key) == F.col("__key")) & (F.col("__date") > F.col("ingestion_date")), "left_anti")
    upsert_layer(df, layer, [key], [c for c in latest_by if c in df.columns], months, in_place, check, "once")


def compact_layer(spark: SparkSession, layer: Layer, partitions: int | None = None) -> None:
    """Rewrite the layer into fewer, larger files in a new folder.

    ``partitions`` fixes the number of files of an unpartitioned layer;
    otherwise Spark sizes them.
    """
    current = _current(spark, layer)
    df = read_layer(spark, layer)
    if not current["partition_by"]:
        df = df.repartition(partitions) if partitions else df.hint("rebalance")
    overwrite_layer(df, layer, current["partition_by"])


def _drop(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _files(spark, path)
    fs.delete(hadoop_path, True)


def expire_folders(spark: SparkSession, layer: Layer) -> list[str]:
    """Delete data folders the newest commit no longer names; returns their names.

    Call it when no reader is left on an older version.
    """
    current = _current(spark, layer)
    fs, path = _files(spark, layer.path)
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    old = sorted(n for n in names if n.startswith("data-") and current and n != current["folder"])
    for name in old:
        _drop(spark, f"{layer.path}/{name}")
    return old
