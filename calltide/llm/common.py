"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calltide.sources.scratch import shared_dir

WORD = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 500_000  # text handled at once inside a task


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    path = shared_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def set_aside(df: DataFrame, names: Iterable[str], *used: str) -> tuple[DataFrame, list[str]]:
    """Rename columns that are called like one of ``names``, in any case, to the name and an underscore or more.

    Returns the frame and the names that the ``used`` columns have now.
    """
    reserved = {n.lower() for n in names}
    now = {}
    for c in df.columns:
        if c.lower() in reserved:
            now[c] = fresh(df, c)
            df = df.withColumnRenamed(c, now[c])
    return df, [now.get(u, u) for u in used]


def with_row_id(df: DataFrame, label: str, name: str) -> DataFrame:
    """Stage ``df`` with a unique long per row, which later reads then share."""
    return staged(df.withColumn(name, F.monotonically_increasing_id()), label)


def tasks(df: DataFrame) -> int:
    """Number of shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def keyed_hash(*columns: Column, seed: int = 0) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def text_chunks(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of the batches with a bounded amount of text (or a single row), and their texts."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        upto = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            held = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, held + limit, side="right")))
            yield batch.slice(at, end - at), column.slice(at, end - at).to_pylist()
            at = end


def lower_ascii(text: str) -> str:
    """The text with A to Z in lower case and all else as it is."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def map_texts(
    df: DataFrame, text: str, fn: Callable[[list[str | None]], dict[str, list | np.ndarray | pa.Array]], schema: str,
    keep_text: bool = False,
) -> DataFrame:
    """Append columns computed from bounded slices of the texts; the text itself is returned only when asked for."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    keep = [c for c in df.columns if keep_text or c != text]
    new = StructType.fromDDL(schema)
    out = StructType([*(df.schema[c] for c in keep), *new])
    arrow = to_arrow_schema(out)

    def run(batches):
        for part, texts in text_chunks(batches, text):
            made = fn(texts)
            columns = [part.column(part.schema.get_field_index(c)) for c in keep]
            for f in new:
                v = made[f.name]
                kind = arrow.field(f.name).type
                columns.append(v if isinstance(v, pa.Array) else pa.array(v, type=kind))
            yield pa.RecordBatch.from_arrays(columns, names=arrow.names)

    return df.mapInArrow(run, out)


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Connected components of ``edges(a long, b long)``: ``(node, component)``, named by the smallest node.

    Alternates large-star and small-star steps. Each step groups the neighbours of a node by their minimum only, so
    no node gathers its neighbours in one row; the number of rounds grows with the logarithm of the longest path.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def minima(e: DataFrame) -> DataFrame:
        return e.groupBy(F.col("a").alias("v")).agg(F.min(F.least("a", "b")).alias("m"))

    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(max_rounds):
        full = both(edges)
        # As tables of their own, so that adaptive execution can split the rows of a node that many others touch.
        least = staged(minima(full), "minima")
        # Large star: larger neighbours of a node are linked to the smallest one around it.
        large = (
            full.where("b > a").join(least, F.col("a") == F.col("v"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        down = staged(large.where("a > b"), "edges")
        low = staged(down.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")), "minima")
        small = down.join(low, F.col("a") == F.col("v"))
        new = (
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select(F.col("v").alias("a"), F.col("m").alias("b")))
            .where("a <> b").distinct()
        )
        new = staged(new, "edges")
        before, after = (
            e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
            for e in (edges, new)
        )
        edges = new
        if before == after:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
