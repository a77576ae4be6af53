"""Token counts by scanning flat token files for their end-of-document ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from calltide.llm.common import text_chunks
from calltide.llm.tokens import word_encoder

BLOCK_IDS = 1 << 18
BLOCK_SCHEMA = "file long, block int, width int, ids binary, docs array<long>"


def _flat(batches: Iterator[pa.RecordBatch], tokenizer_path: str, end_id: int, block_ids: int, schema: pa.Schema):
    from pyspark import TaskContext

    encoder = word_encoder(tokenizer_path)
    end = np.array([end_id], "<u4").tobytes()
    file = TaskContext.get().partitionId()
    width = 2 if max(end_id, encoder.tokenizer.get_vocab_size() - 1) < 1 << 16 else 4
    held, docs = bytearray(), []  # ids not yet written, and (place of its end, document)
    block = 0

    def cut(size: int) -> pa.RecordBatch:
        nonlocal held, docs, block
        ids = np.frombuffer(bytes(held[: 4 * size]), "<u4").astype(f"<u{width}").tobytes()
        own = [d for at, d in docs if at < size]
        row = {"file": file, "block": block, "width": width, "ids": ids, "docs": own}
        held, docs, block = held[4 * size :], [(at - size, d) for at, d in docs if at >= size], block + 1
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for batch, texts in text_chunks(batches, "text"):
        for doc, text in zip(batch.column(batch.schema.get_field_index("doc")).to_pylist(), texts):
            held += encoder.encode(text) + end
            docs.append((len(held) // 4 - 1, doc))
            while len(held) // 4 >= block_ids:
                yield cut(block_ids)
    if held:
        yield cut(len(held) // 4)


def write_flat(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    block_ids: int = BLOCK_IDS,
) -> None:
    """Write one flat stream of ids per task, each document closed by ``end_id``, cut into blocks of equal size.

    Blocks take no heed of documents: they may end inside one, and a long one fills several. There are no offsets; ``docs``
    only names the documents whose end is in a block. ``end_id`` must be outside the vocabulary. NULL texts are empty.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(BLOCK_SCHEMA)
    arrow = to_arrow_schema(schema)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    rows.mapInArrow(lambda b: _flat(b, tokenizer_path, end_id, block_ids, arrow), schema).write.option(
        "compression", "zstd"
    ).parquet(path)


def raw_blocks(spark: SparkSession, path: str, width: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of plain binary token files (ids of ``width`` bytes, nothing else; up to 2 GB a file), without documents."""
    size = block_ids * width
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    starts = F.sequence(F.lit(0), F.expr(f"int((length - 1) div {size})"))
    return files.select(F.xxhash64("path").alias("file"), "content", F.explode(starts).alias("block")).select(
        "file", "block", F.lit(width).alias("width"),
        F.expr(f"substring(content, block * {size} + 1, {size})").alias("ids"), F.expr("array()").cast("array<long>").alias("docs"),
    )


def scan(blocks: DataFrame, end_id: int) -> DataFrame:
    """Lengths of all documents in flat token files: ``file, document, doc_id, start, n_tokens, closed``.

    Each block is searched for ``end_id`` at once, whichever task has it. A prefix scan over the blocks of a file then
    gives the ids before each block and the last end before it, so that a document which began in an earlier block gets
    its whole length. ``document`` counts within the file, ``start`` in ids from the file's beginning, end ids included;
    ``n_tokens`` leaves the end id out. Ids after the last end are a document that is not closed, without a doc_id.
    """

    def search(batches):
        for batch in batches:
            r = batch.to_pydict()
            found = [np.frombuffer(x, f"<u{w}") for x, w in zip(r["ids"], r["width"])]
            yield pa.RecordBatch.from_pydict(
                {
                    "file": pa.array(r["file"], pa.int64()), "block": pa.array(r["block"], pa.int32()),
                    "n": pa.array([len(x) for x in found], pa.int64()),
                    "ends": pa.array([np.flatnonzero(x == end_id) for x in found], pa.list_(pa.int64())),
                    "docs": pa.array(r["docs"], pa.list_(pa.int64())),
                }
            )

    found = blocks.select("file", "block", "width", "ids", "docs").mapInArrow(
        search, "file long, block int, n long, ends array<long>, docs array<long>"
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        found.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("first", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)))
        .withColumn("end", F.when(F.size("ends") > 0, F.col("base") + F.element_at("ends", -1)))
        .withColumn("last", F.coalesce(F.max("end").over(before), F.lit(-1)))
        .withColumn("final", F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull())
    )
    reached = F.greatest("last", F.coalesce("end", F.lit(-1)))
    is_open = F.col("final") & (F.col("base") + F.col("n") - 1 > reached)
    stops = placed.withColumn("stops", F.when(is_open, F.concat("ends", F.array("n"))).otherwise(F.col("ends")))
    start = F.transform("stops", lambda e, i: F.when(i == 0, F.col("last") + 1).otherwise(F.col("base") + F.get("stops", i - 1) + 1))
    documents = stops.select("file", "first", "base", "docs", F.size("ends").alias("n_ends"), F.arrays_zip(start.alias("start"), F.col("stops").alias("stop")).alias("x"))
    i = F.col("i")
    return documents.select("file", "first", "base", "docs", "n_ends", F.posexplode("x").alias("i", "x")).select(
        "file", (F.col("first") + i).alias("document"), F.get("docs", i).alias("doc_id"), F.col("x.start").alias("start"),
        (F.col("base") + F.col("x.stop") - F.col("x.start")).alias("n_tokens"), (i < F.col("n_ends")).alias("closed"),
    )
