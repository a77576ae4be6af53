"""Token-ID files: one concatenated id array per shard with Elias-Fano encoded document boundaries."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from calltide.llm.common import tasks, text_chunks
from calltide.llm.tokens import word_encoder

SHARD_IDS = 1 << 20  # a shard is closed by the document that reaches this many ids
SELECT_STEP = 64  # one sampled position for so many set bits


class EliasFano:
    """A rising sequence of n values up to m in about n * (2 + log2(m / n)) bits.

    The low bits of each value are stored as they are, the high bits as a unary bit string. ``samples`` holds, in 32 bits,
    the place of every 64th set bit of that string, so ``select`` reads a few bytes from there on.
    """

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits = n, low_bits
        self.low, self.high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.int64)
        n = len(v)
        if n and (v[0] < 0 or (np.diff(v) < 0).any()):
            raise ValueError("values must rise and be at least 0")
        top = int(v[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = np.packbits((v[:, None] >> np.arange(bits)) & 1, bitorder="little") if bits else np.empty(0, np.uint8)
        ones = (v >> bits) + np.arange(n)
        unary = np.zeros((top >> bits) + n, np.uint8)
        unary[ones] = 1
        return cls(
            n, bits, low.tobytes(), np.packbits(unary, bitorder="little").tobytes(),
            ones[::SELECT_STEP].astype("<u4").tobytes(),
        )

    def stored(self) -> dict:
        """The parts as a row keeps them."""
        return {"n": self.n, "low_bits": self.low_bits, "low": self.low.tobytes(), "high": self.high.tobytes(), "samples": self.samples.tobytes()}

    def _low(self, first: int, last: int) -> np.ndarray:
        k = self.low_bits
        if not k:
            return np.zeros(last - first, np.int64)
        at, end = first * k, last * k
        bits = np.unpackbits(self.low[at >> 3 : (end + 7) >> 3], bitorder="little")[at & 7 :][: end - at]
        return bits.reshape(-1, k).astype(np.int64) @ (1 << np.arange(k, dtype=np.int64))

    def values(self) -> np.ndarray:
        """All values at once."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        return ((ones - np.arange(self.n)) << self.low_bits) + self._low(0, self.n)

    def select(self, i: int) -> int:
        """The i-th value, counted from 0."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        sample = i // SELECT_STEP
        first = int(self.samples[sample]) >> 3
        last = (int(self.samples[sample + 1]) >> 3) + 1 if sample + 1 < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[first:last], bitorder="little")) + 8 * first
        ones = ones[ones >= self.samples[sample]]
        return ((int(ones[i % SELECT_STEP]) - i) << self.low_bits) + int(self._low(i, i + 1)[0])


def _shards(batches: Iterator[pa.RecordBatch], encoder_path: str, end_id: int, limit: int, schema: pa.Schema):
    from pyspark import TaskContext

    encoder = word_encoder(encoder_path)
    end = np.array([end_id], "<u4").tobytes()
    part = TaskContext.get().partitionId()
    ids: list[bytes] = []
    docs: list[int | None] = []
    size, seq, before = 0, 0, 0

    def shard() -> pa.RecordBatch:
        lengths = np.array([len(x) // 4 for x in ids], np.int64)
        ends = EliasFano.encode(np.cumsum(lengths))
        flat = np.frombuffer(b"".join(ids), "<u4")
        width = 2 if flat.max() < 1 << 16 else 4
        known = np.array([d for d in docs if d is not None], np.int64)  # NULL ids come first
        first = int(known[0]) if len(known) else 0
        row = {
            "part": part, "seq": seq, "before": before, "n_ids": len(flat), "width": width, "ids": flat.astype(f"<u{width}").tobytes(),
            "ends": ends.stored(), "no_id": len(docs) - len(known), "first_id": first, "doc_ids": EliasFano.encode(known - first).stored(),
        }
        return pa.RecordBatch.from_pylist([row], schema=schema)

    low = None  # the first id of the shard
    for batch, texts in text_chunks(batches, "text"):
        for doc, text in zip(batch.column(batch.schema.get_field_index("doc")).to_pylist(), texts):
            if ids and low is not None and doc - low >= 1 << 62:  # differences must fit
                yield shard()
                ids, docs, size, seq, before, low = [], [], 0, seq + 1, before + size, None
            low = doc if low is None else low
            ids.append(encoder.encode(text) + end)
            docs.append(doc)
            size += len(ids[-1]) // 4
            if size >= limit:
                yield shard()
                ids, docs, size, seq, before, low = [], [], 0, seq + 1, before + size, None
    if ids:
        yield shard()


_STORED = "struct<n: int, low_bits: int, low: binary, high: binary, samples: binary>"
SHARD_SCHEMA = (
    f"part int, seq int, before long, n_ids long, width int, ids binary, ends {_STORED}, no_id int, first_id long, doc_ids {_STORED}"
)


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
    shard_ids: int = SHARD_IDS, partitions: int | None = None,
) -> None:
    """Encode all texts in ascending id order and write them as rows of id arrays with Elias-Fano boundaries.

    A row holds the ids of consecutive documents, each closed by ``end_id``, in 2 bytes an id where they fit, else 4. Where they
    end, and the documents' rising ids, are Elias-Fano encoded, so a document costs a few bits. It is
    closed by the document that reaches ``shard_ids``, so its size is bounded by that and the longest document. NULL texts
    are empty documents, NULL ids come first, and rows with equal ids keep some fixed order; as ranges also count the row,
    an id that holds much of the table is spread over tasks. An empty table gives empty files.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(SHARD_SCHEMA)
    arrow = to_arrow_schema(schema)
    n = partitions or 4 * tasks(docs)
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(n, "doc", "row")
        .sortWithinPartitions("doc", "row")
        .drop("row")
    )
    ordered.mapInArrow(lambda b: _shards(b, tokenizer_path, end_id, shard_ids, arrow), schema).write.option(
        "compression", "zstd"
    ).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Shards with ``base``: the number of ids in all shards before.

    Shards know what precedes them in their range; the sums of the ranges, one row each, are added up in one task and sent
    to all. There are as many ranges as partitions were asked for, so that table is bounded.
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")
    )
    return shards.join(F.broadcast(ranges), "part").withColumn("base", F.col("start") + F.col("before")).drop("start")


def document_index(shards: DataFrame) -> DataFrame:
    """One row per document of ``read_token_files``: its id, start, number of ids and crc32 of the ids as uint32."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                selected = EliasFano(**r["ends"])
                ends = np.array([selected.select(i) for i in range(selected.n)], np.int64)
                named = EliasFano(**r["doc_ids"])
                ids = [None] * r["no_id"] + [r["first_id"] + named.select(i) for i in range(named.n)]
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                raw = np.frombuffer(r["ids"], f"<u{r['width']}").astype("<u4").tobytes()
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(ids, pa.int64()), "start": starts + r["base"],
                        "n_tokens": ends - starts, "ids_crc32": pa.array(sums, pa.int64()),
                    }
                )

    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
