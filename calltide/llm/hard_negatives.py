"""Hard negatives for contrastive training: exact integer scores from subset-sum tables (the method of the Four Russians).

Vectors become integers. A row's integers are kept as bit planes: one byte for eight dimensions and one bit of their values.
For each anchor and eight dimensions a table holds the sums of all 256 subsets of the anchor's values, so that a byte is an
index into it. The score is built from the highest plane (the sign) to the lowest: double what there is, add the plane's
lookups. No product is ever formed, and the scores are exact.

Anchors are dealt into groups whose tables take a bounded amount of memory, the other rows into slices; a task holds one group
and streams one slice past it, keeping only the best rows of each anchor. So a hot label or a common vector makes no task
larger, and a task returns a bounded number of rows for each of its anchors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calltide.llm.common import staged, tasks

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOWER, UPPER = 30, 90  # percent of the positive's score
TABLE_BYTES = 64_000_000  # of the subset sums a task holds
SIDE, BATCH = 32, 2048  # anchors and rows scored at once
_LAST = np.iinfo(np.int64).max


def to_planes(values: np.ndarray, planes: int) -> np.ndarray:
    """Bytes ``[row, plane, group]`` of two's complement integers ``[row, 8 * groups]``, lowest plane first."""
    rows, dims = values.shape
    out = np.empty((rows, planes, dims // 8), np.uint8)
    for p in range(planes):
        bits = ((values >> p) & 1).astype(np.uint8).reshape(rows, dims // 8, 8)
        out[:, p] = np.packbits(bits, axis=2, bitorder="little")[:, :, 0]
    return out


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """Tables ``[group, byte, anchor]`` of the sums of the values ``[anchor, 8 * groups]`` whose bits are set in the byte."""
    groups = anchors.shape[1] // 8
    parts = anchors.T.reshape(groups, 8, len(anchors)).astype(kind)
    out = np.zeros((groups, 256, len(anchors)), kind)
    for k in range(8):
        out[:, 1 << k : 2 << k] = out[:, : 1 << k] + parts[:, k][:, None]
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products ``[row, anchor]`` by shifts and lookups; ``planes`` is ``[plane, group, row]``."""
    total = np.zeros((planes.shape[2], tables.shape[2]), tables.dtype)
    found = np.empty_like(total)
    for p in range(len(planes) - 1, -1, -1):
        total += total
        for table, own in zip(tables, planes[p]):
            np.take(table, own, axis=0, out=found, mode="clip")
            total += found
        if p == len(planes) - 1:  # the highest plane holds the sign
            np.negative(total, out=total)
    return total


class _Best:
    """The best rows of each slot: highest score, then smallest id (NULL last), then smallest row number."""

    def __init__(self, slots: int, most: int):
        self.most = most
        self.slot = self.score = self.id = self.row = np.zeros(0, np.int64)
        self.least = np.full(slots, np.iinfo(np.int64).min)
        self.last = np.full(slots, _LAST)

    def may_enter(self, score: np.ndarray, ids: np.ndarray, slots: slice) -> np.ndarray:
        """Whether rows (down) are at least as good as the worst held one of a full slot (across)."""
        least = self.least[slots]
        return (score > least) | ((score == least) & (ids[:, None] <= self.last[slots]))

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if not len(slot):
            return
        touched = np.isin(self.slot, slot)
        new = [np.concatenate([a[touched], b]) for a, b in ((self.slot, slot), (self.score, score), (self.id, ids), (self.row, rows))]
        order = np.lexsort((new[3], new[2], -new[1], new[0]))
        new = [a[order] for a in new]
        first = np.flatnonzero(np.concatenate([[True], new[0][1:] != new[0][:-1]]))
        place = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        new = [a[place < self.most] for a in new]
        full = np.flatnonzero(place[place < self.most] == self.most - 1)
        self.least[new[0][full]], self.last[new[0][full]] = new[1][full], new[2][full]
        self.slot, self.score, self.id, self.row = (
            np.concatenate([a[~touched], b]) for a, b in zip((self.slot, self.score, self.id, self.row), new)
        )


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Integer vectors as rows, those with fewer dimensions filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _packed(rows: DataFrame, planes: int, dims: int) -> DataFrame:
    """``row, id, label, bytes``: each row's bit planes as one binary value."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                made = to_planes(_matrix(b.column(3), dims), planes)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:3], pa.array([m.tobytes() for m in made], pa.binary())], names=["row", "id", "label", "bytes"]
                )

    return rows.select("row", "id", "label", "q").mapInArrow(run, "row long, id long, label long, bytes binary")


def _scored(
    batches: Iterator[pa.RecordBatch], planes: int, dims: int, kind: type, positives: int, most: int, percents: tuple[int, int] | None
):
    """Best rows of each anchor of a group in a slice. Rows come as ``group, slice, is_row, row, id, label, bytes, q, found``.

    Without ``percents`` those are its positives; with them its negatives, per positive in ``found`` (structs of a row, an
    id and a score, the best first).
    """
    width = 1 if percents is None else positives
    key, anchors, best, sides = None, [], None, []

    def opened() -> None:
        nonlocal best, sides
        best, sides = _Best(len(anchors) * width, most), []
        for at in range(0, len(anchors), SIDE):
            own = anchors[at : at + SIDE]
            low, high = np.full((len(own), width), 1), np.zeros((len(own), width), np.int64)  # an empty range
            for i, a in enumerate(own if percents else []):
                for j, f in enumerate(a["found"] or []):
                    low[i, j], high[i, j] = -(-percents[0] * f["score"] // 100), percents[1] * f["score"] // 100
            table = subset_sums(np.stack([a["q"] for a in own]), kind)
            sides.append((at, table, np.array([a["label"] for a in own]), np.array([a["row"] for a in own]), low, high))

    def closed():
        if best is not None and len(best.slot):
            number = np.array([a["row"] for a in anchors])
            yield pa.RecordBatch.from_pydict({
                "anchor": number[best.slot // width], "nth": (best.slot % width).astype(np.int32), "score": best.score,
                "id": pa.array(best.id, mask=best.id == _LAST), "row": best.row,
            })

    def meet(rows, ids, labels, bytes_) -> None:
        order = np.argsort(labels, kind="stable")
        rows, ids, labels, bytes_ = rows[order], ids[order], labels[order], bytes_[order]
        for at, table, label, number, low, high in sides:
            # Positives have the anchors' labels, which are neighbours in both orders.
            use = np.isin(labels, label) if percents is None else np.ones(len(labels), bool)
            if not use.any():
                continue
            r, i, lab = rows[use], ids[use], labels[use]
            s = scores(table, np.ascontiguousarray(bytes_[use].transpose(1, 2, 0)).astype(np.intp)).astype(np.int64)
            same = lab[:, None] == label
            for nth in range(width):
                slots = slice(at * width + nth, (at + len(label)) * width, width)
                ok = best.may_enter(s, i, slots)
                ok &= same & (r[:, None] != number) if percents is None else ~same & (s >= low[:, nth]) & (s <= high[:, nth])
                x, y = np.nonzero(ok)
                best.add((at + y) * width + nth, s[x, y], i[x], r[x])

    for b in batches:
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
        change = np.flatnonzero(np.any([np.diff(c.astype(np.int64)) != 0 for c in cols], axis=0)) + 1 if b.num_rows else []
        for first, end in zip([0, *change], [*change, b.num_rows]):
            part = b.slice(first, end - first)
            now = (cols[0][first], cols[1][first])
            if now != key:
                yield from closed()
                key, anchors, best = now, [], None
            if not cols[2][first]:
                found = part.column(8).to_pylist()
                for i, q in enumerate(_matrix(part.column(7), dims)):
                    anchors.append({"row": part.column(3)[i].as_py(), "label": part.column(5)[i].as_py(), "q": q, "found": found[i]})
                continue
            if not anchors:
                continue
            if best is None:
                anchors.sort(key=lambda a: (a["label"], a["row"]))
                opened()
            for at in range(0, part.num_rows, BATCH):
                p = part.slice(at, BATCH)
                raw = np.frombuffer(b"".join(p.column(6).to_pylist()), np.uint8).reshape(p.num_rows, planes, dims // 8)
                meet(p.column(3).to_numpy(), p.column(4).fill_null(_LAST).to_numpy(), p.column(5).to_numpy(), raw)
    yield from closed()


def _searched(packed: DataFrame, anchors: DataFrame, groups: int, slices: int, *how) -> DataFrame:
    """``anchor, nth, score, id, row``: for each anchor the best rows of every slice."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = packed.select(
        every(groups).alias("group"), F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int").alias("slice"), F.lit(1).alias("is_row"), "*"
    )
    dealt = anchors.select(
        F.pmod(F.xxhash64("row", F.lit(7)), F.lit(groups)).cast("int").alias("group"), every(slices).alias("slice"), F.lit(0).alias("is_row"), "*"
    )
    both = rows.unionByName(dealt, allowMissingColumns=True).select(
        "group", "slice", "is_row", "row", "id", "label", "bytes", "q", "found"
    )
    sent = both.repartition(tasks(packed), "group", "slice").sortWithinPartitions("group", "slice", "is_row")
    return sent.mapInArrow(lambda b: _scored(b, *how), "anchor long, nth int, score long, id long, row long")


def _first(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine_negatives(
    rows: DataFrame, id_col: str, label_col: str, vector_col: str, is_anchor: Column,
    positives: int = POSITIVES, negatives: int = NEGATIVES, percents: tuple[int, int] = (LOWER, UPPER), scale: int = SCALE,
) -> DataFrame:
    """For anchors and their nearest rows of the same label, the nearest rows of other labels inside a range of scores.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. Components become
    floor(scale * x); scores are integer inner products; higher ones come first, ties by id, NULL ids last. The positives of
    an anchor (a row for which ``is_anchor`` holds) are its first ``positives`` other rows of its label; the negatives of a
    positive its first ``negatives`` rows of other labels whose score is between ``percents`` of the positive's score.

    Rows with a NULL label or vector, or a component that is NULL, infinite or not a number, take no part. Missing dimensions
    of shorter vectors count as 0. Rows that repeat an id are rows of their own. Integers must fit a long, and so must the
    scores. An empty table, no anchors or labels without other rows give no rows. Other columns are ignored.
    """
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    clean = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.transform(v, lambda x: F.floor(x * scale)).alias("q"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        (F.col(vector_col).isNotNull() & ~bad).alias("fit"),
    ).where("fit and label is not null").drop("fit")
    clean = staged(clean.withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = clean.agg(
        F.max(F.size("q")).alias("dims"), F.max(F.array_max("q")).alias("high"), F.min(F.array_min("q")).alias("low"),
        F.count_if("is_anchor").alias("anchors"),
    ).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not size.anchors:
        return clean.sparkSession.createDataFrame([], schema)
    dims = max(8, -(-size.dims // 8) * 8)
    high, low = size.high or 0, size.low or 0
    planes = max(high.bit_length(), (~low).bit_length() if low < 0 else 0) + 1
    kind = np.int32 if dims * max(high, -low) ** 2 < 2**31 else np.int64
    groups = -(-size.anchors // max(1, TABLE_BYTES // (dims // 8 * 256 * np.dtype(kind).itemsize)))
    slices = max(1, -(-4 * tasks(clean) // groups))
    packed = staged(_packed(clean, planes, dims), "planes")
    how = (planes, dims, kind)
    anchors = clean.where("is_anchor").select("row", "id", "label", "q")
    near = "array<struct<row:long,id:long,score:long>>"
    alone = anchors.withColumn("found", F.lit(None).cast(near))
    found = staged(_first(_searched(packed, alone, groups, slices, *how, positives, positives, None), positives), "positives")
    by_anchor = found.groupBy("anchor").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "row", "id", "score"))), lambda x: F.struct(x.row, x.id, x.score)).cast(near).alias("found")
    )
    ready = anchors.join(by_anchor, F.col("row") == F.col("anchor")).drop("anchor")
    wrong = _first(_searched(packed, ready, groups, slices, *how, positives, negatives, percents), negatives)
    named = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    good = found.select("anchor", (F.col("rank") - 1).alias("nth"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        wrong.select("anchor", "nth", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(good, ["anchor", "nth"]).join(named, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
