"""Removal of long strings that also start earlier in the corpus, with run-length compressed indexes.

Every 100-byte string holds an anchor: of its 32-byte pieces the one with the smallest hash, the first of equals. Strings that
agree have the same anchor, so a document falls into segments of neighbouring strings with one anchor, and a match of 100
bytes lies within segments of equal anchors. Only anchors that occur with different segments need their bytes compared.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltide.llm.common import staged, tasks, text_chunks
from calltide.llm.run_index import RunIndex

LENGTH, PIECE = 100, 32
CHUNK = 1_000_000  # bytes handled at once
CUT = 4_000_000  # longer documents are searched in parts of so many bytes
HELD = 300_000  # segments a task gathers before it sends them on
GROUP = 16  # different segments of an anchor that are compared through an index
LARGE = 20_000  # more of them are compared string by string in one task, and beyond this number by counts over all tasks
INDEX_BYTES = 1_000_000  # text of one index
_PLACE = np.uint64((1 << 28) - 1)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
_NO_ID = np.iinfo(np.int64).min  # NULL ids come first

_FIELDS = (("a", "<u8"), ("x", "<u8"), ("id", "<i8"), ("row", "<i8"), ("p", "<i8"), ("back", "u1"), ("size", "u1"))


def _compress(raw: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def _decompress(packed: bytes, size: int) -> bytes:
    return pa.decompress(packed, size, codec="zstd", asbytes=True)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def piece_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each place on."""
    w = raw.astype(np.uint64)
    for shift in (1, 2, 4):
        w = w[:-shift] | (w[shift:] << np.uint64(8 * shift))
    n = len(raw) - PIECE + 1
    h = w[:n] * _ODD[0]
    for k in range(1, 4):
        h = _mixed(h) + w[8 * k : 8 * k + n] * _ODD[k]
    return _mixed(h)


def segments(parts: list[bytes]) -> dict[str, np.ndarray]:
    """Segments of the parts: which part, anchor hash and place, hash of the segment, its start and its size."""
    raw = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts], np.int64)
    counts = np.maximum(sizes - LENGTH + 1, 0)
    offsets = np.cumsum(sizes) - sizes
    total = int(counts.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return {"part": none, "a": none.astype(np.uint64), "x": none.astype(np.uint64), "p": none, "start": none, "size": none}
    h = piece_hashes(raw)
    low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    span, wide = LENGTH - PIECE + 1, 1
    m = low
    while 2 * wide <= span:
        m = np.minimum(m[: len(m) - wide], m[wide:])
        wide *= 2
    n = len(low) - span + 1
    m = np.minimum(m[:n], m[span - wide : span - wide + n])
    part = np.repeat(np.arange(len(parts)), counts)
    starts = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[part]
    anchor = (m[starts] & _PLACE).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
    last = np.concatenate([first[1:] - 1, [total - 1]])
    start, stop, p, part = starts[first], starts[last] + LENGTH, anchor[first], part[first]
    x = (stop - start).astype(np.uint64) * _ODD[1] + (p - start).astype(np.uint64)
    for k in range(6):
        x = _mixed(x) + h[np.minimum(start + PIECE * k, stop - PIECE)] * _ODD[k % 4]
    base = offsets[part]
    return {"part": part, "a": h[p], "x": _mixed(x), "p": p - base, "start": start - base, "size": stop - start}


def _texts(batches: Iterator[pa.RecordBatch], limit: int = CHUNK) -> Iterator[tuple[list[tuple], list[bytes]]]:
    """Rows of the stored texts without their last two columns, size and packed bytes, and the bytes, a bounded part at a time."""
    rows, raws, held = [], [], 0
    for batch in batches:
        for *row, size, packed in zip(*(c.to_pylist() for c in batch.columns)):
            rows.append(tuple(row))
            raws.append(_decompress(packed, size) if size else b"")
            held += size
            if held >= limit:
                yield rows, raws
                rows, raws, held = [], [], 0
    if rows:
        yield rows, raws


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """Parts of the documents as (document, offset, bytes); parts overlap by what a window needs."""
    for i, raw in enumerate(texts):
        for at in range(0, max(1, len(raw) - LENGTH + 1), CUT):
            if len(raw) - at >= LENGTH:
                yield i, at, raw[at : at + CUT + LENGTH - 1]


def _pack(columns: dict[str, np.ndarray], pick: np.ndarray) -> bytes:
    """Columns of some segments, those in order as differences, by byte plane and compressed."""
    parts = []
    for name, kind in _FIELDS:
        v = columns[name][pick].astype(kind)
        if name in ("id", "row", "p"):
            v = np.diff(v, prepend=v.dtype.type(0))
        parts.append(np.ascontiguousarray(v.view(np.uint8).reshape(len(v), -1).T).tobytes())
    raw = b"".join(parts)
    return len(raw).to_bytes(8, "little") + _compress(raw)


def _unpack(payloads: list[bytes]) -> dict[str, np.ndarray]:
    width = sum(np.dtype(kind).itemsize for _, kind in _FIELDS)
    out = {name: [] for name, _ in _FIELDS}
    for packed in payloads:
        raw = _decompress(packed[8:], int.from_bytes(packed[:8], "little"))
        n, at = len(raw) // width, 0
        for name, kind in _FIELDS:
            size = np.dtype(kind).itemsize
            v = np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(kind).ravel()
            out[name].append(np.cumsum(v, dtype=kind) if name in ("id", "row", "p") else v)
            at += n * size
    return {name: np.concatenate(v) if v else np.zeros(0, kind) for (name, kind), v in zip(_FIELDS, out.values())}


_MARKS = "row long, since long, until long, id long, a long, rank int, n int"


def _marks(columns: dict[str, np.ndarray], pick: np.ndarray, rank=None, n=None) -> pa.RecordBatch:
    start = columns["p"][pick] - columns["back"][pick].astype(np.int64)
    contested = rank is not None
    none = pa.nulls(len(pick), pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(columns["row"][pick], pa.int64()), pa.array(start), pa.array(start + columns["size"][pick].astype(np.int64)),
            pa.array(columns["id"][pick], pa.int64()) if contested else none,
            pa.array(columns["a"][pick].view(np.int64)) if contested else none,
            pa.array(rank, pa.int32()) if contested else pa.nulls(len(pick), pa.int32()),
            pa.array(n, pa.int32()) if contested else pa.nulls(len(pick), pa.int32()),
        ],
        names=["row", "since", "until", "id", "a", "rank", "n"],
    )


def _send(batches: Iterator[pa.RecordBatch], buckets: int):
    """Segments by anchor bucket; of equal ones a task holds at a time only the first, the others as marks at once."""
    held: list[dict[str, np.ndarray]] = []
    size = 0

    def flush():
        nonlocal held, size
        c = {name: np.concatenate([h[name] for h in held]) for name, _ in _FIELDS}
        held, size = [], 0
        place = np.lexsort((c["p"], c["row"], c["id"]))
        c = {k: v[place] for k, v in c.items()}
        order = np.lexsort((c["x"], c["a"]))
        a, x = c["a"][order], c["x"][order]
        first = order[np.concatenate([[True], (a[1:] != a[:-1]) | (x[1:] != x[:-1])])]
        first.sort()
        again = np.ones(len(a), bool)
        again[first] = False
        bucket = (c["a"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket[first], kind="stable")
        first = first[order]
        edges = np.searchsorted(bucket[first], np.arange(buckets + 1))
        for b in range(buckets):
            if edges[b] < edges[b + 1]:
                yield b, _pack(c, first[edges[b] : edges[b + 1]]), b""
        if again.any():
            yield int(c["row"][0] % buckets), b"", _pack(c, np.flatnonzero(again))

    def rows(items):
        got = list(items)
        yield pa.RecordBatch.from_arrays(
            [pa.array([g[0] for g in got], pa.int32()), pa.array([g[1] for g in got], pa.binary()), pa.array([g[2] for g in got], pa.binary())],
            names=["bucket", "segments", "again"],
        )

    def take(parts, ids, row_ids):
        nonlocal size
        own = segments([raw for _, _, raw in parts])
        doc = np.array([d for d, _, _ in parts], np.int64)[own["part"]]
        base = np.array([o for _, o, _ in parts], np.int64)[own["part"]]
        held.append(
            {
                "a": own["a"], "x": own["x"], "id": ids[doc], "row": row_ids[doc], "p": own["p"] + base,
                "back": own["p"] - own["start"], "size": own["size"],
            }
        )
        size += len(doc)

    for keys, texts in _texts(batches):
        ids = np.array([_NO_ID if doc is None else doc for _, doc in keys], np.int64)
        row_ids = np.array([row for row, _ in keys], np.int64)
        parts, n = [], 0
        for piece in _pieces(texts):
            parts.append(piece)
            n += len(piece[2])
            if n >= CUT:
                take(parts, ids, row_ids)
                parts, n = [], 0
        if parts:
            take(parts, ids, row_ids)
        if size >= HELD:
            yield from rows(flush())
    if size:
        yield from rows(flush())


def _meet(batches: Iterator[pa.RecordBatch]):
    """All segments of some anchors: marks those that equal an earlier one, and names those to compare."""
    payloads = []
    for batch in batches:
        for segs, again in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if segs:
                payloads.append(segs)
            if again:
                c = _unpack([again])
                yield _marks(c, np.arange(len(c["a"])))
    c = _unpack(payloads)
    order = np.argsort(c["a"], kind="stable")
    a = c["a"][order]
    if not len(a):
        return
    first = np.concatenate([[0], np.flatnonzero(a[1:] != a[:-1]) + 1])
    sizes = np.diff(np.concatenate([first, [len(a)]]))
    order = order[np.repeat(sizes > 1, sizes)]
    c = {k: v[order] for k, v in c.items()}
    if not len(order):
        return
    order = np.lexsort((c["p"], c["row"], c["id"], c["x"], c["a"]))
    c = {k: v[order] for k, v in c.items()}
    new = np.concatenate([[True], (c["a"][1:] != c["a"][:-1]) | (c["x"][1:] != c["x"][:-1])])
    yield _marks(c, np.flatnonzero(~new))
    c = {k: v[new] for k, v in c.items()}
    order = np.lexsort((c["p"], c["row"], c["id"], c["a"]))
    c = {k: v[order] for k, v in c.items()}
    first = np.concatenate([[0], np.flatnonzero(c["a"][1:] != c["a"][:-1]) + 1])
    sizes = np.diff(np.concatenate([first, [len(c["a"])]]))
    n = np.repeat(sizes, sizes)
    rank = np.arange(len(n)) - np.repeat(first, sizes)
    several = np.flatnonzero(n > 1)
    yield _marks(c, several, rank[several], n[several])


def merged(spans: list) -> list[list[int]]:
    """Overlapping and touching spans as one."""
    out: list[list[int]] = []
    for since, until in sorted(spans):
        if out and since <= out[-1][1]:
            out[-1][1] = max(out[-1][1], until)
        else:
            out.append([since, until])
    return out


def _without(raw: bytes, spans: list[list[int]]) -> bytes:
    at, kept = 0, []
    for since, until in spans:
        kept.append(raw[at:since])
        at = until
    kept.append(raw[at:])
    return b"".join(kept)


def _compare_groups(rows: list[tuple]) -> list[tuple[int, int, int]]:
    """Spans (row, since, until) of segments that earlier segments of the same anchor cover.

    ``rows`` are (anchor, rank, row, since, bytes) in order. The first segment of every anchor enters one index; all later
    ones are streamed against it and matches of 100 bytes marked. Then the next segment of each anchor takes its turn, until
    no anchor has two. A segment all of whose 100-byte strings were found needs no turn: each was found where it came from.
    """
    # To each segment the runs of its strings that were found, by their starts.
    groups = [[(*r, []) for r in own] for _, own in groupby(rows, key=lambda r: r[0])]
    groups = [g for g in groups if len(g) > 1]
    out = []
    while groups:
        index = RunIndex([g[0][4] for g in groups])
        later = [r for g in groups for r in g[1:]]
        found, sizes = index.matching_statistics([r[4] for r in later])
        width = found.shape[1]
        for k, at in zip(*np.nonzero(found >= LENGTH)):
            since = int(at) - (width - int(sizes[k]))
            later[k][5].append((since, since + int(found[k, at]) - LENGTH + 1))
        going = []
        for g in groups:
            left = []
            for r in g[1:]:
                r[5][:] = [tuple(x) for x in merged(r[5])]
                if r[5] != [(0, len(r[4]) - LENGTH + 1)]:
                    left.append(r)
                if r not in left[1:]:  # found whole, or the next to take its turn: nothing comes before it any more
                    out += [(r[2], r[3] + a, r[3] + b + LENGTH - 1) for a, b in r[5]]
            if len(left) > 1:
                going.append(left)
        groups = going
    return out


def _hashed_windows(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each 100-byte string of the segments, the segment it is from and its place there."""
    h = piece_hashes(np.frombuffer(b"".join(raws), np.uint8))
    sizes = np.array([len(r) for r in raws], np.int64)
    counts = sizes - LENGTH + 1
    k = np.repeat(np.arange(len(raws)), counts)
    own = np.arange(len(k)) - np.repeat(np.cumsum(counts) - counts, counts)
    i = own + (np.cumsum(sizes) - sizes)[k]
    w = [np.zeros(len(i), np.uint64), np.ones(len(i), np.uint64)]
    for n in range(2):
        for at, odd in zip((0, 32, 64, LENGTH - PIECE), _ODD):
            w[n] = _mixed(w[n] + np.uint64(n)) + h[i + at] * odd
    return w[0], w[1], k, own


def _compare_windows(rows: list[tuple]) -> list[tuple[int, int, int]]:
    """The same for one anchor, string by string."""
    w1, w2, k, own = _hashed_windows([r[4] for r in rows])
    order = np.lexsort((w2, w1))
    a, b = w1[order], w2[order]
    again = order[np.concatenate([[False], (a[1:] == a[:-1]) & (b[1:] == b[:-1])])]
    again.sort()
    if not len(again):
        return []
    since = np.array([r[3] for r in rows], np.int64)[k[again]] + own[again]
    new = np.concatenate([[True], (k[again][1:] != k[again][:-1]) | (since[1:] != since[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(again) - 1]])
    return [(rows[k[again[f]]][2], int(since[f]), int(since[t]) + LENGTH) for f, t in zip(first, last)]


def _near(batches: Iterator[pa.RecordBatch]):
    """Spans from segments that come by anchor, in order."""
    held: list[tuple] = []
    group: list[tuple] = []
    size = 0

    def spans(got):
        return pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], pa.int64()) for i in range(3)], names=["row", "since", "until"])

    def close():
        nonlocal held, group, size
        if len(group) > GROUP:
            yield spans(_compare_windows(group))
        else:
            held += group
            size += sum(len(r[4]) for r in group)
            if size >= INDEX_BYTES:
                yield spans(_compare_groups(held))
                held, size = [], 0
        group = []

    for batch in batches:
        for r in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if group and r[0] != group[-1][0]:
                yield from close()
            group.append(r)
    if group:
        yield from close()
    if held:
        yield spans(_compare_groups(held))


def _windows(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            ids, rows, since, raws = (batch.slice(at, 2048).column(i).to_pylist() for i in range(4))
            w1, w2, k, own = _hashed_windows(raws)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(np.array(ids, np.int64)[k]),
                    pa.array(np.array(rows, np.int64)[k]), pa.array(np.array(since, np.int64)[k] + own),
                ],
                names=["w1", "w2", "id", "row", "since"],
            )


def _cut(batches: Iterator[pa.RecordBatch]):
    """The bytes of the segments that have to be compared."""
    names = ["a", "rank", "n", "id", "row", "since"]
    for keys, texts in _texts(batches):
        out = [
            (m["a"], m["rank"], m["n"], m["id"], row, m["since"], raw[m["since"] : m["until"]])
            for (row, marks), raw in zip(keys, texts) for m in marks
        ]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=[*names, "bytes"]
        )


def _stored(rows: DataFrame, n: int) -> DataFrame:
    """A table of the packed texts in buckets by row: what is joined to it by row comes to it, the texts don't move again."""

    def pack(batches):
        for part, texts in text_chunks(batches, "text", CHUNK):
            raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
            packed = pa.array([_compress(r) if r else b"" for r in raws], pa.binary())
            sizes = pa.array([len(r) for r in raws], pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns[:3], sizes, packed], names=["row", "doc_id", "given", "size", "packed"])

    name = f"texts_{uuid.uuid4().hex}"
    packed = rows.mapInArrow(pack, "row long, doc_id long, given long, size long, packed binary")
    packed.repartition(n, "row").write.bucketBy(n, "row").format("parquet").saveAsTable(name)
    return rows.sparkSession.table(name)


def dedup_substrings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kept: str = "bytes", row_col: str | None = None
) -> DataFrame:
    """Remove each byte covered by a 100-byte string that also starts earlier: ``doc_id, n_bytes, n_removed, n_spans, kept``.

    Earlier means in a document with a smaller id (NULL first; rows of equal id in some fixed order) or earlier in the same
    one; matches may overlap themselves, never cross documents, and are judged on the input. ``kept`` is what remains, as
    bytes, or its SHA-256 with ``kept="sha256"``. NULL texts are empty.

    Segments are sent to tasks by anchor as packed arrays; of equal segments a task sends one. Where they meet, segments
    equal to an earlier one are marked whole. Those that differ under one anchor are compared by their bytes: up to ``GROUP``
    of them through run-length compressed indexes whose matching statistics mark long matches, more (an anchor in many
    contexts) string by string, beyond ``LARGE`` by counts with partial sums, so no anchor needs one task.
    """
    if kept not in ("bytes", "sha256"):
        raise ValueError(kept)
    given = F.col(row_col).cast("long") if row_col else F.lit(None).cast("long")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), given.alias("given"),
        F.col(text_col).cast("string").alias("text"),
    )
    n = tasks(docs)
    texts = _stored(rows, n)
    sent = texts.where(F.col("size") >= LENGTH).select("row", "doc_id", "size", "packed").mapInArrow(
        lambda b: _send(b, n), "bucket int, segments binary, again binary"
    )
    marks = staged(sent.repartition(n, "bucket").mapInArrow(_meet, _MARKS), "marks")
    contested = marks.where("a is not null").groupBy(F.col("row").alias("r")).agg(
        F.collect_list(F.struct("since", "until", "id", "a", "rank", "n")).alias("marks")
    )
    compare = staged(
        texts.join(contested, F.col("row") == F.col("r")).select("row", "marks", "size", "packed")
        .mapInArrow(_cut, "a long, rank int, n int, id long, row long, since long, bytes binary"),
        "segments",
    )
    near = (
        compare.where(F.col("n") <= LARGE).select("a", "rank", "row", "since", "bytes")
        .repartition(n, "a").sortWithinPartitions("a", "rank")
        .mapInArrow(_near, "row long, since long, until long")
    )
    windows = compare.where(F.col("n") > LARGE).select("id", "row", "since", "bytes").mapInArrow(
        _windows, "w1 long, w2 long, id long, row long, since long"
    )
    repeated = staged(
        windows.groupBy("w1", "w2").agg(F.count("*").alias("times"), F.min(F.struct("id", "row", "since")).alias("first"))
        .where("times > 1").select(F.col("w1").alias("r1"), F.col("w2").alias("r2"), "first"),
        "windows",
    )
    far = windows.join(repeated, (F.col("w1") == F.col("r1")) & (F.col("w2") == F.col("r2"))).where(
        (F.col("row") != F.col("first.row")) | (F.col("since") != F.col("first.since"))
    ).select("row", "since", (F.col("since") + LENGTH).alias("until"))
    spans = marks.where("a is null").select("row", "since", "until").unionByName(near).unionByName(far)
    by_row = spans.groupBy(F.col("row").alias("r")).agg(F.collect_list(F.struct("since", "until")).alias("spans"))
    whole = kept == "bytes"

    def last(batches):
        names = ["doc_id", "given", "n_bytes", "n_removed", "n_spans", "kept"]
        for keys, raws in _texts(batches):
            out = []
            for (doc, gave, found), raw in zip(keys, raws):
                own = merged([(s["since"], s["until"]) for s in found or []])
                left = _without(raw, own)
                out.append((doc, gave, len(raw), sum(b - a for a, b in own), len(own), left if whole else hashlib.sha256(left).digest()))
            kinds = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=names)

    out = texts.join(by_row, F.col("row") == F.col("r"), "left").select("doc_id", "given", "spans", "size", "packed").mapInArrow(
        last, "doc_id long, given long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept", *([F.col("given").alias(row_col)] if row_col else []))
