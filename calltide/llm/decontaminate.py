"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltide.llm.common import set_aside, staged, text_chunks

MIN_MATCH = 4  # tokens of the shortest tile, and of a seed
MIN_COVERAGE = 0.5
BLOCK_CHARS = 8_000_000  # benchmark text that is compared in one pass over the documents
START = 32  # first search length
_BASE = np.uint64(0x5851F42D4C957F2D)

tokens = re.compile(r"\w+").findall


def rolling(codes: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hash, modulo 2**64, of each window of ``n`` codes, from running sums of codes times powers of the base."""
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(codes) - n + 1, np.uint64)
    for k in range(n):
        out = out * _BASE + codes[k : len(codes) - n + 1 + k].astype(np.uint64)
    out ^= out >> np.uint64(32)  # the low bits of a product know little of the high ones
    return out * np.uint64(0x9E3779B97F4A7C15)


def _free_runs(marked: np.ndarray, n: int) -> np.ndarray:
    """Whether a window of ``n`` places that begins here has none marked."""
    if len(marked) < n:
        return np.zeros(0, bool)
    upto = np.concatenate([[0], np.cumsum(marked)])
    return upto[n:] == upto[:-n]


def _maximal(text: np.ndarray, item: np.ndarray, in_text: np.ndarray, in_item: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Runs of at least ``n`` equal unmarked tokens that cannot be extended, as (-length, place in text, place in item).

    Rolling hashes of free windows tell which places of the text to look at; from one of them to the next the length of each
    run is carried on along its diagonal.
    """
    free_item, free_text = _free_runs(in_item, n), _free_runs(in_text, n)
    wanted = np.unique(rolling(item, n)[free_item])
    at = np.flatnonzero(free_text & np.isin(rolling(text, n), wanted))
    if not len(at):
        return []
    # Places inside a window that matches, in order; a run ends wherever they leave a gap.
    near = np.unique(np.concatenate([at + k for k in range(n)]))
    out: list[tuple[int, int, int]] = []
    held, last = np.zeros(len(item) + 1, np.int64), -2
    usable = ~in_item

    def close(ended: np.ndarray, t: int) -> None:
        for p in np.flatnonzero(ended >= n).tolist():
            k = int(ended[p])
            out.append((-k, t - k, p - k))

    for t in near.tolist():
        if t != last + 1:
            close(held, last + 1)
            held = np.zeros(len(item) + 1, np.int64)
        now = np.zeros(len(item) + 1, np.int64)  # by the place behind the run in the item
        if not in_text[t]:
            now[1:] = np.where((item == text[t]) & usable, held[:-1] + 1, 0)
        ended = held.copy()
        ended[:-1][now[1:] > 0] = 0  # those go on
        close(ended, t)
        held, last = now, t
    close(held, last + 1)
    return out


def tile(text: list[int], item: list[int], min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Non-overlapping common runs as (place in text, place in item, length), longest first.

    Running Karp-Rabin: hashes of windows of a search length find maximal runs; the longest is marked, a run that a mark
    has cut counts with what is left of it, and when no run of the search length is left it is halved, down to
    ``min_match``. Of equally long runs the earlier in the text, then in the item, is marked.
    """
    text, item = np.asarray(text, np.int64), np.asarray(item, np.int64)
    in_text, in_item = np.zeros(len(text), bool), np.zeros(len(item), bool)
    tiles: list[tuple[int, int, int]] = []
    n = max(min_match, min(START, len(item), len(text)))
    while True:
        heap = _maximal(text, item, in_text, in_item, n)
        heapq.heapify(heap)
        while heap:
            k, t, p = heapq.heappop(heap)
            k = -k
            taken = in_text[t : t + k] | in_item[p : p + k]
            if not taken.any():
                in_text[t : t + k] = in_item[p : p + k] = True
                tiles.append((t, p, k))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[1], taken, [1]])))
            for first, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
                if end - first >= n:
                    heapq.heappush(heap, (first - end, t + first, p + first))
        if n == min_match or in_item.all():
            return tiles
        n = max(min_match, n // 2)


@dataclass
class Block:
    """Some benchmark items: their tokens as numbers, and the sorted hashes of their seeds with the items they occur in."""

    ids: list = field(default_factory=list)
    items: list[np.ndarray] = field(default_factory=list)
    codes: dict[str, int] = field(default_factory=dict)
    lengths: list[int] = field(default_factory=list)
    seeds: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    chars: int = 0

    def add(self, item_id, text: str, min_match: int) -> None:
        words = tokens(text.lower())
        if not words:
            return
        self.ids.append(item_id)
        self.items.append(np.array([self.codes.setdefault(w, len(self.codes) + 1) for w in words], np.int64))
        self.lengths.append(min(min_match, len(words)))
        self.chars += len(text)

    def closed(self) -> Block:
        """With the seeds of all items."""
        for n in set(self.lengths):
            own = [i for i, k in enumerate(self.lengths) if k == n]
            hashes = [np.unique(rolling(self.items[i], n)) for i in own]
            owner = np.repeat(np.array(own, np.int32), [len(h) for h in hashes])
            hashes = np.concatenate(hashes)
            order = np.argsort(hashes, kind="stable")
            self.seeds[n] = (hashes[order], owner[order])
        return self

    def matches(self, text: str | None, min_match: int, min_coverage: float) -> list[dict]:
        """Items whose coverage by tiles from ``text`` reaches the threshold."""
        words = tokens((text or "").lower())
        codes = np.fromiter((self.codes.get(w, 0) for w in words), np.int64, len(words))
        places: dict[int, list[np.ndarray]] = defaultdict(list)
        for n, (hashes, owner) in self.seeds.items():
            own = rolling(codes, n)
            known = np.flatnonzero(_free_runs(codes == 0, n))
            first, end = (np.searchsorted(hashes, own[known], side=side) for side in ("left", "right"))
            hit = np.flatnonzero(end > first)
            if not len(hit):
                continue
            times = (end - first)[hit]
            at = np.repeat(known[hit], times)
            which = owner[np.repeat(first[hit] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())]
            order = np.argsort(which, kind="stable")
            at, which = at[order], which[order]
            cuts = np.flatnonzero(np.diff(which, prepend=-1))
            for i, part in zip(which[cuts].tolist(), np.split(at, cuts[1:])):
                places[i].append(part)
        out = []
        for i, found in places.items():
            item = self.items[i]
            n = min(min_match, len(item))
            at = found[0]  # seeds of an item have one length
            # Tiles lie within runs of seed places; all other tokens can be left out, with a 0, which matches nothing, between runs.
            covered = np.zeros(len(codes) + 1, np.int64)
            np.add.at(covered, at, 1)
            np.add.at(covered, at + n, -1)
            inside = np.flatnonzero(np.cumsum(covered[:-1]) > 0)
            gaps = np.flatnonzero(np.diff(inside) > 1) + 1
            tiles = tile(np.insert(codes[inside], gaps, 0), item, n)
            share = sum(k for _, _, k in tiles) / len(item)
            if share >= min_coverage:
                out.append({"item_id": self.ids[i], "coverage": share, "n_tiles": len(tiles)})
        return sorted(out, key=lambda m: (-m["coverage"], m["item_id"] is None, m["item_id"] or 0))


def _blocks(benchmark: DataFrame, min_match: int, limit: int) -> Iterator[Block]:
    """Items in bounded blocks; the driver holds one at a time."""
    block = Block()
    for r in benchmark.toLocalIterator():
        block.add(r.item_id, r.text, min_match)
        if block.chars >= limit:
            yield block.closed()
            block = Block()
    yield block.closed()


MATCHES = "array<struct<item_id: bigint, coverage: double, n_tiles: int>>"


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    min_match: int = MIN_MATCH, min_coverage: float = MIN_COVERAGE, block_chars: int = BLOCK_CHARS, out: str = "matches",
) -> DataFrame:
    """Append ``matches``: the benchmark items of which a document holds at least ``min_coverage``, best first.

    Tokens are runs of letters, digits and underscores in lower case. Documents that share a seed of ``min_match`` tokens
    with an item (items shorter than that: all their tokens) are tiled with it; the coverage is the part of the item's
    tokens in tiles, in whatever order they stand. The benchmark is compared in blocks of bounded text, one pass over the
    documents each. NULL or empty texts and items match nothing; repeated rows agree; an empty benchmark gives empty lists.
    A column of ``docs`` that is called like ``out`` is returned with an underscore behind the name.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    items = benchmark.select(
        F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")
    ).where("text is not null")
    docs, (text_col,) = set_aside(docs, [out], text_col)
    context, names = docs.sparkSession.sparkContext, docs.columns
    schema = StructType([*docs.schema, *StructType.fromDDL(f"{out} {MATCHES}")])
    arrow = to_arrow_schema(schema)
    result = docs.withColumn(out, F.expr(f"cast(array() as {MATCHES})"))

    def one_pass(df: DataFrame, block: Block) -> DataFrame:
        held = context.broadcast(block)  # bounded by block_chars

        def run(batches):
            for part, texts in text_chunks(batches, text_col):
                old = part.column(part.schema.get_field_index(out)).to_pylist()
                new = [
                    sorted(
                        o + held.value.matches(t, min_match, min_coverage),
                        key=lambda m: (-m["coverage"], m["item_id"] is None, m["item_id"] or 0),
                    )
                    for o, t in zip(old, texts)
                ]
                columns = [part.column(part.schema.get_field_index(c)) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(new, arrow.field(out).type)], names=arrow.names)

        return df.mapInArrow(run, schema)

    for i, block in enumerate(_blocks(items, min_match, block_chars)):
        if i:
            result = staged(result, "decontaminate")
        result = one_pass(result, block)
    return result
