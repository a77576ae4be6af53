"""Near-duplicate components with odd sketches: MinHash samples folded into parity bitmaps, then exact confirmation.

A text's MinHash samples each flip one bit of a bitmap. Equal samples of two texts flip the same bit and cancel out under XOR,
so the number of ones left grows with the number of samples that differ and estimates high similarities precisely. Texts meet
in bands of samples. No band's texts are paired with each other as rows:

1. Each text is compared with the first text of each of its bands; the one with the nearest sketch is confirmed on full sets.
2. Only bands whose texts are still in different components are looked at again. In each, a text's nearest sketch in another
   component is confirmed.
3. In bands that are mixed even then, all pairs of different components are compared by sketch, in blocks and at the first band
   that they share; texts with a near sketch are compared exactly, in blocks as well. Nothing that a band and a sketch allow
   is left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from calltide.llm.common import components, lower_ascii, staged, tasks, text_chunks
from calltide.llm.ngram_join import shingles

SHINGLE = 4
SIMILARITY = 0.8
ROWS, BANDS = 6, 42  # a pair at the threshold shares no band with probability (1 - 0.8**6)**42 = 3e-6
SAMPLES = ROWS * BANDS
BITS = 512
TOLERANCE = 1e-6  # probability that a pair at the threshold has more ones than are let pass
BLOCK = 512  # sketches on one side of a tile, on average
SET_BLOCK = 96  # sets on one side of a tile


@lru_cache(maxsize=1)
def _family() -> tuple[np.ndarray, ...]:
    rng = np.random.default_rng(13)
    odd = lambda n, kind: rng.integers(0, np.iinfo(kind).max, n, kind) | kind(1)
    return rng.integers(0, 1 << 32, SAMPLES, np.uint32), odd(SAMPLES, np.uint32), odd(SAMPLES, np.uint64), odd(ROWS, np.uint64)


def samples(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of a set of 64-bit hashes under each of ``SAMPLES`` functions."""
    flips, factors, _, _ = _family()
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 2048):
        np.minimum(low, ((short[at : at + 2048, None] ^ flips) * factors).min(0), out=low)
    return low


def odd_sketch(values: np.ndarray) -> np.ndarray:
    """Parity bitmap of samples, as bytes: each sample flips the bit that it and its position hash to."""
    mixed = (values.astype(np.uint64) + np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(1 << 32)) * _family()[2]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return np.packbits(np.bincount((mixed >> np.uint64(40)).astype(np.int64) % BITS, minlength=BITS).astype(np.uint8) & 1)


def band_keys(values: np.ndarray) -> np.ndarray:
    """A hash of each band of samples."""
    mixed = (values.reshape(BANDS, ROWS).astype(np.uint64) * _family()[3]).sum(1, dtype=np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + np.arange(BANDS, dtype=np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


@lru_cache(maxsize=8)
def most_ones(similarity: float = SIMILARITY, tolerance: float = TOLERANCE) -> int:
    """The number of ones that the XOR of two sketches exceeds with probability ``tolerance`` at most, at ``similarity``.

    Of the samples, Binomial(SAMPLES, 1 - similarity) differ; each of those flips two bits of the XOR, drawn at random.
    """
    ones, total = np.zeros(BITS + 1), np.zeros(BITS + 1)
    ones[0] = 1
    up = 1 - np.arange(BITS + 1) / BITS
    for differ in range(SAMPLES + 1):
        chance = math.exp(
            math.lgamma(SAMPLES + 1) - math.lgamma(differ + 1) - math.lgamma(SAMPLES - differ + 1)
            + differ * math.log(max(1 - similarity, 1e-12)) + (SAMPLES - differ) * math.log(similarity)
        )
        total += chance * ones
        for _ in range(2):
            moved = np.zeros_like(ones)
            moved[1:] += ones[:-1] * up[:-1]
            moved[:-1] += ones[1:] * (1 - up[1:])
            ones = moved
    return int(np.flatnonzero(np.cumsum(total[::-1])[::-1] <= tolerance)[0]) - 1


def estimate(ones: float) -> float:
    """Similarity at which ``ones`` is the expected number of ones in the XOR of two sketches."""
    return 1 + math.log(max(1 - 2 * ones / BITS, 1e-9)) / math.log(1 - 2 / BITS) / -2 / SAMPLES


def _signed(docs: DataFrame) -> DataFrame:
    rows = docs.withColumn("row", F.monotonically_increasing_id())

    def run(batches):
        for part, texts in text_chunks(batches, "text"):
            sizes, keys, sketches, bands = [], [], [], []
            for own in shingles([lower_ascii(t) if t else t for t in texts], SHINGLE):
                sizes.append(len(own))
                if not len(own):
                    keys.append(None), sketches.append(None), bands.append(None)
                    continue
                low = samples(own)
                keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                sketches.append(odd_sketch(low).tobytes())
                bands.append(band_keys(low))
            new = [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, "n", "key", "sketch", "bands"])

    more = StructType.fromDDL("n long, key binary, sketch binary, bands array<long>")
    return staged(rows.mapInArrow(run, StructType([*rows.schema, *more])), "sketches")


def _words(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, BITS // 64)


def _same_size(a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    return np.minimum(a, b) >= similarity * np.maximum(a, b) - 1e-9


def _near(pairs: DataFrame, signed: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose sketches allow the similarity, with the number of ones."""
    most = most_ones(similarity)

    def run(batches):
        for b in batches:
            if b.num_rows:
                ones = np.bitwise_count(_words(b.column(4)) ^ _words(b.column(5))).sum(1, dtype=np.int64)
                ok = (ones <= most) & _same_size(b.column(2).to_numpy(), b.column(3).to_numpy(), similarity)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ones)], names=["a", "b", "ones"]).filter(pa.array(ok))

    of = lambda x: signed.select(F.col("row").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")).hint("merge")
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long, ones long")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose full sets have the similarity."""

    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(shared >= similarity * (len(x) + len(y) - shared) - 1e-9)
            yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    of = lambda x: sets.select(F.col("row").alias(x), F.col("hashes").alias(f"h{x}")).hint("merge")
    return staged(pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "ha", "hb").mapInArrow(run, "a long, b long"), "links")


def _placed(entries: DataFrame, comps: DataFrame) -> DataFrame:
    """Entries ``band, row, comp`` of the bands whose texts are in several components."""
    own = entries.select("band", "row").join(comps.hint("merge"), F.col("row") == F.col("node"), "left")
    own = staged(own.select("band", "row", F.coalesce("component", "row").alias("comp")), "placed")
    mixed = own.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
    return staged(own.join(mixed.select(F.col("band").alias("key")).hint("merge"), F.col("band") == F.col("key")).drop("key"), "mixed")


def _tiles(entries: DataFrame, block: int) -> DataFrame:
    """Deal the texts ``band, row, comp`` of each band into blocks, and each block into the tiles ``lo, hi`` it belongs to.

    The texts of a band's largest component have blocks of their own, which meet the other blocks but not each other.
    """
    sizes = entries.groupBy("band", "comp").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("band").agg(F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("big"))
    blocks = lambda n: F.ceil(F.greatest(n, F.lit(0)) / block).cast("int")
    alone = F.col("n") <= block
    sizes = staged(
        sizes.select(
            F.col("band").alias("key"), F.col("big.comp").alias("big"),
            F.when(alone, 0).otherwise(blocks(F.col("big.n"))).alias("first"), F.when(alone, 1).otherwise(blocks(F.col("n") - F.col("big.n"))).alias("more"),
        ),
        "sizes",
    )
    is_big = (F.col("comp") == F.col("big")) & (F.col("first") > 0)
    at = F.when(is_big, F.pmod(F.xxhash64("row"), "first")).otherwise(F.col("first") + F.pmod(F.xxhash64("row"), "more")).cast("int")
    met = F.when(is_big, F.sequence("first", F.col("first") + F.col("more") - 1)).otherwise(F.sequence(F.lit(0), F.col("first") + F.col("more") - 1))
    return (
        entries.join(sizes.hint("merge"), F.col("band") == F.col("key")).withColumn("at", at)
        .select("band", "row", "comp", "at", F.explode(met).alias("other"))
        .select("band", F.least("at", "other").alias("lo"), F.greatest("at", "other").alias("hi"), (F.col("at") <= F.col("other")).alias("left"), "row", "comp")
    )


def _in_tiles(tiles: DataFrame, payload: DataFrame, columns: list[str], solve: Callable, schema: str, label: str) -> DataFrame:
    """Give each tile's rows with their payload to ``solve(band, left, right, same, columns)`` and stage what it returns."""
    key = ["band", "lo", "hi"]
    rows = tiles.join(payload.select(F.col("row").alias("node"), *columns).hint("merge"), F.col("row") == F.col("node"))
    dealt = rows.select(*key, "left", "row", "comp", *columns).repartition(tasks(tiles), *key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]):
        held: list[pa.RecordBatch] = []
        now = None

        def flush():
            if not held:
                return
            rows = pa.concat_batches(held)
            left = rows.column(3).to_numpy(zero_copy_only=False)
            same = now[1] == now[2]
            a = np.flatnonzero(left)
            b = a if same else np.flatnonzero(~left)
            if len(a) and len(b) and len(rows) > 1:
                found = solve(now[0], a, b, same, [rows.column(i) for i in range(4, rows.num_columns)])
                if found is not None:
                    yield found

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)])
            cuts = np.flatnonzero((np.diff(keys) != 0).any(0)) + 1
            for first, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                if tuple(keys[:, first]) != now:
                    yield from flush()
                    held, now = [], tuple(keys[:, first].tolist())
                held.append(batch.slice(first, end - first))
        yield from flush()

    return staged(dealt.mapInArrow(run, schema), label)


def _allowed(a: np.ndarray, b: np.ndarray, same: bool, comp: np.ndarray, n: np.ndarray, sketch: np.ndarray, similarity: float):
    """Slices of the left side, each with the ones of its pairs; pairs that can't be linked have more than all bits."""
    most = most_ones(similarity)
    for at in range(0, len(a), 64):
        x = a[at : at + 64]
        ones = np.bitwise_count(sketch[x][:, None] ^ sketch[b][None]).sum(2, dtype=np.int64)
        ok = (ones <= most) & (comp[x][:, None] != comp[b]) & _same_size(n[x][:, None], n[b], similarity)
        yield at, x, np.where(ok, ones, BITS + 1)


def _nearest(similarity: float) -> Callable:
    """For each text of a tile the nearest sketch in another component, as pairs ``a, b``."""

    def solve(band, a, b, same, columns):
        row, comp, n = (c.to_numpy() for c in columns[:3])
        sketch = _words(columns[3])
        other, least = np.full(len(row), -1), np.full(len(row), BITS + 1)
        for _, x, ones in _allowed(a, b, same, comp, n, sketch, similarity):
            for own, far, part in ((x, b, ones), (b, x, ones.T)):
                at = part.argmin(1)
                low = part[np.arange(len(own)), at]
                better = low < least[own]
                least[own[better]], other[own[better]] = low[better], far[at[better]]
        has = np.flatnonzero(other >= 0)
        x, y = row[has], row[other[has]]
        return pa.RecordBatch.from_pydict({"a": np.maximum(x, y), "b": np.minimum(x, y)}) if len(has) else None

    return solve


def _hopeful(similarity: float) -> Callable:
    """The texts of a tile that have a near sketch in another component and no earlier band in common with its text."""

    def solve(band, a, b, same, columns):
        row, comp, n = (c.to_numpy() for c in columns[:3])
        sketch, bands = _words(columns[3]), columns[4].flatten().to_numpy().reshape(-1, BANDS)
        found = np.zeros(len(row), bool)
        for _, x, ones in _allowed(a, b, same, comp, n, sketch, similarity):
            i, j = np.nonzero(ones <= BITS)
            i, j = x[i], b[j]
            for at in range(0, len(i), 4096):
                u, v = i[at : at + 4096], j[at : at + 4096]
                shared = bands[u] == bands[v]
                ok = bands[u, shared.argmax(1)] == band
                found[u[ok]] = found[v[ok]] = True
        if found.any():
            return pa.RecordBatch.from_pydict({"band": np.full(int(found.sum()), band), "row": row[found], "comp": comp[found]})

    return solve


def _linked(similarity: float) -> Callable:
    """Links between components inside a tile by exact comparison, as a forest ``a, b``."""

    def solve(band, a, b, same, columns):
        row, comp, n = (c.to_numpy() for c in columns[:3])
        sketch = _words(columns[3])
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in columns[4]]
        values, column = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), n)
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        shared = np.zeros((len(sets), len(sets)), np.float32)  # products of slices of the incidence matrix
        for first in range(0, len(values), 4096):
            cut = slice(*np.searchsorted(column, [first, first + 4096]))
            m = np.zeros((len(sets), 4096), np.float32)
            m[owner[cut], column[cut] - first] = 1
            shared += m @ m.T
        root = {c: c for c in comp.tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        out = []
        for _, x, ones in _allowed(a, b, same, comp, n, sketch, similarity):
            i, j = np.nonzero(ones <= BITS)
            i, j = x[i], b[j]
            both = shared[i, j].astype(np.int64)
            ok = both >= similarity * (n[i] + n[j] - both) - 1e-9
            for u, v in zip(i[ok].tolist(), j[ok].tolist()):
                p, q = find(int(comp[u])), find(int(comp[v]))
                if p != q:
                    root[p] = q
                    out.append((int(row[u]), int(row[v])))
        if out:
            return pa.RecordBatch.from_pydict(dict(zip("ab", map(list, zip(*out)))))

    return solve


def forest(links: DataFrame) -> DataFrame:
    """Components ``node, component`` of links ``a, b`` with b below a and each a at most once, by doubling the steps to the root."""
    now = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    while True:
        up = now.select(F.col("node").alias("at"), F.col("component").alias("further"))
        next_ = now.join(up.hint("merge"), F.col("component") == F.col("at"), "left")
        next_ = staged(next_.select("node", F.coalesce("further", "component").alias("component"), F.col("further").isNotNull().alias("moved")), "roots")
        now = next_.drop("moved")
        if next_.where("moved").isEmpty():
            break
    return now.unionByName(now.select(F.col("component").alias("node"), "component").distinct())


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """Components of near-equal texts: ``doc_id, n_shingles, component_id, kept``.

    Words are what stands between blanks and the control characters 9 to 13, with A to Z in lower case. A text's set has its
    windows of four words; a shorter text is one window. Texts are linked if their sets have a Jaccard similarity of at least
    ``similarity``. ``component_id`` is the smallest id of the texts that links connect, the text's own included, and ``kept``
    holds where it is the row's own. Texts with equal sets, copies among them, are handled once.

    NULL texts and texts without words have an empty set, no links and themselves as component. NULL ids rank last: a component
    of NULL ids alone has a NULL id, and its rows are kept. Rows that repeat an id are rows of their own. An empty table gives
    no rows. Other columns are ignored.

    A pair at the threshold is missed with a probability of 3e-6 by the bands and 1e-6 by the sketches.
    """
    signed = _signed(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    first = staged(signed.where("n > 0").groupBy("key").agg(F.min("row").alias("rep"), F.min("doc_id").alias("least")), "distinct")
    bands = (
        signed.where("n > 0").select("row", "bands").join(first.select("rep").hint("merge"), F.col("row") == F.col("rep"))
        .select("row", F.explode("bands").alias("band"))
    )
    shared = staged(
        bands.groupBy("band").agg(F.count("*").alias("texts"), F.min("row").alias("center")).where("texts > 1").select(F.col("band").alias("key"), "center"),
        "bands",
    )
    entries = staged(bands.join(shared.hint("merge"), F.col("band") == F.col("key")).select("band", "row", "center"), "entries")
    used = entries.select(F.col("row").alias("used")).distinct().hint("merge")

    def hashes(batches):
        for part, texts in text_chunks(batches, "text"):
            sets = shingles([lower_ascii(t) for t in texts], SHINGLE)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], names=["row", "hashes"])

    sets = staged(signed.select("row", "text").join(used, F.col("row") == F.col("used"), "left_semi").mapInArrow(hashes, "row long, hashes binary"), "sets")

    met = staged(entries.where("row <> center").select(F.col("row").alias("a"), F.col("center").alias("b")).distinct(), "met")
    chosen = _near(met, signed, similarity).groupBy("a").agg(F.min(F.struct("ones", "b")).alias("x")).select("a", "x.b")
    comps = staged(forest(_confirmed(chosen, sets, similarity)), "components")  # a band's first text has the smallest row number

    def joined(links: DataFrame) -> DataFrame:
        if links.isEmpty():
            return comps
        known = comps.select(F.col("node").alias("a"), F.col("component").alias("b"))
        return staged(components(known.unionByName(links)), "components")

    mixed = _placed(entries, comps)
    if not mixed.isEmpty():
        near = _in_tiles(_tiles(mixed, BLOCK), signed, ["n", "sketch"], _nearest(similarity), "a long, b long", "nearest")
        comps = joined(_confirmed(near.distinct(), sets, similarity))
        mixed = _placed(mixed, comps)
    if not mixed.isEmpty():
        hopeful = _in_tiles(_tiles(mixed, BLOCK), signed, ["n", "sketch", "bands"], _hopeful(similarity), "band long, row long, comp long", "hopeful")
        payload = signed.select("row", "n", "sketch").join(sets.hint("merge"), "row")
        links = _in_tiles(_tiles(hopeful.distinct(), SET_BLOCK), payload, ["n", "sketch", "hashes"], _linked(similarity), "a long, b long", "links")
        comps = joined(links)

    by_rep = first.join(comps.hint("merge"), F.col("rep") == F.col("node"), "left")
    least = staged(by_rep.where("component is not null").groupBy("component").agg(F.min("least").alias("smallest")), "names")
    by_key = staged(
        by_rep.join(least.hint("merge"), "component", "left")
        .select(F.col("key").alias("set"), F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("smallest")).alias("component_id")),
        "by-set",
    )
    rows = signed.select("doc_id", "n", "key").join(by_key.hint("merge"), F.col("key") == F.col("set"), "left")
    name = F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), name.alias("component_id"), F.col("doc_id").eqNullSafe(name).alias("kept")
    )
