"""Near-duplicate classes by Jaccard similarity of word n-grams, with Bayesian pruning of candidates."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from calltide.llm.common import components, staged, text_chunks
from calltide.llm.quality import words_of

SHINGLE = 5
SIMILARITY = 0.8
ROWS, BANDS = 6, 42  # a pair at the threshold shares no band with probability (1 - 0.8**6)**42 = 3e-6
HASHES = ROWS * BANDS
STEP = 28  # MinHash values compared at once
TOLERANCE = 1e-6  # a pair is dropped when it reaches the threshold with less than this posterior probability
LINKING = 0.4  # agreement of MinHash values below which a band in common doesn't put texts into one component
BLOCK = 128  # texts of a component on one side of a tile, on average
_ODD = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    base, out = 0x5851F42D4C957F2D, []
    for b in (base, pow(base, -1, 1 << 64)):
        x = np.full(n, b, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(_ODD)
    return h ^ (h >> np.uint64(32))


def shingles(texts: list[str | None], n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the windows of ``n`` words of each text; a shorter text is one window."""
    joined = [" ".join(words_of(t or "")) for t in texts]
    raw = np.frombuffer(("\n".join(joined) + "\n").encode("utf-8", "surrogatepass"), np.uint8)
    up, down = _powers(1 << max(16, (len(raw) + 1).bit_length()))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    ends = np.flatnonzero((raw == 32) | (raw == 10))  # of words; an empty text has an empty word
    begins = np.concatenate([[0], ends[:-1] + 1])
    counts = np.array([t.count(" ") + 1 for t in joined], np.int64)
    firsts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    out = []
    for text, first, count in zip(joined, firsts.tolist(), counts.tolist()):
        if not text:
            out.append(np.zeros(0, np.uint64))
            continue
        width = min(n, count)
        a = begins[first : first + count - width + 1]
        b = ends[first + width - 1 : first + count]
        out.append(np.unique(_mixed((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))))
    return out


@lru_cache(maxsize=1)
def _family() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    flips = rng.integers(0, 1 << 32, HASHES, np.uint32)
    factors = rng.integers(0, 1 << 31, HASHES, np.uint32) * np.uint32(2) + np.uint32(1)
    places = rng.integers(1, 1 << 62, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
    return flips, factors, places


def signature(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """MinHash values cut to 16 bits, and a hash of each band of the uncut values."""
    flips, factors, places = _family()
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 2048):
        np.minimum(low, ((short[at : at + 2048, None] ^ flips) * factors).min(0), out=low)
    bands = _mixed((low.reshape(BANDS, ROWS).astype(np.uint64) * places).sum(1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * np.uint64(_ODD))
    return ((low * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16), bands.view(np.int64)


@lru_cache(maxsize=8)
def least_matches(similarity: float = SIMILARITY, tolerance: float = TOLERANCE) -> list[int]:
    """For each number of compared values (a multiple of ``STEP``) the matches below which a pair is dropped.

    With a uniform prior the similarity after x matches of m is Beta(x + 1, m - x + 1), and it reaches the threshold t with
    the probability that a Binomial(m + 1, t) variable is at most x.
    """
    out = []
    for m in range(STEP, HASHES + 1, STEP):
        total, x = 0.0, 0
        while True:
            total += math.comb(m + 1, x) * similarity**x * (1 - similarity) ** (m + 1 - x)
            if total >= tolerance:
                break
            x += 1
        out.append(x)
    return out


def linked_pairs(
    sigs: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: float = SIMILARITY
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (one of ``left``, one of ``right``; once if both are the same) whose exact similarity reaches the threshold."""
    size = np.array([len(s) for s in sets], np.int64)
    same = left is right
    a, b = size[left][:, None], size[right][None, :]
    near = np.minimum(a, b) >= similarity * np.maximum(a, b) - 1e-9
    if same:
        near &= np.arange(len(left))[:, None] < np.arange(len(right))[None, :]
    i, j = np.nonzero(near)
    i, j = left[i], right[j]
    hits = np.zeros(len(i), np.int64)
    for k, least in enumerate(least_matches(similarity)):
        cut = slice(k * STEP, (k + 1) * STEP)
        own = sigs[:, cut]
        for at in range(0, len(i), 65536):
            s = slice(at, at + 65536)
            hits[s] += (own[i[s]] == own[j[s]]).sum(1)
        alive = hits >= least
        i, j, hits = i[alive], j[alive], hits[alive]
    if not len(i):
        return i, j
    if len(i) <= 200:
        shared = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i, j)], np.int64)
    else:
        shared = _shared(sets, i, j)
    union = size[i] + size[j] - shared
    true = shared >= similarity * union - 1e-9
    return i[true], j[true]


def _shared(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of many pairs of the same few sets, by products of incidence matrices."""
    used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    x, y = at[: len(i)], at[len(i) :]
    owner = np.repeat(np.arange(len(used)), [len(sets[u]) for u in used])
    values, column = np.unique(np.concatenate([sets[u] for u in used]), return_inverse=True)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(used), len(used)), np.float32)
    for first in range(0, len(values), 4096):
        a, b = np.searchsorted(column, [first, first + 4096])
        m = np.zeros((len(used), 4096), np.float32)
        m[owner[a:b], column[a:b] - first] = 1
        out += m @ m.T
    return np.rint(out[x, y]).astype(np.int64)


def _signed(docs: DataFrame, label: str) -> DataFrame:
    """Stage each row with a row id, two hashes of its text, the number of its shingles, its signature and bands."""
    rows = docs.withColumns(
        {"row": F.monotonically_increasing_id(), "k1": F.xxhash64(F.lit(1), "text"), "k2": F.xxhash64(F.lit(2), "text")}
    )

    def run(batches):
        for part, texts in text_chunks(batches, "text"):
            sizes, sigs, bands = [], [], []
            for own in shingles(texts):
                sizes.append(len(own))
                sig, band = signature(own) if len(own) else (np.zeros(0, np.uint16), np.zeros(0, np.int64))
                sigs.append(sig.tobytes())
                bands.append(band)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(sizes, pa.int32()), pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=[*part.schema.names, "n", "sig", "bands"],
            )

    more = StructType.fromDDL("n int, sig binary, bands array<long>")
    return staged(rows.mapInArrow(run, StructType([*rows.schema, *more])), label)


def _agree(edges: DataFrame) -> DataFrame:
    """Edges whose ends agree in enough MinHash values."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, HASHES) for c in (2, 3)
            )
            yield batch.filter(pa.array((x == y).mean(1) >= LINKING)).select([0, 1])

    return edges.select("a", "b", "siga", "sigb").mapInArrow(run, "a long, b long")


_TILE = ["comp", "la", "ja", "lb", "jb"]


def _tile_links(batches: Iterator[pa.RecordBatch], similarity: float):
    """Links inside each tile; rows come sorted by tile. Yields a row per linked text: its links there and its group."""
    held: list[tuple] = []
    key = None

    def solve():
        sigs = np.frombuffer(b"".join(r[2] for r in held), np.uint16).reshape(-1, HASHES)
        sets = [np.frombuffer(r[3], np.uint64) for r in held]
        ids = np.array([r[0] for r in held], np.int64)
        first = np.array([r[1] for r in held], bool)
        left = np.flatnonzero(first)
        right = left if key[1:3] == key[3:5] else np.flatnonzero(~first)
        i, j = linked_pairs(sigs, sets, left, right, similarity)
        links = np.bincount(np.concatenate([i, j]), minlength=len(ids)) if len(i) else np.zeros(len(ids), np.int64)
        root = ids.copy()
        while len(i):  # spreads the smallest id; as many rounds as the longest path
            old = root.copy()
            low = np.minimum(root[i], root[j])
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)
            if (old == root).all():
                break
        on = links > 0
        return ids[on], root[on], links[on]

    def flush():
        if len(held) < 2:
            return
        ids, root, links = solve()
        if len(ids):
            yield pa.RecordBatch.from_pydict({"a": ids, "b": root, "links": links.astype(np.int64)})

    for batch in batches:
        tiles = list(zip(*(batch.column(c).to_pylist() for c in range(5))))
        rows = zip(*(batch.column(c).to_pylist() for c in range(5, 9)))
        for t, r in zip(tiles, rows):
            if t != key:
                yield from flush()
                key, held = t, []
            held.append(r)
    yield from flush()


def _links(signed: DataFrame, comps: DataFrame, similarity: float) -> DataFrame:
    """``a, b, links`` for each text and tile with links: how many, and the smallest text it hangs together with."""
    spark = signed.sparkSession

    def hashes(batches):
        for part, texts in text_chunks(batches, "text"):
            sets = pa.array([s.tobytes() for s in shingles(texts)], pa.binary())
            names = [c for c in part.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in names), sets], names=[*names, "hashes"])

    # Both sides of these joins grow with the corpus, so neither is ever broadcast.
    members = signed.select("row", "n", "sig", "text").join(comps.hint("merge"), F.col("row") == F.col("node")).select(
        "row", F.col("component").alias("comp"), F.floor(F.log("n") / math.log(1.26 * 0.8 / similarity)).cast("int").alias("l"), "sig", "text"
    )
    members = staged(members.mapInArrow(hashes, "row long, comp long, l int, sig binary, hashes binary"), "members")
    sizes = staged(members.groupBy("comp", "l").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nb")), "sizes")
    up = sizes.select("comp", (F.col("l") - 1).alias("l"), F.col("nb").alias("nb_up"))
    down = sizes.select("comp", (F.col("l") + 1).alias("l"), F.col("nb").alias("nb_down"))
    sizes = staged(sizes.join(up, ["comp", "l"], "left").join(down, ["comp", "l"], "left"), "sizes")
    placed = members.join(sizes, ["comp", "l"]).withColumn("j", F.pmod(F.xxhash64("row"), F.col("nb")).cast("int"))
    upto = lambda c: F.when(F.col(c) > 0, F.sequence(F.lit(0), F.col(c) - 1)).otherwise(F.array().cast("array<int>"))
    tile = lambda la, ja, lb, jb, first: F.struct(
        F.lit(la).alias("la") if isinstance(la, int) else la.alias("la"), ja.alias("ja"), lb.alias("lb"), jb.alias("jb"), first.alias("first")
    )
    l, j = F.col("l"), F.col("j")
    own = F.transform(upto("nb"), lambda k: tile(l, F.least(j, k), l, F.greatest(j, k), j <= k))
    higher = F.transform(upto("nb_up"), lambda k: tile(l, j, l + 1, k, F.lit(True)))
    lower = F.transform(upto("nb_down"), lambda k: tile(l - 1, k, l, j, F.lit(False)))
    tiles = placed.select("row", "comp", "sig", "hashes", F.explode(F.concat(own, higher, lower)).alias("t")).select(
        "comp", "t.la", "t.ja", "t.lb", "t.jb", "row", "t.first", "sig", "hashes"
    )
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = tiles.repartition(n, *_TILE).sortWithinPartitions(*_TILE)
    return staged(dealt.mapInArrow(lambda b: _tile_links(b, similarity), "a long, b long, links long"), "links")


def jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
    row_col: str | None = None, keep_text: bool = False,
) -> DataFrame:
    """Classes of texts that hang together by similarity: ``doc_id, class_id, n_links, n_copies, is_first``.

    Two different texts are linked if their sets of five-word windows have a Jaccard similarity of at least ``similarity``; a
    text of fewer words is one window, one without words has no links. Equal texts are handled once. ``n_links`` counts the
    different texts a text is linked to, ``n_copies`` the rows with the same text, the row itself included. A class is
    what links and copies connect, and is named by its smallest doc_id; ``is_first`` holds for one row of it, the one with
    that id. A NULL text is a class of its own. NULL ids rank last. With ``row_col``, of any type, the result has
    that column as well, with ``keep_text`` the text.

    Texts that share a band of MinHash values are put into components by one edge to the first text of the band, so a band
    of many texts gives few rows. Inside a component, blocks of texts of like size meet as tiles: pairs compare MinHash
    values step by step and are dropped when the posterior probability of reaching the threshold is below ``TOLERANCE``; the
    rest are compared exactly by their windows' 64-bit hashes. A tile returns counts and a forest of its links, not pairs.
    """
    given = [F.col(row_col).alias("given")] if row_col else []
    signed = _signed(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *given), "signatures")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    texts = staged(
        signed.where("text is not null").groupBy("k1", "k2")
        .agg(F.min("row").alias("rep"), F.count("*").alias("n_copies"), F.min(first).alias("first")),
        "texts",
    )
    bands = (
        signed.where("n > 0").select("row", "bands").join(texts.select("rep").hint("merge"), F.col("row") == F.col("rep"))
        .select("row", F.explode("bands").alias("band"))
    )
    shared = staged(
        bands.groupBy("band").agg(F.count("*").alias("n"), F.min("row").alias("b")).where("n > 1").select(F.col("band").alias("key"), "b"),
        "bands",
    )
    met = staged(
        bands.join(shared.hint("merge"), F.col("band") == F.col("key")).where("row <> b").select(F.col("row").alias("a"), "b").distinct(), "met"
    )
    sigs = signed.select("row", "sig")
    ends = (
        met.hint("merge").join(sigs.select(F.col("row").alias("a"), F.col("sig").alias("siga")), "a")
        .join(sigs.select(F.col("row").alias("b"), F.col("sig").alias("sigb")).hint("merge"), "b")
    )
    comps = staged(components(_agree(ends)), "candidates")
    links = _links(signed, comps, similarity)
    counts = links.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("n_links"))
    classes = staged(components(links.select("a", "b")), "classes")
    named = staged(
        classes.join(texts.select("rep", "first"), F.col("node") == F.col("rep")).groupBy("component").agg(F.min("first").alias("class")),
        "names",
    )
    by_text = staged(
        texts.join(counts, "rep", "left")
        .join(classes, F.col("rep") == F.col("node"), "left").drop("node")
        .join(named, "component", "left")
        .select("k1", "k2", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("class", "first").alias("class")),
        "by-text",
    )
    rows = signed.select("doc_id", "row", F.when(F.col("text").isNotNull(), F.col("k1")).alias("k1"), "k2", *(["given"] if row_col else []), *(["text"] if keep_text else []))
    return rows.join(by_text.hint("merge"), ["k1", "k2"], "left").select(
        "doc_id",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("class.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce(F.col("class.row") == F.col("row"), F.lit(True)).alias("is_first"),
        *([F.col("given").alias(row_col)] if row_col else []),
        *([F.col("text").alias(text_col)] if keep_text else []),
    )
