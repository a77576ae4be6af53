"""Audit of how far the sources of a language differ in their words, from postings built in a single pass.

Single-pass in-memory indexing: a task counts the terms of its documents per language and source until a bounded number of
postings is held, then spills them as a run sorted by term, cut by the hash shard of the term. The runs of a shard are merged
with a heap of the runs' heads into frequencies, many terms at a time; with very many runs, groups of them are merged into longer runs first, so a
merge holds the heads of a bounded number of runs. The divergence of two sources is a sum over all terms of the language: the
value both have without a term, plus corrections of the terms that one of them has, which depend on a count only and are
summed by count, plus corrections of the terms both have, which are added up while the merged terms stream by.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from calltide.llm.common import staged, tasks, text_chunks

TERM = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
_LETTERS = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalpha() else 32 for c in range(256))  # all others are blanks
MIN_DOCS, TOP = 10, 10
UNIT = 1_000_000_000
POSTINGS = 2_000_000  # terms of documents that a task holds before it spills a run
WORDS = 500_000  # different terms it holds
FOLD = 250_000  # postings it holds before it adds up those of a term in a language and source
BATCH = 1_000  # documents handed to a task at once
SEGMENT = 1_000  # terms of a run in a row
RUNS = 256  # merged at once
MERGED = 50_000  # terms of runs merged at once, at least
SLICE = 1_000_000  # bytes of a text searched at once
SUMS = 500_000  # pair sums a task holds
_RUN = "shard int, run long, lang string, term string, langs array<string>, terms array<string>, ends array<long>, sources array<string>, counts array<long>, docs array<long>"
_NAMES = ["shard", "run", "lang", "term", "langs", "terms", "ends", "sources", "counts", "docs"]


def terms_of(text: str) -> Iterator[list[bytes]]:
    """Runs of letters and of characters beyond ASCII, with A to Z in lower case, as UTF-8, by slices of the text."""
    raw, at = text.encode(), 0
    while at < len(raw):
        end = at + SLICE
        if rest := TERM.match(raw, end):  # cut between terms
            end = rest.end()
        yield raw[at:end].translate(_LETTERS).split()
        at = end


def _sorted(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Different values in order of their bytes, and each value's place among them."""
    order = pc.sort_indices(values).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return values.take(pa.array(order)), rank


def _ranked(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The different ones of the values in order of their bytes, and each value's place among them."""
    coded = values.dictionary_encode()
    names, rank = _sorted(coded.dictionary)
    return names, rank[coded.indices.to_numpy()]


class _Numbers(dict):
    """Numbers things in the order in which they are asked for."""

    def __missing__(self, key) -> int:
        self[key] = n = len(self)
        return n


class _Block:
    """Postings of documents in memory, those of a term in a language and source added up from time to time."""

    def __init__(self):
        self.words, self.groups = _Numbers(), _Numbers()
        self.keys: list[np.ndarray] = []  # of documents not added up yet
        self.counts: list[np.ndarray] = []
        self.size = self.waiting = 0
        self.held = (np.zeros(0, np.int64),) * 3  # keys, counts and numbers of documents

    def add(self, text: str, lang: str, source: str) -> None:
        codes = [np.fromiter(map(self.words.__getitem__, found), np.int64, len(found)) for found in terms_of(text)]
        if codes:
            own, n = np.unique(np.concatenate(codes), return_counts=True)
            self.keys.append(own + (self.groups[lang, source] << 32))
            self.counts.append(n.astype(np.int32))
            self.size += len(own)
            self.waiting += len(own)
            if self.waiting >= max(FOLD, len(self.held[0]) // 2):
                self._fold()

    def _fold(self) -> None:
        """Add the documents' postings up."""
        keys, counts, docs = self.held
        keys = np.concatenate([keys, *self.keys])
        counts = np.concatenate([counts, *self.counts])
        docs = np.concatenate([docs, np.ones(self.waiting, np.int64)])
        self.keys, self.counts, self.waiting = [], [], 0
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        self.held = keys[first], np.add.reduceat(counts[order], first), np.add.reduceat(docs[order], first)

    def run(self, shards: int, number: int) -> Iterator[pa.RecordBatch]:
        """The postings as rows of a run, in order of shard, language, term and source. The block is used up."""
        if not self.size:
            return
        if self.waiting:
            self._fold()
        keys, counts, docs = self.held
        group, word = keys >> 32, keys & 0xFFFFFFFF
        words = pa.array(list(self.words), pa.binary()).cast(pa.string())
        self.words.clear()
        words, of_word = _sorted(words)
        langs, of_lang = _ranked(pa.array([g[0] for g in self.groups], pa.string()))
        sources, of_source = _ranked(pa.array([g[1] for g in self.groups], pa.string()))
        pairs, at = np.unique(of_lang[group] << 32 | of_word[word], return_inverse=True)
        raw, names = words.cast(pa.binary()).to_pylist(), [n.encode() + b"\0" for n in langs.to_pylist()]
        shard = np.array([xxhash.xxh64_intdigest(names[x >> 32] + raw[x & 0xFFFFFFFF]) % shards for x in pairs.tolist()])
        order = np.lexsort((of_source[group], at, shard[at]))
        ends = np.flatnonzero(np.append(np.diff(at[order]) != 0, True)) + 1
        own = at[order][ends - 1]
        yield from _rows(
            shard[own], number, langs.take(pa.array(pairs[own] >> 32)), words.take(pa.array(pairs[own] & 0xFFFFFFFF)), ends,
            sources.take(pa.array(of_source[group[order]])), pa.array(counts[order]), pa.array(docs[order]),
        )


def _rows(shard: np.ndarray, run: int, langs: pa.Array, terms: pa.Array, ends: np.ndarray, *values: pa.Array) -> Iterator[pa.RecordBatch]:
    """Rows of a run: up to ``SEGMENT`` terms of a shard each, with the number of values up to the end of each term."""
    change = np.flatnonzero(np.diff(shard, prepend=-1))
    place = np.arange(len(shard)) - np.repeat(change, np.diff(np.append(change, len(shard))))
    cuts = np.append(np.flatnonzero(place % SEGMENT == 0), len(shard))
    starts = np.append(0, ends)
    for at in range(0, len(cuts) - 1, 20):
        own = cuts[at : at + 21]
        first, since, upto = own[0], starts[own[0]], starts[own[-1]]
        inner = ends[first : own[-1]] - np.repeat(starts[own[:-1]], np.diff(own))
        of_terms, of_values = pa.array(own - first, pa.int32()), pa.array(starts[own] - since, pa.int32())
        lists = [pa.ListArray.from_arrays(of_terms, c.slice(first, own[-1] - first)) for c in (langs, terms)]
        lists.append(pa.ListArray.from_arrays(of_terms, pa.array(inner, pa.int64())))
        lists += [pa.ListArray.from_arrays(of_values, c.slice(since, upto - since)) for c in values]
        heads = [c.take(pa.array(own[:-1])) for c in (langs, terms)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(shard[own[:-1]], pa.int32()), pa.array(np.full(len(own) - 1, run, np.int64)), *heads, *lists], names=_NAMES
        )


def _spilled(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Runs of the documents' postings; columns ``text, lang, source, task``."""
    block, number, task = _Block(), 0, 0
    for part, texts in text_chunks(batches, "text"):
        task = part.column(3)[0].as_py()
        for row in zip(texts, part.column(1).to_pylist(), part.column(2).to_pylist()):
            block.add(*row)
        if block.size >= POSTINGS or len(block.words) >= WORDS:
            yield from block.run(shards, (task << 24) + number)
            block, number = _Block(), number + 1
    yield from block.run(shards, (task << 24) + number)


class _Piece:
    """What is left of a segment: ``langs, terms`` and for each term its ``sources, counts, docs``."""

    def __init__(self, langs: pa.Array, terms: pa.Array, ends: np.ndarray, sources: pa.Array, counts: np.ndarray, docs: np.ndarray):
        self.langs, self.terms, self.sources, self.counts, self.docs = langs, terms, sources, counts, docs
        self.starts, self.at = np.append(0, ends), 0

    def __len__(self) -> int:
        return len(self.terms)

    def __getitem__(self, i: int) -> tuple[str, str]:
        return self.langs[i].as_py(), self.terms[i].as_py()

    def upto(self, end: int) -> tuple:
        """The terms up to ``end`` that were not taken yet."""
        at, self.at = self.at, end
        cut = slice(self.starts[at], self.starts[end])
        return self.langs[at:end], self.terms[at:end], np.diff(self.starts[at : end + 1]), self.sources[cut], self.counts[cut], self.docs[cut]


def _summed(parts: list[tuple]) -> tuple[pa.Array, pa.Array, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """``langs, terms, ends, sources, counts, docs`` of parts of runs, in order and added up."""
    langs, terms, sizes, sources, counts, docs = zip(*parts)
    (lang_names, lang), (names, term), (source_names, source) = [_ranked(pa.concat_arrays(c)) for c in (langs, terms, sources)]
    pairs, at = np.unique(lang * len(names) + term, return_inverse=True)
    keys = np.repeat(at, np.concatenate(sizes)) * len(source_names) + source
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    own, source = np.divmod(keys[first], len(source_names))
    ends = np.flatnonzero(np.append(np.diff(own) != 0, True)) + 1
    counts, docs = (np.add.reduceat(np.concatenate(c)[order], first) for c in (counts, docs))
    return lang_names.take(pa.array(pairs // len(names))), names.take(pa.array(pairs % len(names))), ends, source_names.take(pa.array(source)), counts, docs


def merged_blocks(segments: Iterator[tuple]) -> Iterator[tuple]:
    """``langs, terms, ends, sources, counts, docs`` of many runs, in order and added up, whole terms at a time.

    A heap holds the next term of each open segment. Segments come sorted by their first term, so all terms before that of the
    newest one are complete. They are taken off the heap together once twice as many terms are held as were left the last time.
    """
    heap: list[tuple] = []
    held, limit = 0, MERGED

    def before(key: tuple[str, str] | None) -> Iterator[tuple]:
        """The terms before ``key``, which leave the heap; all terms for None."""
        while heap and (key is None or heap[0][0] < key):
            _, number, piece = heap[0]
            end = len(piece) if key is None else bisect_left(piece, key, piece.at)
            yield piece.upto(end)
            if end < len(piece):
                heapq.heapreplace(heap, (piece[end], number, piece))
            else:
                heapq.heappop(heap)

    for number, segment in enumerate(segments):
        piece = _Piece(*segment)
        if held >= limit and (parts := list(before(piece[0]))):
            held -= sum(len(p[0]) for p in parts)
            limit = MERGED + 2 * held
            yield _summed(parts)
        heapq.heappush(heap, (piece[0], number, piece))
        held += len(piece)
    if parts := list(before(None)):
        yield _summed(parts)


def merged(segments: Iterator[tuple[list, ...]]) -> Iterator[tuple[tuple[str, str], list, list, list]]:
    """``(lang, term), sources, counts, docs`` of many runs given as lists, a term at a time."""
    kinds = (pa.string(), pa.string(), None, pa.string(), None, None)
    for langs, terms, ends, *values in merged_blocks([np.array(c, np.int64) if k is None else pa.array(c, k) for c, k in zip(s, kinds)] for s in segments):
        starts = np.append(0, ends)
        for i, key in enumerate(zip(langs.to_pylist(), terms.to_pylist())):
            yield key, *(c[starts[i] : starts[i + 1]].tolist() for c in values)


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], Iterator[tuple]]]:
    """``(shard, run), segments`` for each run of equal ones; the segments must be read before the next key."""

    def segment(b: pa.RecordBatch, i: int) -> tuple:
        own = [b.column(c)[i].values for c in range(4, 10)]
        # copies, so that a batch isn't held for the sake of some of its segments
        return tuple(np.array(c) if pa.types.is_integer(c.type) else c.take(pa.array(np.arange(len(c)))) for c in own)

    rows = ((tuple(b.column(c)[i].as_py() for c in (0, 1)), segment(b, i)) for b in batches for i in range(b.num_rows))
    row = next(rows, None)

    def own(key):
        nonlocal row
        while row is not None and row[0] == key:
            yield row[1]
            row = next(rows, None)

    while row is not None:
        key = row[0]
        yield key, own(key)


def _merged_runs(runs: DataFrame, shards: int, final: bool, groups: int = 1, min_docs: int = 1) -> DataFrame:
    """Merge the runs of each shard: into ``groups`` longer runs, or (``final``) into frequencies of kept terms."""

    def longer(batches):
        for (shard, group), segments in _by_key(batches):
            for langs, terms, ends, sources, counts, docs in merged_blocks(segments):
                yield from _rows(np.full(len(terms), shard), group, langs, terms, ends, sources, pa.array(counts), pa.array(docs))

    def frequencies(batches):
        names = ["shard", "lang", "term", "source", "count", "all", "first"]
        for (shard, _), segments in _by_key(batches):
            for langs, terms, ends, sources, counts, docs in merged_blocks(segments):
                starts = np.append(0, ends[:-1])
                sizes = ends - starts
                at = np.repeat(np.arange(len(terms)), sizes)  # the term of each row
                first = np.zeros(len(at), bool)
                first[starts] = True
                rows = np.flatnonzero(np.repeat(np.add.reduceat(docs, starts) >= min_docs, sizes))
                total, of = np.add.reduceat(counts, starts), pa.array(at[rows])
                made = pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rows), shard, np.int32)), langs.take(of), terms.take(of), sources.take(pa.array(rows)),
                        pa.array(counts[rows]), pa.array(total[at[rows]]), pa.array(first[rows]),
                    ],
                    names=names,
                )
                yield from (made.slice(i, 10_000) for i in range(0, len(rows), 10_000))

    group = F.lit(0).cast("long") if final else F.pmod(F.xxhash64("run"), F.lit(groups)).cast("long")
    dealt = (
        runs.withColumn("run", group).repartition(shards, "shard", "run").sortWithinPartitions("shard", "run", "lang", "term")
    )
    if final:
        return dealt.mapInArrow(frequencies, "shard int, lang string, term string, source string, count long, all long, first boolean")
    return dealt.mapInArrow(longer, _RUN)


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Hand at most ``BATCH`` rows to Python at once: a batch of texts is held several times over outside the JVM's heap."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    most = spark.conf.get(setting)
    if 0 < int(most) <= BATCH:
        yield
        return
    spark.conf.set(setting, str(BATCH))
    try:
        yield
    finally:
        spark.conf.set(setting, most)


def term_frequencies(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Stage ``shard, lang, term, source, count`` for the terms in at least ``min_docs`` documents of their language.

    ``all`` is the count in the language, and ``first`` holds for one row of each term.

    ``docs`` has ``text``, ``lang`` and ``source`` without NULLs.
    """
    shards = tasks(docs)
    rows = docs.select("text", "lang", "source", F.spark_partition_id().cast("long").alias("task"))
    with _small_batches(docs.sparkSession):
        runs = staged(rows.mapInArrow(lambda b: _spilled(b, shards), _RUN), "runs")
    n = runs.select("run").distinct().count()
    while n > RUNS:
        n = -(-n * 2 // RUNS)  # half full on average, as groups are dealt by hash
        runs = staged(_merged_runs(runs, shards, False, n), "runs")
    return staged(_merged_runs(runs, shards, True, min_docs=min_docs), "frequencies")


def _share(count: str, total: str) -> Column:
    """1 + floor(UNIT * (count + 2) / total) in whole numbers."""
    return F.expr(f"1 + (cast({UNIT} as decimal(10, 0)) * cast({count} + 2 as decimal(19, 0))) div cast({total} as decimal(19, 0))")


def _value(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections of the terms that two sources share, added up as they stream by; rows come by shard, language and term.

    Columns ``lang, term, source, p, p0``. Each pair of sources gets one row, the smaller name first, unless so many pairs are
    touched that the sums are handed on early.
    """
    names = _Numbers()  # of languages and sources, together
    sums: dict[tuple[int, int], int] = {}
    rest: pa.RecordBatch | None = None

    def handed() -> pa.RecordBatch:
        of = list(names)
        made = pa.RecordBatch.from_arrays(
            [
                pa.array([of[a][0] for a, _ in sums], pa.string()), pa.array([of[a][1] for a, _ in sums], pa.string()),
                pa.array([of[b][1] for _, b in sums], pa.string()), pa.array(sums.values(), pa.int64()),
            ],
            names=["lang", "source", "item", "part"],
        )
        sums.clear()
        return made

    def numbers(b: pa.RecordBatch, *columns: int) -> np.ndarray:
        """Each row's number among the different values of the columns."""
        out = np.zeros(b.num_rows, np.int64)
        for c in columns:
            coded = b.column(c).dictionary_encode()
            out = out * (len(coded.dictionary) + 1) + coded.indices.to_numpy()
        return out

    def add(b: pa.RecordBatch) -> None:
        term = np.cumsum(np.diff(numbers(b, 0, 1), prepend=-1) != 0)
        _, first, at = np.unique(numbers(b, 0, 2), return_index=True, return_inverse=True)
        own = np.array([names[b.column(0)[i].as_py(), b.column(2)[i].as_py()] for i in first.tolist()], np.int64)[at]
        p, p0 = b.column(3).to_numpy(), b.column(4).to_numpy()
        f = lambda u, v: (u - v) * (u - v) // (u + v)
        for apart in range(1, b.num_rows):  # terms' sources are neighbours
            i = np.flatnonzero(term[apart:] == term[:-apart])
            if not len(i):
                break
            j = i + apart
            part = f(p[i], p[j]) - f(p[i], p0[j]) - f(p0[i], p[j]) + f(p0[i], p0[j])
            pairs, where = np.unique(np.minimum(own[i], own[j]) << 32 | np.maximum(own[i], own[j]), return_inverse=True)
            total = np.zeros(len(pairs), np.int64)
            np.add.at(total, where, part)
            for pair, value in zip(pairs.tolist(), total.tolist()):
                key = (pair >> 32, pair & 0xFFFFFFFF)
                sums[key] = sums.get(key, 0) + value

    for b in batches:
        if rest is not None:
            b = pa.concat_batches([rest, b])
        term = numbers(b, 0, 1)
        cut = len(term) - int(np.argmax(term[::-1] != term[-1])) if len(term) and (term != term[-1]).any() else 0
        rest = b.slice(cut)
        if cut:
            add(b.slice(0, cut))
        if len(sums) >= SUMS:
            yield handed()
    if rest is not None and rest.num_rows:
        add(rest)
    yield handed()


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """How far each source of a language is from each other one, and the terms it has most above its language.

    Returns ``lang, source, part, item, value, rank``. With count occurrences of a kept term (one in at least ``min_docs``
    documents of the language) among N of all V kept terms, a source's p is 1 + floor(10^9 (count + 2) / (N + 2 V)); a
    language has one as well. The value of two shares is floor((p - q)^2 / (p + q)). Part ``pair`` has each other source of
    the language as item and the sum over all kept terms; part ``term`` the ``top`` terms that a source has and whose p is
    above the language's. Ranks go by value, descending, then by the item's UTF-8 bytes. All arithmetic is exact.

    NULL texts, languages and sources count as empty strings. A source without kept terms has counts of zero; in a language
    without kept terms all pairs have the value 0. A source alone in its language has no pairs. Repeated rows count each
    time. An empty table gives no rows. Other columns are ignored.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text(text_col).alias("text"), text(lang_col).alias("lang"), text(source_col).alias("source"))
    kept = term_frequencies(rows, min_docs)
    size = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    langs = kept.groupBy("lang").agg(F.count_if("first").alias("v"), F.sum("count").alias("lang_n"))
    v = F.coalesce("v", F.lit(0))
    groups = staged(
        rows.select("lang", "source").distinct().join(size, ["lang", "source"], "left").join(langs, "lang", "left").select(
            "lang", "source", v.alias("v"), (F.coalesce("n", F.lit(0)) + 2 * v).alias("total"), (F.coalesce("lang_n", F.lit(0)) + 2 * v).alias("lang_total")
        ).withColumn("p0", F.when(F.col("v") > 0, _share("0", "total")).otherwise(F.lit(1))),
        "groups",
    )
    shares = staged(kept.join(groups, ["lang", "source"]).withColumn("p", _share("count", "total")), "shares")

    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    unlike = F.col("source") != F.col("item")
    base = groups.join(other, "lang").where(unlike).select("lang", "source", "item", (F.col("v") * _value("p0", "q0")).alias("part"))
    alone = (
        shares.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("terms")).join(other, "lang").where(unlike)
        .select("lang", "source", "item", (F.col("terms") * (_value("p", "q0") - _value("p0", "q0"))).alias("part"))
    )
    swapped = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "part")
    dealt = shares.select("shard", "lang", "term", "source", "p", "p0").repartition(tasks(docs), "shard").sortWithinPartitions("shard", "lang", "term")
    both = staged(dealt.drop("shard").mapInArrow(_pair_sums, "lang string, source string, item string, part long"), "pairs")
    turned = both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "part")
    pairs = base.unionByName(alone).unionByName(swapped).unionByName(both).unionByName(turned).groupBy("lang", "source", "item").agg(F.sum("part").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    terms = (
        shares.withColumn("q", _share("`all`", "lang_total")).where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _value("p", "q").alias("value"))
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(best)
