import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from calltide.llm import line_dedup, mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Targets by source: share by weight, clamp what passes its cap, share the excess anew."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, free = {}, share * sum(sizes.values()), set(order)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > cap * sizes[s]}
        if not over:
            target |= {s: weight[s] * level for s in free}
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_targets_and_sizes_equal_brute_force(spark, frame, edge_rows):
    rows = [*edge_rows, *((100 + i, "word " * (1 + i * 7 % 23), "en", None if i % 11 == 0 else f"é{i % 5}") for i in range(300))]
    got = mixing.mix(frame(rows)).collect()
    size = lambda t: len(WORD.findall(t or ""))
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((r[0], size(r[1])) for r in rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3] if len(r) > 3 else "s"] += size(r[1])
    want = brute_targets(dict(sizes))
    taken = defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 20 for s in sizes if s != "s")
    again = mixing.mix(frame(rows).repartition(7)).collect()
    assert Counter((r.doc_id, r["size"], r.taken) for r in again) == Counter((r.doc_id, r["size"], r.taken) for r in got)


def test_short_documents_fill_the_target_behind_a_long_one(spark):
    """One document is larger than the rest of the target of its source, whatever its place in the order."""
    docs = spark.range(301).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), F.when(F.col("id") == 7, 100_000).otherwise(500).cast("int")).alias("text"),
        F.lit("s").alias("source"),
    )
    for seed in range(3):
        taken, target = mixing.mix(docs, seed=seed).agg(F.sum("taken"), F.first("target")).first()
        assert abs(taken - target) <= 250


def test_rest_is_filled_first_fit_in_hash_order(spark, frame, edge_rows):
    """Every source, also the one with the very long text: no document that would still fit is left out."""
    rows = [*edge_rows, *((100 + i, "word " * (1 + i * i % 211), "en", None if i % 11 == 0 else f"é{i % 5}") for i in range(300))]
    rows += [(500 + i, "word " * (1 + i * 37 % 400)) for i in range(100)]
    docs = frame(rows)
    got = mixing.mix(docs).withColumn("h", mixing.keyed_hash(F.col("doc_id"), F.col("size"), seed=7)).collect()
    signed = lambda h: [h >> 16 * i & 0xFFFF & 255 for i in range(2)] + [h]
    for source in {r.source for r in got}:
        mine = sorted((r for r in got if r.source == source), key=lambda r: (*signed(r.h), r.doc_id or -1))
        held = mine[0].source_size
        whole = int(mine[0].target // held) if held else 0
        gap = mine[0].target - whole * held
        want = []
        for r in mine:
            if 0 < r["size"] <= gap:
                want.append(r["size"])
                gap -= r["size"]
        left = Counter(r["size"] for r in mine if r["size"]) - Counter(want)
        near = min(left, key=lambda z: abs(z - gap), default=0)
        want += [near] if near and abs(near - gap) < gap else []
        assert Counter(r["size"] for r in mine if r.copies > whole and r["size"]) == Counter(want)
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= min(left, default=0) / 2 + 1e-6


def test_rows_without_an_id_spread_over_hash_ranges(spark, monkeypatch):
    """Equal rows without an id have hashes of their own, so that a range holds a few of them only."""
    docs = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("w w w").alias("text"), F.lit("s").alias("source"))
    found = []
    cuts = mixing._cuts
    monkeypatch.setattr(mixing, "_cuts", lambda keyed, *a: found.append(keyed) or cuts(keyed, *a))
    taken, target = mixing.mix(docs).agg(F.sum("taken"), F.first("target")).first()
    assert abs(taken - target) <= 1.5
    assert found[0].groupBy("b0", "b1").count().agg(F.max("count")).first()[0] < 10


def test_one_source_holds_nearly_all(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 13).cast("int")).alias("text"),
        F.when(F.col("id") % 100 > 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 700)).alias("source"),
    )
    got = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) <= 6 for r in got)


def test_mix_of_nothing_and_of_empty_texts(frame):
    assert mixing.mix(frame([])).count() == 0
    assert {r.taken for r in mixing.mix(frame([(1, None), (2, "")])).collect()} == {0}


def brute_dedup(rows, window=3):
    """Kept lines of rows in order."""
    seen, out = set(), []
    for text in rows:
        if text is None:
            out.append((0, 0, 0, None))
            continue
        lines = text.split("\n")
        gone = set()
        for i in range(len(lines) - window + 1):
            w = tuple(lines[i : i + window])
            if w in seen:
                gone.update(range(i, i + window))
            seen.add(w)
        spans = sum(g - 1 not in gone for g in gone)
        out.append((len(lines), len(gone), spans, "\n".join(t for i, t in enumerate(lines) if i not in gone)))
    return out


def test_line_dedup_equals_brute_force(frame, edge_rows):
    import random

    rng = random.Random(4)
    rows = sorted((r for r in edge_rows), key=lambda r: (r[0] is not None, r[0] or 0))
    rows += [(50 + i, "\n".join(rng.choices("abc", k=rng.randint(0, 14)))) for i in range(60)]
    rows += [(900 + i, "x\ny\nz\nx\ny\nz\nx") for i in range(3)]
    got = line_dedup.dedup_lines(frame(rows[::-1])).collect()
    want = Counter((r[0], *w) for r, w in zip(rows, brute_dedup([r[1] for r in rows])))
    assert Counter((r.doc_id, r.n_lines, r.n_removed, r.n_spans, r.kept) for r in got) == want


def test_line_dedup_of_nothing(frame):
    assert line_dedup.dedup_lines(frame([])).count() == 0
