import random
import re

import numpy as np
import pytest

from calltide.llm import odd_sketch as od


def sets_of(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))} if words else set()


def brute(rows):
    sets = [sets_of(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[find(i)] = find(j)
    out = []
    for i, r in enumerate(rows):
        ids = [s[0] for j, s in enumerate(rows) if find(j) == find(i) and s[0] is not None]
        least = min(ids, default=None)
        out.append((r[0], len(sets[i]), least, r[0] == least))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, od.near_duplicates(df).collect()), key=str)


def families(seed, n=160):
    """Texts a few edits away from each other, in chains and around hubs, at similarities on both sides of the threshold."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(5):
        text = rng.choices(words, k=rng.choice([60, 120, 200]))
        for _ in range(n // 5):
            own = text[:]
            for _ in range(rng.randint(0, 9)):
                own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < 0.3:
                text = own
            rows.append(" ".join(own))
    return [(i, t.upper() if i % 7 == 0 else t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(frame, seed, monkeypatch):
    monkeypatch.setattr(od, "BLOCK", 7)
    monkeypatch.setattr(od, "SET_BLOCK", 4)
    rows = families(seed)
    want = brute(rows)
    assert found(frame(rows)) == want and 5 < len({w[2] for w in want}) < 150


def test_every_step_alone_is_complete(frame, monkeypatch):
    """Without confirmed first and nearest texts, the last step finds all links."""
    rows = families(8)
    monkeypatch.setattr(od, "_nearest", lambda similarity: lambda *a: None)
    monkeypatch.setattr(od, "_confirmed", lambda pairs, sets, similarity: pairs.select("a", "b").where("false"))
    assert found(frame(rows)) == brute(rows)


def test_edges(frame, edge_rows):
    rows = [tuple(r[:2]) for r in edge_rows] + [(20, "one two three"), (21, "One  Two\nTHREE"), (None, "one two three"), (30, "É a b c d"), (31, "é a b c d")]
    assert found(frame(rows)) == brute(rows)
    assert found(frame(rows).where("false")) == []


def test_null_ids_and_shared_ids(frame):
    rows = [(None, "a b c d e f")] * 3 + [(4, "g h i j k l"), (4, "g h i j k l"), (None, "g h i j k l")]
    got = found(frame(rows))
    assert got == sorted([(None, 3, None, True)] * 3 + [(4, 3, 4, True)] * 2 + [(None, 3, 4, False)], key=str)


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    for target in (0.7, 0.8, 0.9, 0.95):
        errors = []
        for _ in range(40):
            whole = rng.integers(0, 1 << 63, 2000, np.uint64)
            cut = round(2000 * (1 - target) / 2)
            a, b = np.sort(whole[cut:]), np.sort(whole[: 2000 - cut])
            x, y = (od.odd_sketch(od.samples(v)) for v in (a, b))
            ones = int(np.bitwise_count(x ^ y).sum())
            errors.append(od.estimate(ones) - target)
            assert target < 0.8 or ones <= od.most_ones()
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    assert len(x) * 8 == od.BITS and (od.odd_sketch(od.samples(a)) == x).all()


def test_limit_of_ones_bounds_misses():
    assert od.most_ones(0.8, 1e-6) > od.most_ones(0.8, 1e-3) > od.most_ones(0.9, 1e-3)
    rng = np.random.default_rng(2)
    limit, over = od.most_ones(0.8, 0.05), 0
    for _ in range(2000):
        flips = np.bincount(rng.integers(0, od.BITS, 2 * rng.binomial(od.SAMPLES, 0.2)), minlength=od.BITS)
        over += (flips & 1).sum() > limit
    assert 40 < over < 125


def test_roots_of_a_forest(spark):
    rng = random.Random(4)
    links = [(i, rng.randrange(max(0, i - 3), i)) for i in range(1, 60) if i % 13] + [(100 + i, 99 + i) for i in range(1, 40)]
    root = {}
    for a, b in links:
        root.setdefault(b, b)
        root[a] = root[b]
    got = od.forest(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == root and len(got) == len(root)
    assert od.forest(spark.createDataFrame([], "a long, b long")).count() == 0
