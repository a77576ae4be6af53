import random
import re
from collections import Counter, defaultdict

import pytest

from calltide.llm import divergence as dv


def brute(rows, min_docs=10, top=10):
    rows = [tuple(x or "" for x in r[1:4]) for r in rows]
    words = [[w for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))] for t, _, _ in rows]
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for (_, lang, source), w in zip(rows, words):
        docs[lang].update(set(w))
        counts[lang, source].update(w)
    out = []
    for lang in {r[1] for r in rows}:
        kept = [w for w, n in docs[lang].items() if n >= min_docs]
        sources = {r[2] for r in rows if r[1] == lang}

        def shares(own):
            total = sum(own[w] for w in kept) + 2 * len(kept)
            return {w: 1 + 1000000000 * (own[w] + 2) // total for w in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s][w], p[t][w]) for w in kept), t) for t in sources if t != s]
            terms = [(f(p[s][w], q[w]), w) for w in kept if counts[lang, s][w] and p[s][w] > q[w]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(items[:most])]
    return sorted(out)


def documents(seed, n=300):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["Éa", "日本", "\U0001f600", "It"]
    rows = []
    for i in range(n):
        text = rng.choice([" ", ", ", "1"]).join(rng.choices(words, k=rng.randint(0, 40), weights=range(1, 65)))
        rows.append((i, text, rng.choice(["en", "en", "de"]), f"s{rng.randrange(5)}"))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(frame, seed, monkeypatch):
    monkeypatch.setattr(dv, "POSTINGS", 300)
    monkeypatch.setattr(dv, "SEGMENT", 5)
    monkeypatch.setattr(dv, "RUNS", 4)  # several levels of merges
    rows = documents(seed)
    got = sorted(map(tuple, dv.divergence(frame(rows).repartition(7)).collect()))
    assert got == brute(rows) and {r[2] for r in got} == {"pair", "term"}


def test_edges(frame, edge_rows, spark):
    rows = [(r + (None, None))[:4] if len(r) > 2 else (*r, "en", "s") for r in edge_rows]
    rows += [(i, "Over and Over", None, f"t{i % 3}") for i in range(30)] + [(50, None, "xx", "a"), (51, "1 2 3", "xx", "b")]
    assert sorted(map(tuple, dv.divergence(frame(rows)).collect())) == brute(rows)
    assert dv.divergence(frame(rows).where("false")).count() == 0
    assert sorted(map(tuple, dv.divergence(frame(rows), min_docs=1, top=3).collect())) == brute(rows, 1, 3)


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = "one Two,three 日本日本 four" * 7
    (want,) = dv.terms_of(text)
    monkeypatch.setattr(dv, "SLICE", 5)
    got = list(dv.terms_of(text))
    assert sum(got, []) == want and len(got) > 5


def test_merge_adds_up_and_opens_late():
    segments = [
        (["a", "a"], ["x", "y"], [2, 3], ["r", "s", "s"], [4, 1, 2], [1, 1, 1]), (["a"], ["x"], [1], ["r"], [5], [1]), (["a"], ["y"], [1], ["q"], [3], [2]),
    ]
    assert list(dv.merged(segments)) == [(("a", "x"), ["r", "s"], [9, 1], [2, 1]), (("a", "y"), ["q", "s"], [3, 2], [2, 1])]


def test_sums_handed_on_early_add_up(frame, monkeypatch):
    monkeypatch.setattr(dv, "SUMS", 3)
    rows = documents(5)
    frame(rows).sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        assert sorted(map(tuple, dv.divergence(frame(rows)).collect())) == brute(rows)
    finally:
        frame(rows).sparkSession.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_terms_are_merged_many_at_a_time(monkeypatch):
    """A random merge equals plain sums, in blocks that are few beside the terms."""
    rng = random.Random(1)
    monkeypatch.setattr(dv, "MERGED", 40)
    want, segments = defaultdict(lambda: [0, 0]), []
    for _ in range(9):
        run = sorted({(rng.choice(["", "a", "a\0b"]), f"t{rng.randrange(60)}é") for _ in range(50)})
        for at in range(0, len(run), 7):
            own = run[at : at + 7]
            sources = [sorted(rng.sample(["q", "r", "s"], rng.randint(1, 3))) for _ in own]
            flat = [(key, s, rng.randint(1, 9), rng.randint(1, 3)) for key, found in zip(own, sources) for s in found]
            for key, s, n, d in flat:
                want[key, s][0] += n
                want[key, s][1] += d
            ends = [sum(map(len, sources[: i + 1])) for i in range(len(own))]
            segments.append(([k[0] for k in own], [k[1] for k in own], ends, [f[1] for f in flat], [f[2] for f in flat], [f[3] for f in flat]))
    segments.sort(key=lambda s: (s[0][0], s[1][0]))
    blocks = []
    summed = dv._summed
    monkeypatch.setattr(dv, "_summed", lambda parts: blocks.append(len(parts)) or summed(parts))
    got = list(dv.merged(segments))
    assert [(key, s, n, d) for key, own, counts, docs in got for s, n, d in zip(own, counts, docs)] == [(*k, *v) for k, v in sorted(want.items())]
    assert 1 < len(blocks) < len(got) / 5


def test_block_adds_postings_up_while_it_fills(monkeypatch):
    monkeypatch.setattr(dv, "FOLD", 50)
    block, rows = dv._Block(), documents(3)
    for _, text, lang, source in rows:
        block.add(text, lang, source)
        assert block.waiting == sum(map(len, block.keys)) < max(50, 64 * 10)  # terms of a language and source
    got = {}
    for b in block.run(3, 0):
        for r in b.to_pylist():
            starts = [0, *r["ends"]]
            for i, key in enumerate(zip(r["langs"], r["terms"])):
                for at in range(starts[i], starts[i + 1]):
                    got[key, r["sources"][at]] = (r["counts"][at], r["docs"][at])
    counts, docs = Counter(), Counter()
    for _, text, lang, source in rows:
        found = [w.decode() for part in dv.terms_of(text) for w in part]
        counts.update(((lang, w), source) for w in found)
        docs.update(((lang, w), source) for w in set(found))
    assert got == {k: (n, docs[k]) for k, n in counts.items()}


def test_documents_come_in_small_batches(frame, spark, monkeypatch):
    """A batch of texts is held several times over outside the JVM's heap."""
    setting, seen, staged = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, dv.staged
    before = spark.conf.get(setting)
    monkeypatch.setattr(dv, "staged", lambda df, label: seen.setdefault(label, int(spark.conf.get(setting))) and staged(df, label))
    dv.term_frequencies(frame(documents(1)).select("text", "lang", "source"))
    assert seen["runs"] <= 1000 and spark.conf.get(setting) == before
    spark.conf.set(setting, "17")
    try:
        seen.clear()
        dv.term_frequencies(frame(documents(1)).select("text", "lang", "source"))
        assert seen["runs"] == 17 and spark.conf.get(setting) == "17"
    finally:
        spark.conf.set(setting, before)
