import itertools
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from calltide.llm import crf, quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, covered, seen, again = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 5))
    for line in text.split("\n"):
        again += line in seen and bool(WORD.search(line))
        seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered)


def random_chain(rng, lines):
    chain = crf.Chain(rng.normal(size=3 * crf.FEATURES), rng.normal(size=(2, 2)))
    x = rng.normal(size=(lines, crf.FEATURES)).astype(np.float32)
    return chain, x


def all_sequences(chain, x):
    """Scores of all sequences of states of one document."""
    n = len(x)
    e = crf.with_neighbours(x, np.array([0]), np.array([n])) @ chain.weights
    for states in itertools.product((0, 1), repeat=n):
        score = sum(e[i] for i in range(n) if states[i])
        yield states, score + sum(chain.moves[a, b] for a, b in zip(states, states[1:]))


@pytest.mark.parametrize("seed", range(8))
def test_decoding_equals_enumeration(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(1, 7, 4)
    chain, x = random_chain(rng, counts.sum())
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    lines = crf.Lines(x, np.ones(len(x)), starts, counts)
    marginals, states = chain.marginals(lines), chain.viterbi(lines)
    for s, c in zip(starts, counts):
        scored = list(all_sequences(chain, x[s : s + c]))
        total = sum(np.exp(v) for _, v in scored)
        for i in range(c):
            assert marginals[s + i] == pytest.approx(sum(np.exp(v) for k, v in scored if k[i]) / total)
        assert tuple(states[s : s + c]) == max(scored, key=lambda k: k[1])[0]


def test_training_learns_a_chain():
    rng = np.random.default_rng(1)
    counts = np.full(200, 6)
    y = np.repeat(rng.integers(0, 2, 200), 6).astype(float)
    x = rng.normal(size=(1200, crf.FEATURES)).astype(np.float32)
    x[:, 0], x[:, 1] = 1, y + 0.7 * rng.normal(size=1200)
    chain = crf.fit(x, y, counts)
    lines = crf.Lines(x, np.ones(1200), np.arange(200) * 6, counts)
    assert (chain.viterbi(lines) == y).mean() > 0.97
    assert chain.moves[1, 1] + chain.moves[0, 0] > chain.moves[0, 1] + chain.moves[1, 0]


def test_without_labels_every_line_is_content(spark, frame, edge_rows):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    chain = crf.train(frame(edge_rows), empty)
    assert quality.content_share(chain, ["one\ntwo", "", None]).tolist() == [1.0, 0.0, 0.0]


def test_counts_and_rules_equal_brute_force(spark, frame, edge_rows):
    rows = [*edge_rows, (20, "a b c d e f a b c d e f\n\nx\nx\n \n "), (21, "w " * 40), (22, "a\x1cb\xa0c d\x0be\x0cf " * 3)]
    chain = crf.train(frame(rows), spark.createDataFrame([(8, 1), (21, 0), (None, 1), (3, None)], "doc_id long, quality int"))
    got = quality.quality_rules(frame(rows), chain).collect()
    assert {r["kept_"] for r in got} == {"7"} and len(got) == len(rows)
    want = Counter((r[0], *brute_counts(r[1])) for r in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.content_share >= 0.5)


def test_rules_of_no_documents(frame):
    chain = crf.Chain(np.zeros(3 * crf.FEATURES), np.zeros((2, 2)))
    docs = frame([])
    assert quality.quality_rules(docs, chain).count() == quality.quality_score(docs, chain).count() == 0


def test_very_many_lines_stay_finite():
    chain = crf.Chain(np.full(3 * crf.FEATURES, 0.3), np.array([[9.0, -9], [-9, 9]]))
    lines = crf.line_features(["a line\n" * 50_000])
    assert np.isfinite(chain.marginals(lines)).all() and len(chain.viterbi(lines)) == 50_001


def test_scores_of_edge_cases(frame, edge_rows):
    chain = crf.Chain(np.r_[1.0, np.zeros(3 * crf.FEATURES - 1)], np.zeros((2, 2)))
    got = quality.quality_score(frame(edge_rows), chain).collect()
    assert {r["score_"] for r in got} == {"7"}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert {r.score for r in got if r.doc_id in (1, 2, 3, 9)} == {0.0}


@pytest.fixture(scope="module")
def labelled(spark):
    """The held-out labelled texts by label, and the chain fitted to the others."""
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (queries.table(spark, sf_dir, t) for t in ("documents", "labels"))
    rows = docs.join(labels.where(crf.held_out(F.col("doc_id"))), "doc_id").where("text is not null").select("doc_id", "text", "quality").collect()
    texts = {k: [r.text for r in sorted(rows, key=lambda r: r.doc_id) if r.quality == k and len(r.text.split()) >= 10] for k in (0, 1)}
    return texts, crf.train(docs, labels)


def test_planted_boundaries_are_found(labelled):
    """Lines of a good and a bad text in one document get the label of the text they come from."""
    texts, chain = labelled
    right = total = 0
    for i, good in enumerate(texts[1]):
        bad = texts[0][i % len(texts[0])]
        for parts in ([(good, 1), (bad, 0)], [(bad, 0), (good, 1)], [(bad, 0), (good, 1), (bad, 0)]):
            want = np.concatenate([np.full(t.count("\n") + 1, k) for t, k in parts])
            states = chain.viterbi(crf.line_features(["\n".join(t for t, _ in parts)]))
            right, total = right + (states == want).sum(), total + len(want)
    assert right > 0.9 * total


def test_prose_between_navigation_lines_is_kept(labelled):
    texts, chain = labelled
    menu = "\n".join(["Home | About | Contact", "LOGIN | REGISTER", "Share | Tweet | Pin", "Next >> 2 3 4 5", "$$$ CLICK HERE $$$", "| Menu | Search |"])
    shares = quality.content_share(chain, [f"{menu}\n{t}\n{menu}" for t in texts[1]])
    prose = np.array([len(t) for t in texts[1]]) / np.array([len(t) + 2 * len(menu) + 2 for t in texts[1]])
    assert (shares[prose > 0.6] >= 0.5).all() and (shares[prose > 0.5] > 0).all()


@pytest.mark.parametrize("name", ["op2_quality_rules", "op10_quality_classifier"])
def test_held_out_documents_are_judged_rightly(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    got = queries.QUERIES[name](spark, sf_dir)
    labels = queries.table(spark, sf_dir, "labels").where(crf.held_out(F.col("doc_id")))
    says = F.col("kept").cast("int") if name.startswith("op2") else F.col("predicted")
    right = got.join(labels, "doc_id").where("n_words >= 10" if name.startswith("op2") else "true").agg(
        F.avg((says == F.col("quality")).cast("int"))
    )
    assert right.first()[0] > 0.95
