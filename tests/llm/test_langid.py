from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from calltide.llm import langid, queries

SMALLEST = "/root/testdata/sf0.001"


def test_held_out_documents_get_their_language(spark):
    got = queries.op9_language_id(spark, SMALLEST).where("held_out").join(
        queries.table(spark, SMALLEST, "documents").where("lang is not null"), "doc_id"
    )
    assert got.count() > 20 and got.where("lang_pred <> lang").count() <= 0.05 * got.count()


def test_edge_cases(frame, edge_rows, spark):
    filters = langid.learn(queries.table(spark, SMALLEST, "documents"))
    got = langid.identify(frame(edge_rows), filters).collect()
    assert {r["score_"] for r in got} == {"7"} and len(got) == len(edge_rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert {by[i].lang_pred for i in (1, 2, 3, 4, 9)} == {"und"} and by[5].lang_pred in filters.languages
    assert by[6].lang_pred == "en"


def test_nothing_learned_or_asked(frame):
    filters = langid.learn(frame([(1, None), (2, "text", None)]))
    assert filters.languages == []
    assert [r.lang_pred for r in langid.identify(frame([(1, "text")]).select("doc_id", "text"), filters).collect()] == ["und"]
    assert langid.identify(frame([]).select("doc_id", "text"), filters).count() == 0


def test_many_languages_need_more_words(spark):
    """Forty alphabets of their own, each learned from a few texts."""
    rows = [(k * 10 + i, " ".join(chr(0x4E00 + 50 * k + (i * j * 7 + j) % 50) * 3 for j in range(60)), f"l{k:02}") for k in range(40) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = langid.learn(docs)
    assert filters.slots.shape[1] == 2
    got = langid.identify(docs.select("doc_id", "text", "lang"), filters)
    assert got.where(F.col("lang") != F.col("lang_pred")).count() == 0


def test_false_hits_are_corrected():
    full = langid.Filters(["a", "b"], __import__("numpy").full((langid.SLOTS, 1), 3, "uint32"), "b", __import__("numpy").ones(2))
    names, scores = full.predict(["some words", None])
    assert names[1] == "und" and 0 <= scores[0] <= 1


def grams_of(text):
    shown = "  " + "".join(c if c.isalpha() else " " for c in (text or "").lower()) + "  "
    return [shown[i : i + langid.N] for i in range(len(shown) - langid.N + 1) if shown[i + 1] != " "]


def test_predictions_equal_exact_sets(frame, edge_rows, spark):
    """The same rule with sets of n-grams in place of Bloom filters: languages agree, scores but for chance hits."""
    docs = queries.table(spark, SMALLEST, "documents").select("doc_id", "text", "lang")
    rows = docs.collect()
    counts = defaultdict(Counter)
    for r in rows:
        if r.text is not None and r.lang is not None:
            counts[r.lang].update(grams_of(r.text))
    totals = {lang: sum(c.values()) for lang, c in counts.items()}
    most = Counter()
    for lang, c in counts.items():
        for g, n in c.items():
            most[g] = max(most[g], n / totals[lang])
    held = {
        lang: {g for g, n in c.items() if n >= langid.MIN_COUNT and n / totals[lang] >= langid.MIN_SHARE * most[g]} for lang, c in counts.items()
    }
    languages = sorted(held)
    texts = rows + [r for r in frame(edge_rows).select("doc_id", "text").collect() if r.doc_id != 5]
    filters = langid.learn(docs)
    assert filters.languages == languages
    names, scores = filters.predict([r.text for r in texts])
    for r, name, score in zip(texts, names, scores):
        hits = np.array([sum(g in held[lang] for g in grams_of(r.text)) for lang in languages], float)
        if not any(c.isalpha() for c in r.text or ""):
            assert (name, score) == ("und", 0)
        elif hits.any():
            assert hits[languages.index(name)] >= hits.max() - 2 and abs(score - hits.max() / hits.sum()) < 0.05
