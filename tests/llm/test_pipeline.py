import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from calltide.llm import mixing, stages
from calltide.sources.scratch import shared_dir
from tests.llm.test_dedup import brute_classes
from tests.llm.test_quality import brute_counts

SMALLEST = "/root/testdata/sf0.001"
words = re.compile(r"\w+").findall


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage returned, by the stage's name, after ``documents``."""
    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = shared_dir(spark, "stage")
        stage(spark, docs, SMALLEST).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_return_the_columns_of_documents(kept):
    names = list(kept)
    assert names[1:] == [n for n, _ in corpus_pipeline.STAGES] and len(names) == 6
    for name in names[:-1]:
        assert kept[name].dtypes == kept["documents"].dtypes


def test_quality_stage_keeps_what_passes(kept, spark):
    before, after = texts(kept["documents"]), {d for d, _ in texts(kept["quality rules"])}
    failed = {d for d, t in before for n in [brute_counts(t)] if n[0] < 10 or 100 * n[4] > 20 * n[0]}
    assert not failed & after
    good = {r.doc_id for r in spark.read.parquet(f"{SMALLEST}/labels.parquet").where("quality = 1").collect()} - failed
    assert len(good & after) >= 0.98 * len(good)


def test_one_document_of_each_class_stays(kept):
    rows = texts(kept["quality rules"])
    want = Counter(min(c for d, c, _, _ in brute_classes(rows) if d == doc) for doc, *_ in rows)
    assert Counter(d for d, _ in texts(kept["n-gram Jaccard join"])) == Counter(set(want))


def test_benchmark_passages_go(kept, spark):
    items = [" ".join(words(r.text.lower())) for r in spark.read.parquet(f"{SMALLEST}/benchmark.parquet").collect()]
    leaks = lambda name: {d for d, t in texts(kept[name]) if any(i in " ".join(words(t.lower())) for i in items)}
    before, after = leaks("n-gram Jaccard join"), {d for d, _ in texts(kept["benchmark decontamination"])}
    assert after == {d for d, _ in texts(kept["n-gram Jaccard join"])} - before


def test_mix_repeats_documents(kept):
    taken = mixing.mix(kept["benchmark decontamination"]).collect()
    assert Counter(d for d, _ in texts(kept["mixing sources to target weights"])) == Counter(
        {r.doc_id: r.copies for r in taken if r.copies}
    )


def test_token_files_hold_every_copy(kept):
    index = kept["token-ID / binary output"]
    assert Counter(r.doc_id for r in index.collect()) == Counter(d for d, _ in texts(kept["mixing sources to target weights"]))


def test_run_gives_the_last_stage(kept, spark):
    got = corpus_pipeline.run(spark, SMALLEST)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, kept["token-ID / binary output"].collect()))


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_take_edge_cases(frame, edge_rows, spark, stage):
    rows = [*edge_rows, *((100 + i, f"document {i} tells of rivers, roads and of winter nights number {i}; nothing else happens in it.") for i in range(20))]
    got = stage(spark, frame(rows), SMALLEST)
    if stage is not stages.token_files:
        assert got.columns == frame(rows).columns
    assert got.where(F.col("doc_id") >= 100).count() >= 10
    assert stage(spark, frame([]), SMALLEST).count() == 0
