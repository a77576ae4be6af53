"""A corpus from documents to token files, in five stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from calltide.llm import stages
from calltide.sources.scratch import scratch, shared_dir

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", stages.quality_rules),
    ("n-gram Jaccard join", stages.near_duplicates),
    ("benchmark decontamination", stages.decontaminated),
    ("mixing sources to target weights", stages.mixed),
    ("token-ID / binary output", stages.token_files),
]

ORACLE_SQL: str | None = None  # labelling, pair search and encoding are not SQL; tests hold them against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again as the next one's input.

    What a stage keeps in between is deleted when its result is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, name.replace(" ", "-").replace("/", "-"))
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
