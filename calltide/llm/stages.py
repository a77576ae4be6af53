"""The stages of the corpus pipeline: each takes and, but for the last, returns the columns of documents.

A document travels as one column of its own while an operator adds others, so extra columns of any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calltide.llm import crf, decontaminate, mixing, ngram_join, quality, queries, token_binary
from calltide.llm.common import fresh, with_row_id
from calltide.sources.scratch import shared_dir


def _packed(docs: DataFrame) -> DataFrame:
    others = [c for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others).alias("document"), "doc_id", F.col("text").cast("string").alias("text"))


def _unpacked(packed: DataFrame, columns: list[str]) -> DataFrame:
    return packed.select(*[F.col("text") if c == "text" else F.col("document")[c].alias(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    chain = crf.train(docs, queries.table(spark, sf_dir, "labels"))
    found = quality.quality_rules(_packed(docs).drop("doc_id"), chain, keep_text=True)
    return _unpacked(found.where("kept"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    found = ngram_join.jaccard_join(_packed(docs), row_col="document", keep_text=True)
    return _unpacked(found.where("is_first"), docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    found = decontaminate.decontaminate(_packed(docs).drop("doc_id"), queries.table(spark, sf_dir, "benchmark"))
    return _unpacked(found.where(F.size("matches") == 0), docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    row = fresh(docs, "row")
    rows = with_row_id(docs, "documents", row)
    taken = mixing.mix(rows, row_col=row).where("copies > 0").select(F.col(row).alias("taken"), "copies")
    repeated = _packed(rows).join(taken, F.col("document")[row] == F.col("taken"))
    copies = repeated.select("document", "text", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return _unpacked(copies, docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token files and return their index."""
    path = shared_dir(spark, "token-files")
    token_binary.write_token_files(docs, path, queries.vocabulary())
    return token_binary.document_index(token_binary.read_token_files(spark, path))
