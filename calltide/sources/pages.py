"""Landed raw pages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from calltide.functions.columns import normalize_columns
from calltide.functions.times import as_utc


def _folded(name: Column) -> Column:
    return F.replace(F.lower(F.regexp_replace(name, r"^\s+|\s+$", "")), F.lit(" "), F.lit("_"))


def _records(spark: SparkSession, path: str | list[str], multiline: bool) -> DataFrame:
    """One row per record, ``fields`` being its names and values, or the ``raw`` text of what is no record.

    A page is an array of records or a single one. It is a line of a file, or
    with ``multiline`` a whole file.
    """
    pages = spark.read.text(path, wholetext=multiline).filter(F.length(F.trim("value")) > 0)
    record = T.MapType(T.StringType(), T.StringType())
    is_array = F.col("value").rlike(r"^\s*\[")
    listed = F.when(is_array, F.from_json("value", T.ArrayType(T.StringType()))).otherwise(F.array("value"))
    # Each element of an array is parsed alone, so one bad record does not take its page along.
    texts = pages.select(F.explode(F.coalesce(listed, F.array("value"))).alias("raw"))
    entries = F.map_entries(F.from_json("raw", record, {"mode": "PERMISSIVE"}))
    is_record = F.col("raw").rlike(r"^\s*\{") & F.try_parse_json("raw").isNotNull()
    return texts.select("raw", F.when(is_record, entries).alias("fields"))


def _named(fields: str, column: str) -> Column:
    """The entries of a record whose normalised name is that of a column."""
    return F.filter(fields, lambda e: _folded(e["key"]) == F.lit(column))


def _clashes(columns: Sequence[str]) -> Column:
    return F.greatest(*[F.size(_named("fields", c)) for c in columns], F.lit(0)) > 1


_CORRUPT = "__corrupt"


def _exact(spark: SparkSession, path: str | list[str], columns: Sequence[str], multiline: bool) -> DataFrame:
    """Records by the given names, and the text of what cannot be parsed."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, _CORRUPT)])
    reader = spark.read.schema(schema).option("multiLine", multiline).option("columnNameOfCorruptRecord", _CORRUPT)
    return reader.json(path)


def read_landed_pages(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    fold_names: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Read JSON page files as text columns in one scan.

    Every file, or split of a large one, is a task, so there is no page loop. A
    page is an array of records or one record, on a line or, with
    ``multiline``, filling a whole file with any layout. A record without a
    column gives NULL; empty files give no rows. What is no record is left out
    here and returned by ``landed_rejects``.

    With ``fold_names`` the given columns are normalised names and each record's
    own names are normalised before the match, for pages whose headings differ
    in case or spacing; a record that names a column twice is rejected too.
    Without ``columns`` the names are found by a first pass
    over the files.
    """
    if columns is None:
        return spark.read.option("primitivesAsString", True).option("multiLine", multiline).json(path)
    if not fold_names:
        return _exact(spark, path, columns, multiline).filter(F.col(_CORRUPT).isNull()).drop(_CORRUPT)
    records = _records(spark, path, multiline).filter(F.col("fields").isNotNull() & ~_clashes(columns))
    return records.select(*[F.get(_named("fields", c), F.lit(0))["value"].alias(c) for c in columns])


def landed_rejects(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], fold_names: bool = False, multiline: bool = False
) -> DataFrame:
    """Raw text and reason of the records ``read_landed_pages`` leaves out."""
    if not fold_names:
        corrupt = _exact(spark, path, columns, multiline).select(*columns, F.col(_CORRUPT).alias("raw")).filter("raw IS NOT NULL")
        return corrupt.select("raw", F.lit("no record").alias("reason"))
    records = _records(spark, path, multiline)
    reason = F.when(F.col("fields").isNull(), "no record").when(_clashes(columns), "name given twice")
    return records.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select("raw", "reason")


def union_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """Stack pages by normalised column name; a column missing from a page is NULL there."""
    named = [normalize_columns(page) for page in pages]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def add_received_parts(df: DataFrame, created: str = "created_date") -> DataFrame:
    """Add ``received_year`` and ``received_month`` when the table has a creation time."""
    if created not in df.columns:
        return df
    ts = as_utc(df, created)
    return df.withColumns({"received_year": F.year(ts), "received_month": F.month(ts)})


def stamp_ingestion(df: DataFrame, as_of: str) -> DataFrame:
    """Add the ``ingestion_date`` of this load."""
    return df.withColumn("ingestion_date", F.lit(str(as_of)[:10]).cast("date"))


def raw_to_bronze(raw: DataFrame, as_of: str) -> DataFrame:
    """Normalised names, received parts and the load date, before deduplication."""
    return stamp_ingestion(add_received_parts(normalize_columns(raw)), as_of)
