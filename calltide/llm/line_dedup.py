"""Removal of repeated runs of lines, found by overlapping windows of three."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calltide.llm.common import staged, with_row_id

WINDOW = 3


def _key(text: Column) -> Column:
    """128 bits of a text: two seeded 64-bit hashes."""
    return F.struct(F.xxhash64(F.lit(1), text).alias("x"), F.xxhash64(F.lit(2), text).alias("y"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, row_col: str | None = None
) -> DataFrame:
    """Remove later occurrences of runs of ``window`` lines: ``doc_id, n_lines, n_removed, n_spans, kept``.

    Lines are what stands between line feeds. A window of consecutive lines repeats if the same lines stand at an earlier
    place, by (doc_id, row, line); all lines that a later occurrence covers go, overlapping ones as one span. Windows are
    judged on the input. ``kept`` is the rest, joined by line feeds; it is empty if all lines go. NULL texts have no lines
    and stay NULL, texts of fewer lines than the window stay as they are. NULL ids come first; rows that agree in
    everything are interchangeable. Windows are counted before they are joined back, and a frequent one is split by
    adaptive execution, which needs the counts as a table of their own. With ``row_col`` the result has that column as well.
    """
    given = [F.col(row_col).alias("__given")] if row_col else []
    rows = with_row_id(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *given), "lines", "__row"
    )
    lines = F.split("text", "\n", -1)
    starts = F.sequence(F.lit(0), F.size("lines") - window)
    windows = (
        rows.select("doc_id", "__row", lines.alias("lines")).where(F.size("lines") >= window)
        .select("doc_id", "__row", F.posexplode(
            F.transform(starts, lambda i: _key(F.concat_ws("\n", F.slice("lines", i + 1, window))))
        ).alias("line", "key"))
        .select("doc_id", "__row", "line", "key.x", "key.y")
    )
    repeated = staged(
        windows.groupBy("x", "y")
        .agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "__row", "line")).alias("first"))
        .where("n > 1")
        .select(F.col("x").alias("rx"), F.col("y").alias("ry"), F.col("first.__row").alias("row"), F.col("first.line").alias("at")),
        "windows",
    )
    later = (
        windows.join(repeated, (F.col("x") == F.col("rx")) & (F.col("y") == F.col("ry")))
        .where((F.col("__row") != F.col("row")) | (F.col("line") != F.col("at")))
        .select("__row", "line")
    )
    in_row = Window.partitionBy("__row").orderBy("line")
    apart = F.coalesce(F.col("line") > F.lag("line").over(in_row) + window, F.lit(True))
    spans = (
        later.withColumn("apart", apart.cast("int"))
        .withColumn("span", F.sum("apart").over(in_row))
        .groupBy("__row", "span")
        .agg(F.min("line").alias("since"), (F.max("line") + window).alias("until"))
        .groupBy(F.col("__row").alias("r"))
        .agg(F.array_sort(F.collect_list(F.struct("since", "until"))).alias("spans"))
    )
    joined = rows.join(spans, rows["__row"] == spans.r, "left").withColumn("lines", lines)
    n = F.size("spans")

    def gap(i: Column) -> Column:
        """The lines between two spans."""
        since = F.when(i == 0, 0).otherwise(F.get("spans", i - 1)["until"])
        until = F.when(i == n, F.size("lines")).otherwise(F.get("spans", i)["since"])
        return F.slice("lines", since + 1, until - since)

    kept = F.concat_ws("\n", F.flatten(F.transform(F.sequence(F.lit(0), n), gap)))
    removed = F.aggregate("spans", F.lit(0), lambda total, x: total + x["until"] - x["since"])
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return joined.select(
        "doc_id", count(F.size("lines")).alias("n_lines"), count(removed).alias("n_removed"), count(n).alias("n_spans"),
        F.when(F.col("spans").isNull(), F.col("text")).otherwise(kept).alias("kept"),
        *([F.col("__given").alias(row_col)] if row_col else []),
    )
