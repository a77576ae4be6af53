"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from calltide.llm.common import WORD, keyed_hash, staged, tasks, with_row_id

WEIGHTS = (3, 1, 2)  # by source in ascending order, repeating
SHARE = 1.5  # words of the mix as a share of all words
MAX_EPOCHS = 2.0
BUCKETS = 256  # hash ranges a source is cut into at each level
LEVELS = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """Append ``rank``: the place of each source by code point, NULL last, counted from 0.

    Sources are cut into ranges first; only one count per range meets in one task.
    """
    n = tasks(sources)
    ordered = staged(
        sources.withColumn("no_source", F.col("source").isNull())
        .repartitionByRange(n, "no_source", "source")
        .withColumn("range", F.spark_partition_id()),
        "sources",
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = ordered.groupBy("range").agg(F.count("*").alias("n")).select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("range").orderBy("no_source", "source")
    return (
        ordered.withColumn("at", F.row_number().over(inside) - 1)
        .join(base, "range")
        .withColumn("rank", F.col("base") + F.col("at"))
        .drop("no_source", "range", "base", "at")
    )


def water_fill(sources: DataFrame, total: float, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Append ``target`` to ``sources(source_size, weight, ...)``.

    Every round shares what is left by weight among the sources below their cap and clamps those that would pass it, until
    none does. Only two sums per round reach the driver. If all sources are clamped, the mix is smaller than ``total``.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    clamped, level = F.lit(False), 0.0
    while True:
        left, weight, n = sources.agg(
            F.lit(float(total)) - F.coalesce(F.sum(F.when(clamped, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~clamped, F.col("weight"))), F.lit(0)).cast("double"),
            F.count(F.when(clamped, True)),
        ).first()
        level = max(left, 0.0) / weight if weight else float("inf")
        above = cap < F.col("weight") * F.lit(level)
        if not weight or sources.where(above & ~clamped).isEmpty():
            break
        clamped = above
    return sources.withColumn("target", F.when(clamped, cap).otherwise(F.col("weight") * F.lit(level)))


def _up_to(cut: Column, row: str) -> Column:
    """Whether a row comes before a cut or at it; a cut without an edge takes all rows."""
    before = F.coalesce(F.struct("h", "doc_id", row) <= cut["last"], F.lit(False))
    for j in reversed(range(LEVELS)):
        before = (F.col(f"b{j}") < cut[f"e{j}"]) | ((F.col(f"b{j}") == cut[f"e{j}"]) & before)
    return cut["e0"].isNull() | before


def _cut(pool: DataFrame, row: str) -> DataFrame:
    """Where the gap of each source of ``pool`` is used up: hash ranges ``e0, e1, ...`` and the last row in them that fits.

    Sources whose rows all fit are left out.
    """
    # For each level: the hash range in which the gap is used up, and what is left on entering it.
    edge = None
    for i in range(LEVELS):
        held = [f"e{j}" for j in range(i)]
        inside = pool.withColumn("left", F.col("gap")) if edge is None else _at(pool, edge, i)
        sums = inside.groupBy("source", "left", *held, f"b{i}").agg(F.sum("size").alias("size"))
        upto = Window.partitionBy("source").orderBy(f"b{i}")
        sums = sums.withColumn("upto", F.sum("size").over(upto)).where(F.col("upto") > F.col("left"))
        edge = staged(
            sums.groupBy("source", "left", *held)
            .agg(F.min(F.struct(f"b{i}", "upto", "size")).alias("at"))
            .select("source", (F.col("left") - F.col("at.upto") + F.col("at.size")).alias("left"), *held, F.col(f"at.b{i}").alias(f"e{i}")),
            "edges",
        )
    order = Window.partitionBy("source").orderBy("h", "doc_id", row)
    fits = _at(pool, edge, LEVELS).withColumn("upto", F.sum("size").over(order)).where(F.col("upto") <= F.col("left"))
    last = fits.groupBy("source").agg(F.max(F.struct("h", "doc_id", row)).alias("last")).withColumnRenamed("source", "t")
    return edge.drop("left").join(last, edge.source.eqNullSafe(last.t), "left").drop("t")


def _at(pool: DataFrame, edge: DataFrame, levels: int) -> DataFrame:
    """Rows of the edge range of their source, with ``left``."""
    inside = pool.join(edge, pool.source.eqNullSafe(edge.source)).drop(edge.source)
    for j in range(levels):
        inside = inside.where(F.col(f"b{j}") == F.col(f"e{j}"))
    return inside


def _cuts(keyed: DataFrame, gaps: DataFrame, row: str) -> DataFrame:
    """Rounds in which documents fill the gap of each source in hash order, leaving out those that do not fit.

    ``source, cuts``: a round takes the rows no larger than the gap on entering it, up to its cut. What is left is smaller
    than the row that did not fit, so the next round looks among the smaller rows only, until none is left that fits. The
    rows that end rounds have ever smaller sizes in a random order, so rounds grow with the logarithm of the rows.
    """
    at, found = 0, None
    pool = keyed
    while True:
        fitting = pool.join(gaps.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        pool = staged(fitting.where((F.col("gap") > 0) & (F.col("size") <= F.col("gap"))), "pool")
        if at and pool.isEmpty():
            break
        edges = _cut(pool, row).withColumnRenamed("source", "s")
        held = gaps.where("gap > 0").join(edges, gaps.source.eqNullSafe(F.col("s")), "left").drop("s")
        cuts = staged(held.withColumn("round", F.lit(at)), "cuts")
        found = cuts if found is None else found.unionByName(cuts)
        cut = F.struct(*(f"e{j}" for j in range(LEVELS)), "last")
        now = cuts.select(F.col("source").alias("s"), cut.alias("cut"))
        marked = pool.join(now, pool.source.eqNullSafe(now.s)).withColumn("taken", _up_to(F.col("cut"), row)).drop("s", "cut")
        spent = marked.where("taken").groupBy(F.col("source").alias("s")).agg(F.sum("size").alias("spent"))
        gaps = staged(
            gaps.join(spent, gaps.source.eqNullSafe(spent.s), "left")
            .select("source", (F.col("gap") - F.coalesce("spent", F.lit(0))).alias("gap")),
            "gaps",
        )
        pool = marked.where("not taken and size > 0").drop("taken", "gap")
        at += 1
    fields = ["round", "gap", *(f"e{j}" for j in range(LEVELS)), "last"]
    return found.groupBy("source").agg(F.collect_list(F.struct(*fields)).alias("cuts"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS, seed: int = 7,
    row_col: str | None = None,
) -> DataFrame:
    """How often each document enters the mix: ``doc_id, source, size, source_size, target, copies, taken``.

    The sources' targets share ``share`` of all words by weight and stop at ``max_epochs`` times the source's words, the
    excess being shared anew. A source with a target of e epochs gives each document floor(e) whole times; the rest of the
    target is filled with documents in a seeded hash order, leaving out those that no longer fit, and then the one document
    that comes nearest to what is still missing. The order is found by sums over hash ranges (two levels), so no task ever
    holds a source, even if its rows have no id. NULL sources are one source, last in order; NULL or wordless texts have size 0. Rows
    with the same id and size are interchangeable, and equal ids are ordered by their row. With ``row_col`` the result has that column as well.
    """
    row = "__row"
    given = [F.col(row_col).alias("__given")] if row_col else []
    sized = with_row_id(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col).cast("string")).alias("size"), F.xxhash64(F.col(text_col).cast("string")).alias("__text"), *given,
        ),
        "sizes", row,
    )
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    n = len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % n + 1).cast("int"))
    sources = staged(ranked(per_source).withColumn("weight", weight), "ranks")
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    plan = staged(
        water_fill(sources, share * words, max_epochs)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .select("source", "source_size", "target", "whole", "rest"),
        "targets",
    )
    # Rows without an id would share a hash with all of their size: their text and number tell them apart.
    h = F.when(
        F.col("doc_id").isNull(), keyed_hash(F.col("size"), F.col("__text"), F.col(row), seed=seed)
    ).otherwise(keyed_hash(F.col("doc_id"), F.col("size"), seed=seed))
    parts = [F.pmod(F.shiftrightunsigned(h, 16 * i), F.lit(BUCKETS)).cast("int").alias(f"b{i}") for i in range(LEVELS)]
    keyed = sized.select("*", *parts, h.alias("h")).drop("__text")

    cuts = _cuts(keyed, plan.select("source", F.col("rest").alias("gap")), row).withColumnRenamed("source", "s")
    taken = F.exists("cuts", lambda c: (F.col("size") <= c["gap"]) & ((F.col("size") > 0) | (c["round"] == 0)) & _up_to(c, row))
    targets = plan.join(cuts, plan.source.eqNullSafe(cuts.s), "left").drop("s")
    chosen = (
        keyed.join(targets, keyed.source.eqNullSafe(targets.source), "left").drop(targets.source)
        .withColumn("extra", F.coalesce(taken, F.lit(False)))
        .drop("cuts", "h", *(f"b{j}" for j in range(LEVELS)))
    )
    chosen = staged(chosen, "chosen")
    filled = chosen.where("extra").groupBy("source").agg(F.sum("size").alias("filled"))
    gap = plan.join(filled, plan.source.eqNullSafe(filled.source), "left").select(
        plan.source.alias("s"), (F.col("rest") - F.coalesce("filled", F.lit(0))).alias("gap")
    )
    near = (
        chosen.where("not extra and size > 0")
        .join(gap, chosen.source.eqNullSafe(gap.s))
        .where(F.abs(F.col("size") - F.col("gap")) < F.col("gap"))
        .groupBy("source")
        .agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), F.col("doc_id"), F.col(row))).alias("best"))
        .select(F.col(f"best.{row}").alias("r"))
    )
    done = chosen.join(near, chosen[row] == near.r, "left").withColumn("extra", F.col("extra") | F.col("r").isNotNull())
    copies = (F.col("whole") + F.col("extra").cast("long")).alias("copies")
    return done.select(
        "doc_id", "source", "size", "source_size", "target", copies, (F.col("size") * (F.col("whole") + F.col("extra").cast("long"))).alias("taken"),
        *([F.col("__given").alias(row_col)] if row_col else []),
    )
