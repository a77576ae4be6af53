"""The registered queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calltide.llm import (
    crf, decontaminate, divergence, hard_negatives, langid, line_dedup, mixing, ngram_join, odd_sketch, quality, suffix_dedup,
    token_binary, token_counts,
)
from calltide.sources.scratch import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of an installed public vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query()
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query(
    r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, unnest(range(0, len(lines) - 2)) AS line, lines FROM l WHERE len(lines) >= 3),
k AS (SELECT doc_id, line, array_to_string(lines[line + 1:line + 3], chr(10)) AS key FROM w),
f AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, line) AS nth FROM k),
gone AS (SELECT DISTINCT doc_id, unnest([line, line + 1, line + 2]) AS line FROM f WHERE nth > 1),
cut AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY line) AS before FROM gone),
n AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (before IS NULL OR before < line - 1) AS n_spans FROM cut GROUP BY ALL),
kept AS (
  SELECT doc_id, string_agg(t, chr(10) ORDER BY i) AS kept
  FROM (SELECT doc_id, unnest(lines) AS t, unnest(range(0, len(lines))) AS i FROM l) x
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = x.doc_id AND g.line = x.i) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  CASE WHEN text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256
FROM l LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", "n_spans", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


@query()
def op6_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-files")
    token_binary.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary())
    return token_binary.document_index(token_binary.read_token_files(spark, path))


def chain(spark: SparkSession, sf_dir: str) -> crf.Chain:
    """The line model, fitted to the labelled documents outside the held-out fold."""
    return crf.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, end_id = shared_dir(spark, "flat-tokens"), 49_408  # one above the vocabulary
    token_counts.write_flat(table(spark, sf_dir, "documents"), path, vocabulary(), end_id)
    blocks = spark.read.schema(token_counts.BLOCK_SCHEMA).parquet(path)
    return token_counts.scan(blocks, end_id).select("doc_id", "n_tokens")


@query()
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality_rules(docs, chain(spark, sf_dir))


@query()
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", (F.size("matches") > 0).alias("contaminated"), F.get("matches", F.lit(0))["item_id"].alias("item_id"),
        F.get("matches", F.lit(0))["coverage"].alias("coverage"), F.size("matches").alias("n_items"),
        (F.size("matches") == 0).alias("kept"),
    )


@query(
    r"""
WITH RECURSIVE t AS (
  SELECT text, min(doc_id) AS rep, count(*) AS n_copies,
    regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL GROUP BY text),
s AS (SELECT DISTINCT rep, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT rep, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT rep, count(*) AS n FROM s GROUP BY rep),
p AS (SELECT a.rep AS a, b.rep AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.rep <> b.rep GROUP BY ALL),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.rep = p.a JOIN n y ON y.rep = p.b
  WHERE shared >= 0.8 * (x.n + y.n - shared) - 1e-9),
r(a, b) AS (SELECT rep, rep FROM t UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS rep, min(b) AS class_id FROM r GROUP BY a),
l AS (SELECT a AS rep, count(*) AS n_links FROM e GROUP BY a)
SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links,
  CAST(coalesce(n_copies, 1) AS BIGINT) AS n_copies
FROM documents d LEFT JOIN t USING (text) LEFT JOIN c USING (rep) LEFT JOIN l USING (rep)
"""
)
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents")).drop("is_first")


@query()
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents"), kept="sha256")
    return found.withColumn("kept_sha256", F.lower(F.hex("kept"))).drop("kept")


@query()
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = langid.learn(docs.where(~crf.held_out(F.col("doc_id"))))
    found = langid.identify(docs.select("doc_id", "text"), filters)
    return found.select("doc_id", crf.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query()
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.quality_score(docs, chain(spark, sf_dir))
    return found.select("doc_id", crf.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query(
    r"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id NULLS LAST, b) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.id NULLS LAST, n.b) AS INTEGER) AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.id NULLS LAST, n.b) <= 10
"""
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_negatives(rows.withColumn("label", moved), "vec_id", "label", "embedding", F.col("vec_id") % 100 == 0)


@query(
    r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT doc) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT x.lang, x.source, coalesce(n, 0) AS n, coalesce(v, 0) AS v FROM (SELECT DISTINCT lang, source FROM d) x
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) USING (lang, source)
  LEFT JOIN (SELECT lang, count(*) AS v FROM k GROUP BY ALL) USING (lang)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * g.v) AS p
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT k.lang, k.term, 1 + (1000000000::HUGEINT * (t.n + 2)) // (l.n + 2 * l.v) AS q
  FROM k JOIN (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL) t USING (lang, term)
  JOIN (SELECT lang, sum(n) AS n, max(v) AS v FROM g GROUP BY ALL) l USING (lang)),
pair AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS f
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) f
  ON f.lang = x.lang AND f.source = x.source AND f.item = y.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 10
"""
)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


@query(
    r"""
WITH RECURSIVE t AS (
  SELECT text, min(doc_id) AS rep, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM (
    SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents WHERE text IS NOT NULL)
  GROUP BY text),
s AS (SELECT DISTINCT rep, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT rep, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT rep, count(*) AS n FROM s GROUP BY rep),
p AS (SELECT a.rep AS a, b.rep AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.rep <> b.rep GROUP BY ALL),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.rep = p.a JOIN n y ON y.rep = p.b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
r(a, b) AS (SELECT rep, rep FROM t UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS rep, min(b) AS component_id FROM r GROUP BY a),
d AS (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
f AS (SELECT doc_id, coalesce(n, 0) AS n_shingles, CASE WHEN n IS NULL THEN doc_id ELSE component_id END AS component_id
  FROM d LEFT JOIN t USING (text) LEFT JOIN n USING (rep) LEFT JOIN c USING (rep))
SELECT *, doc_id = component_id AS kept FROM f
"""
)
def op13_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents"))
