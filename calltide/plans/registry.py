"""Named queries over the test tables, each next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with its SQL when there is one."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql.strip()
        return fn

    return register


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Round computed doubles, which differ in the last bits between engines."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# The request view in SQL.
REQ = """req AS (
  SELECT o_orderkey AS unique_key, o_orderdate AS created_date, c_mktsegment AS agency, n_name AS agency_name,
         o_orderpriority AS complaint_type, r_name AS borough, o_orderstatus AS status,
         CASE WHEN o_orderstatus = 'F' THEN last_ship END AS closed_date
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey
)"""

DAILY = """daily AS (
  SELECT CAST(created_date AS DATE) AS ds, complaint_type, borough, agency, count(*) AS y
  FROM req GROUP BY ALL
)"""

TOTAL = """total AS (SELECT ds, CAST(sum(y) AS BIGINT) AS y FROM daily GROUP BY ds)"""

PAIRS = """pairs AS (
  SELECT complaint_type, borough, ds, CAST(sum(y) AS BIGINT) AS y FROM daily GROUP BY ALL
)"""


def with_sql(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def fit_sql(source: str, keys: Sequence[str], train: str = "TRUE") -> str:
    """CTEs m (line per series), e (weekday effects), g (residual spread) for the rows where ``train``."""
    k = "".join(f"{c}, " for c in keys)
    by = ", ".join(keys)
    group = f"GROUP BY {by}" if keys else ""
    using = f"JOIN m USING ({by})" if keys else "CROSS JOIN m"
    using_e = f"USING ({', '.join([*keys, 'dow'])})"
    return f"""
x AS (SELECT *, CAST(ds - DATE '2000-01-01' AS DOUBLE) AS x, dayofweek(ds) AS dow FROM {source}),
m AS (SELECT {k}CASE WHEN var_pop(x) > 0 THEN regr_slope(y, x) ELSE 0 END AS slope,
        CASE WHEN var_pop(x) > 0 THEN regr_intercept(y, x) ELSE avg(y) END AS intercept,
        min(ds) AS first_ds, max(ds) AS last_ds, count(*) AS n_days FROM x WHERE {train} {group}),
r AS (SELECT x.*, y - intercept - slope * x AS rest FROM x {using} WHERE {train}),
e AS (SELECT {k}dow, avg(rest) AS effect FROM r GROUP BY ALL),
g AS (SELECT {k}stddev_samp(rest - effect) AS sigma FROM r JOIN e {using_e} {group})"""


def forecast_sql(keys: Sequence[str], horizon: int, z: float, history: bool = True) -> str:
    """CTE f: forecast rows of the observed days and the horizon from the CTEs of ``fit_sql``."""
    k = "".join(f"{c}, " for c in keys)
    using = f"USING ({', '.join(keys)})" if keys else "ON TRUE"
    observed = f"SELECT {k}slope, intercept, ds, dow FROM m JOIN x {using} UNION ALL " if history else ""
    return f"""
s AS (SELECT *, unnest(generate_series(CAST(last_ds + 1 AS TIMESTAMP), CAST(last_ds + {horizon} AS TIMESTAMP),
        INTERVAL 1 DAY)) AS t FROM m),
d AS ({observed}SELECT {k}slope, intercept, CAST(t AS DATE) AS ds, dayofweek(t) AS dow FROM s),
p AS (SELECT d.*, intercept + slope * CAST(ds - DATE '2000-01-01' AS DOUBLE) + coalesce(effect, 0) AS yhat
      FROM d LEFT JOIN e USING ({', '.join([*keys, 'dow'])})),
f AS (SELECT {k}ds, yhat, yhat - {z!r} * sigma AS yhat_lower, yhat + {z!r} * sigma AS yhat_upper
      FROM p LEFT JOIN g {using})"""


def ols_sql(name: str, source: str, keys: Sequence[str], weekly: bool = True, train: str = "TRUE") -> str:
    """CTEs of a least-squares line with or without weekday effects: ``<name>_x`` (rows), ``_m`` (means), ``_b`` (slope), ``_f`` (yhat), ``_s`` (spread)."""
    by = ", ".join(keys)
    return f"""
{name}_x AS (SELECT *, CAST(ds - DATE '2000-01-01' AS DOUBLE) AS x, {"dayofweek(ds)" if weekly else "0"} AS dow FROM {source}),
{name}_m AS (SELECT {by}, dow, avg(x) AS mx, avg(y) AS my FROM {name}_x WHERE {train} GROUP BY ALL),
{name}_b AS (SELECT {by}, sum((x - mx) * (y - my)) / sum((x - mx) * (x - mx)) AS slope FROM {name}_x JOIN {name}_m USING ({by}, dow) WHERE {train} GROUP BY ALL),
{name}_f AS (SELECT x.*, my + slope * (x - mx) AS yhat FROM {name}_x x JOIN {name}_m USING ({by}, dow) JOIN {name}_b USING ({by})),
{name}_s AS (SELECT {by}, stddev_pop(y - yhat) AS sigma FROM {name}_f WHERE {train} GROUP BY ALL)"""


BOROUGHS = """boroughs AS (SELECT borough, ds, CAST(sum(y) AS BIGINT) AS y FROM daily GROUP BY ALL)"""


def ols_ahead_sql(name: str, horizon: int) -> str:
    """Rows of the ``horizon`` days after each borough's data, forecast by the line called ``name``."""
    dow = f"CASE WHEN (SELECT max(dow) FROM {name}_x) = 0 THEN 0 ELSE dayofweek(ds) END"
    return f"""(SELECT borough, ds, my + slope * (CAST(ds - DATE '2000-01-01' AS DOUBLE) - mx) AS yhat FROM (
      SELECT borough, CAST(t AS DATE) AS ds FROM (SELECT borough, unnest(generate_series(CAST(max(ds) + 1 AS TIMESTAMP),
        CAST(max(ds) + {horizon} AS TIMESTAMP), INTERVAL 1 DAY)) AS t FROM boroughs GROUP BY borough)) d
    JOIN {name}_b USING (borough) JOIN {name}_m m ON m.borough = d.borough AND m.dow = {dow})"""
