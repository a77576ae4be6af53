"""Run registered queries against DuckDB: python -m tests.compare [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

import __spark_entry__ as entry

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if value is None or value is pd.NaT or value != value:
        return None
    if isinstance(value, float):
        return round(value, 9) + 0.0
    return str(value) if not isinstance(value, (bool, int)) else value


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda t: tuple((v is None, str(v)) for v in t))


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when Spark and DuckDB agree, else the first difference."""
    df = entry.queries()[name](spark, sf_dir)
    got = normal(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = normal(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g} != {w}"
    kinds = [f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields]
    if any(k.endswith(":timestamp") for k in kinds):
        return f"zoned timestamp in {kinds}"
    return None if got else "no rows"


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        checked = "sql" if name in entry.oracle_sql() else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {name} [{checked}] {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree; root {Path(sf_dir).name}")


if __name__ == "__main__":
    main()
