"""Schema enforcement and the Silver projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calltide.functions.times import NTZ, as_utc

# The core columns of a cleaned request and their types.
CORE_TYPES = {
    "unique_key": "bigint",
    "created_date": NTZ,
    "closed_date": NTZ,
    "agency": "string",
    "agency_name": "string",
    "complaint_type": "string",
    "descriptor": "string",
    "borough": "string",
    "incident_zip": "string",
    "latitude": "double",
    "longitude": "double",
    "status": "string",
}


def missing_columns(df: DataFrame, types: dict[str, str] = CORE_TYPES) -> list[str]:
    """Core columns the input lacks; ``conform`` fills them with NULL."""
    return [c for c in types if c not in df.columns]


def conform(df: DataFrame, types: dict[str, str] = CORE_TYPES, source_tz: str = "UTC") -> DataFrame:
    """Keep and cast the core columns, drop all others.

    Malformed values and NaN become NULL; missing columns become typed NULLs.
    """

    def cast(name: str, kind: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast(kind)
        if kind == NTZ:
            return as_utc(df, name, source_tz)
        value = F.col(name).try_cast(kind)
        return F.when(~F.isnan(value), value) if kind in ("double", "float") else value

    return df.select(*[cast(n, k).alias(n) for n, k in types.items()])


def to_silver(conformed: DataFrame) -> DataFrame:
    """Creation and closing time under their UTC names, plus ``is_closed``."""
    return conformed.withColumns(
        {
            "created_ts_utc": F.col("created_date"),
            "closed_ts_utc": F.col("closed_date"),
            "is_closed": F.col("closed_date").isNotNull(),
        }
    ).drop("created_date", "closed_date")


def enrich_lookup(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join to a lookup table with one row per key.

    No broadcast hint: Spark broadcasts the lookup only when its size statistics
    allow it and otherwise joins by shuffle, splitting skewed keys.
    """
    return df.join(lookup, key, "left")
