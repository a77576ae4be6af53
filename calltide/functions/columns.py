"""Column names, missing columns and null-safe series joins."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip, lower-case and underscore the column names; clashes raise."""
    names = [c.strip().lower().replace(" ", "_") for c in df.columns]
    clashes = sorted(n for n, k in Counter(names).items() if k > 1)
    if clashes:
        raise ValueError(f"column names clash after normalisation: {clashes}")
    return df.toDF(*names)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating-point column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def join_series(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL key values match each other.

    A NULL complaint type or borough is a series of its own, as in GROUP BY.
    """
    renamed = {k: f"__right_{k}" for k in keys}
    other = right.withColumnsRenamed(renamed)
    on = all_of([left[k].eqNullSafe(other[renamed[k]]) for k in keys])
    return left.join(other, on, how).drop(*renamed.values())
