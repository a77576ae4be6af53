"""Keyed deduplication and upsert on DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from calltide.functions.columns import any_null

_UNORDERED = (T.MapType, T.VariantType)
FEW_KEYS = 20_000  # that Spark may send to every task, two to five MB of the driver's memory


def _apart(keys: Sequence[str]) -> Column:
    """NULL for a row with a whole key, a number of its own for any other row."""
    return F.when(any_null(keys), F.monotonically_increasing_id())


def dedup_latest(
    df: DataFrame, keys: Sequence[str], latest_by: Sequence[str], null_keys: str = "keep", one_pass: bool = True
) -> DataFrame:
    """One row per key: the latest by ``latest_by``, ties broken by all other columns.

    The row is the greatest struct of a key, an aggregate that Spark combines
    inside each input partition before the shuffle: a key that holds a third of
    all rows reaches its reducer as one row per input partition (the rows are
    sorted by key for it on both sides of the shuffle). NULL counts as the
    smallest value. NULL is not a key: such rows are all kept, or all dropped
    with ``null_keys="drop"``. Each is a group of its own in the same pass;
    without ``one_pass`` they are looked up apart instead, which is faster on
    stored files, whose statistics answer that filter, and reads any other
    ``df`` twice. Without ``latest_by`` the other columns alone decide.
    """
    others = [f for f in df.schema.fields if f.name not in (*keys, *latest_by)]
    unordered = [f.name for f in others if isinstance(f.dataType, _UNORDERED)]
    ordered = [*latest_by, *[f.name for f in others if f.name not in unordered]]
    order = F.struct(*ordered) if ordered else F.struct(F.lit(1).alias("__one"))
    newest = [F.max(order).alias("__newest")]
    if unordered:
        newest.append(F.max_by(F.struct(*unordered), order).alias("__with"))
    if null_keys == "keep" and one_pass:
        grouped = df.withColumn("__apart", _apart(keys)).groupBy(*keys, "__apart").agg(*newest)
    else:
        grouped = df.filter(~any_null(keys)).groupBy(*keys).agg(*newest)
    found = grouped.select(*keys, "__newest.*", *(["__with.*"] if unordered else [])).select(*df.columns)
    return found if null_keys == "drop" or one_pass else found.unionByName(df.filter(any_null(keys)))


def sized(keys: DataFrame, n: int) -> DataFrame:
    """The ``n`` keys to join a large table with, to be shuffled when they are more than a few.

    Spark takes stored keys for as small as their share of the files, and would
    send millions of well compressed ones through the driver to every task.
    """
    return keys.hint("merge") if n > FEW_KEYS else keys


def _unmatched(target: DataFrame, staged: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Target rows whose key is not staged, in one pass over the target.

    NULL keys never match; a number of their own joins the key, so that those
    rows spread over the reducers.
    """
    # Always -1, but not a literal, which the optimizer would take out of the join key.
    whole = (F.pmod(F.hash(*keys), F.lit(1)) - 1).cast("bigint")
    staged_keys = staged.filter(~any_null(keys)).select(*keys, whole.alias("__apart"))
    apart = target.withColumn("__apart", F.coalesce(_apart(keys), F.lit(-1).cast("bigint")))
    return apart.join(sized(staged_keys, n), [*keys, "__apart"], "left_anti").select(*target.columns)


def _comparable(value: Column, kind: T.DataType) -> Column:
    """The value with maps as sorted entries and variants as JSON with their type, so that ``=`` and hashes take it."""
    if isinstance(kind, T.VariantType):
        # A NULL of its own type for a missing variant, which differs from the JSON null.
        return F.when(value.isNotNull(), F.struct(F.to_json(value).alias("json"), F.schema_of_variant(value).alias("type")))
    if isinstance(kind, T.MapType):
        entry = lambda e: F.struct(
            _comparable(e["key"], kind.keyType).alias("key"), _comparable(e["value"], kind.valueType).alias("value")
        )
        return F.sort_array(F.transform(F.map_entries(value), entry))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: _comparable(v, kind.elementType)) if _holds_unordered(kind) else value
    if isinstance(kind, T.StructType) and _holds_unordered(kind):
        fields = [_comparable(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def _holds_unordered(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_unordered(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_unordered(f.dataType) for f in kind.fields)
    return isinstance(kind, _UNORDERED)


def _new_rows(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows without those of NULL key that the target holds already, equal in all columns.

    A hash finds candidates and the rows themselves decide, NULL being a value
    too: the hash skips NULLs. Columns the target lacks are NULL on its rows.
    """
    kinds = {f.name: f.dataType for f in staged.schema.fields}
    stored = target.select("*", *[F.lit(None).cast(k).alias(c) for c, k in kinds.items() if c not in target.columns])
    row = F.struct(*[_comparable(F.col(c), k).alias(f"c{i}") for i, (c, k) in enumerate(kinds.items())])
    held = stored.filter(any_null(keys)).select(row.alias("__stored")).withColumn("__held", F.xxhash64("__stored"))
    hashed = staged.withColumn("__row", row).withColumn("__hash", F.xxhash64("__row"))
    same = (F.col("__hash") == F.col("__held")) & F.col("__row").eqNullSafe(F.col("__stored"))
    return hashed.join(held, same, "left_anti").select(*staged.columns)


def upsert(
    target: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    latest_by: Sequence[str] | None = None,
    null_keys: str = "insert",
    n: int = 0,
) -> DataFrame:
    """Staged rows replace target rows of the same key; other staged rows are inserted.

    ``staged`` must hold every target column. Extra staged columns are NULL on
    the old rows. Give ``latest_by`` when one batch may hold a key twice. Rows
    with a NULL key are inserted each time, as in SQL; with ``null_keys="once"``
    only those that the target does not hold already, so that a batch can be
    replayed. ``n`` is the number of staged rows where it is known.
    """
    lacking = [c for c in target.columns if c not in staged.columns]
    if lacking:
        raise ValueError(f"staged rows lack target columns: {lacking}")
    fresh = dedup_latest(staged, keys, latest_by) if latest_by is not None else staged
    arriving = _new_rows(target, fresh, keys) if null_keys == "once" else fresh
    return _unmatched(target, fresh, keys, n).unionByName(arriving, allowMissingColumns=True)
