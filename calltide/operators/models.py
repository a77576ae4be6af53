"""Table of model versions: registration, best version, promotion.

Columns: model_name, version, params MAP<STRING,STRING>, mape STRING (the tag
as recorded), stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STAGING = "Staging"
NO_STAGE = "None"


def metric_value(tag: Column) -> Column:
    """Number in a metric tag; empty, malformed or NaN text gives NULL."""
    value = tag.try_cast("double")
    return F.when(~F.isnan(value), value)


def register_runs(
    registry: DataFrame, runs: DataFrame, order_by: str = "trial", keep: Sequence[str] = ()
) -> DataFrame:
    """Number new runs after the newest version of their model; returns the rows to append.

    Columns of ``runs`` named by ``keep`` are returned as well.

    ``runs`` has model_name, params, mape and an ordering column. Runs of one
    model come from one search, so their number is the number of trials.
    """
    newest = registry.groupBy("model_name").agg(F.max("version").alias("__newest"))
    rank = F.row_number().over(Window.partitionBy("model_name").orderBy(order_by))
    version = F.coalesce("__newest", F.lit(0)) + rank
    return (
        runs.join(newest, "model_name", "left")
        .select(
            "model_name",
            version.cast("bigint").alias("version"),
            "params",
            F.col("mape").cast("string").alias("mape"),
            F.lit(NO_STAGE).alias("stage"),
            *keep,
        )
    )


def best_version(registry: DataFrame) -> DataFrame:
    """Version with the smallest metric per model; the lowest version wins ties."""
    value = metric_value(F.col("mape"))
    return (
        registry.select("model_name", "version", value.alias("__mape"))
        .filter(F.col("__mape").isNotNull())
        .groupBy("model_name")
        .agg(F.min(F.struct("__mape", "version")).alias("__best"))
        .select("model_name", F.col("__best.version").alias("version"), F.col("__best.__mape").alias("mape"))
    )


def promote_if_better(registry: DataFrame, stage: str = STAGING) -> DataFrame:
    """Decision per model: best version, the stage's current metric, and whether to promote.

    The best of all versions is promoted when the stage has no metric or a
    strictly worse one. The newest version in the stage speaks for it.
    """
    value = metric_value(F.col("mape"))
    in_stage = F.when(F.col("stage") == stage, F.struct("version", value.alias("mape")))
    scored = F.when(value.isNotNull(), F.struct(value.alias("mape"), F.col("version").alias("version")))
    return (
        registry.groupBy("model_name")
        .agg(F.min(scored).alias("__best"), F.max(in_stage).alias("__stage"))
        .filter(F.col("__best").isNotNull())
        .select(
            "model_name",
            F.col("__best.version").alias("best_version"),
            F.col("__best.mape").alias("best_mape"),
            F.col("__stage.version").alias("stage_version"),
            F.col("__stage.mape").alias("stage_mape"),
        )
        .withColumn("promoted", F.col("stage_mape").isNull() | (F.col("best_mape") < F.col("stage_mape")))
    )


def set_stage(registry: DataFrame, changes: DataFrame) -> DataFrame:
    """Registry after giving (model_name, version) of ``changes`` their new ``stage``.

    Versions the registry does not hold are ignored.
    """
    keys = ["model_name", "version"]
    new = changes.select(*keys, F.col("stage").alias("__new"))
    return (
        registry.join(new, keys, "left")
        .withColumn("stage", F.coalesce("__new", "stage"))
        .select(*registry.columns)
    )


def apply_promotions(registry: DataFrame, stage: str = STAGING) -> DataFrame:
    """Registry after promotion; versions already in the stage stay there."""
    chosen = promote_if_better(registry, stage).filter("promoted")
    return set_stage(
        registry, chosen.select("model_name", F.col("best_version").alias("version"), F.lit(stage).alias("stage"))
    )
