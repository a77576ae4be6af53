"""The service-request view of the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def requests(spark: SparkSession, sf_dir: str, closed: bool = False) -> DataFrame:
    """Orders as service requests with borough and agency.

    ``closed`` adds ``closed_date``, the last shipment of finished orders, at
    the price of aggregating the line items. Nations with their regions are
    broadcast, as Spark would take well compressed customers for smaller than
    them and send those through the driver. Skewed customers are split by
    adaptive execution.
    """
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    lands = nation.join(region, nation.n_regionkey == region.r_regionkey)
    places = customer.join(F.broadcast(lands), customer.c_nationkey == nation.n_nationkey)
    joined = orders.join(places, orders.o_custkey == places.c_custkey)
    columns = [
        F.col("o_orderkey").alias("unique_key"),
        F.col("o_orderdate").alias("created_date"),
        F.col("c_mktsegment").alias("agency"),
        F.col("n_name").alias("agency_name"),
        F.col("o_orderpriority").alias("complaint_type"),
        F.col("r_name").alias("borough"),
        F.col("o_orderstatus").alias("status"),
    ]
    if closed:
        shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
        joined = joined.join(shipped, joined.o_orderkey == shipped.l_orderkey, "left")
        columns.append(F.when(F.col("o_orderstatus") == "F", F.col("last_ship")).alias("closed_date"))
    return joined.select(*columns)
