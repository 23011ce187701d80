"""Business tables as observations of several sources, for the reconciliation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.session import table


def cents(column: str) -> F.Column:
    """Money as whole cents, so that sums do not depend on their order."""
    return F.round(F.col(column) * 100).cast("long")


def order_fields(spark: SparkSession, sf: str) -> DataFrame:
    """FIELD rows for orders from two sources: the orders themselves, and what their lines add up to."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("entity_id"), "o_orderstatus", cents("o_totalprice").alias("total"))
    flags = F.when(F.max("l_linestatus") == F.min("l_linestatus"), F.max("l_linestatus")).otherwise("P")
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("entity_id")).agg(flags.alias("status"), F.sum(cents("l_extendedprice")).alias("total"))
    both = orders.select("entity_id", F.lit("orders").alias("source"), F.col("o_orderstatus").alias("status"), "total").unionByName(lines.select("entity_id", F.lit("lines").alias("source"), "status", "total"))
    stacked = F.expr("stack(2, 'status', concat('\"', status, '\"'), 'total', cast(total AS string)) AS (field, value)")
    long = both.select("entity_id", "source", stacked)
    return long.select(F.lit("order").alias("entity_type"), "entity_id", "source", F.lit("r1").alias("revision"), "field", "value", F.when(F.col("value").isNull(), "missing").alias("state"))


def order_policy(spark: SparkSession) -> DataFrame:
    """Totals come from the lines first; nothing decides about the status."""
    return spark.createDataFrame([("order", "total", "lines", 1), ("order", "total", "orders", 2)], "entity_type string, field string, source string, priority int")
