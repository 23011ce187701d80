"""Problem 7: containment rows as full hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.operators.hierarchy import parent_links, solve_hierarchy
from quernel.session import table


def _solved(spark: SparkSession, sf: str, paths: bool) -> DataFrame:
    return solve_hierarchy(parent_links(table(spark, sf, "containments")), paths)


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return _solved(spark, sf, paths=False).select(
        F.col("node.type").alias("node_type"),
        F.col("node.id").alias("node_id"),
        F.coalesce("root.type", F.lit("cycle")).alias("root_type"),
        F.coalesce("root.id", F.lit(-1)).alias("root_id"),
        "depth",
    )


def p7_paths(spark: SparkSession, sf: str) -> DataFrame:
    """The path of every node, root first, as type:id/type:id; null for nodes on or below a loop."""
    step = lambda n: F.concat(n["type"], F.lit(":"), n["id"].cast("string"))
    path = F.when(~F.col("cyclic"), F.concat_ws("/", F.reverse(F.transform("way", step)), step(F.col("node"))))
    return _solved(spark, sf, paths=True).select(F.col("node.type").alias("node_type"), F.col("node.id").alias("node_id"), path.alias("path"), "depth")


def p7_descendants(spark: SparkSession, sf: str) -> DataFrame:
    """Every ancestor with each of its descendants and the number of links between them; loops left out."""
    up = _solved(spark, sf, paths=True).filter("NOT cyclic").select("node", F.posexplode("way").alias("_n", "above"))
    return up.select(F.col("above.type").alias("node_type"), F.col("above.id").alias("node_id"), F.col("node.type").alias("descendant_type"), F.col("node.id").alias("descendant_id"), (F.col("_n") + 1).alias("distance"))
