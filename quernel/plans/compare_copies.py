"""Problem 4: differences between dataset_left and dataset_right."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.functions.canonical import canonical_json
from quernel.operators.compare_copies import compare_copies, explode_paths, latest_rows
from quernel.session import table

_KEYS = ["flavor", "entity_type", "entity_id"]


def copy_records(df: DataFrame, latest_only: bool) -> DataFrame:
    """Keys and record of one copy. Null keys become '' (a missing key is equal to itself); null attributes are JSON null."""
    states = F.when(F.size("field_states") > 0, F.to_json(F.try_parse_json(F.to_json("field_states", {"ignoreNullFields": "false"}))))
    keys = [F.coalesce(F.col(k), F.lit("")).alias(k) for k in _KEYS]
    if latest_only:
        df = latest_rows(df.select(*keys, "loaded_at", "attributes", "field_states"), _KEYS, "loaded_at", F.md5(F.coalesce("attributes", F.lit(""))))
        keys = [F.col(k) for k in _KEYS]
    # a text that is no JSON is compared as a string
    attributes = F.when(F.try_parse_json("attributes").isNotNull(), canonical_json(F.col("attributes"))).otherwise(F.coalesce(F.get_json_object(F.to_json(F.struct("attributes")), "$"), F.lit("null")))
    return df.select(*keys, F.concat(F.lit('{"a":'), attributes, F.lit(',"s":'), F.coalesce(states, F.lit("{}")), F.lit("}")).alias("record"))


def _compare(spark: SparkSession, sf: str, latest_only: bool, tolerance: float | None = None) -> DataFrame:
    left, right = (copy_records(table(spark, sf, f"dataset_{side}"), latest_only) for side in ("left", "right"))
    return explode_paths(compare_copies(left, right, _KEYS, tolerance), _KEYS, tolerance)


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _compare(spark, sf, latest_only=True).select("entity_type", "entity_id", "status", "diff_path")


def p4_all_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The same over all rows of either copy, outdated and repeated ones too: leftovers pair at least cost."""
    return _compare(spark, sf, latest_only=False).groupBy(*_KEYS, "status", "diff_path").agg(F.count("*").alias("n_rows"))


def p4_near(spark: SparkSession, sf: str) -> DataFrame:
    """p4_found with points that may lie apart by 0.5 on either axis of the same map; per path, how many entities differ."""
    return _compare(spark, sf, latest_only=True, tolerance=0.5).groupBy("entity_type", "status", "diff_path").agg(F.count("*").alias("n_entities"))
