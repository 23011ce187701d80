"""Joins with a defined meaning for what has no partner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compare_keys(left: DataFrame, right: DataFrame, keys: list[str], same: Column | None = None) -> DataFrame:
    """keys and status: leftOnly, rightOnly, changed or equal. Columns of left and right start with l_ and r_ in same.

    Both sides have unique keys; null keys are equal to each other.
    """
    a = left.select(*[F.col(k).alias(f"_l{k}") for k in keys], *[F.col(c).alias(f"l_{c}") for c in left.columns if c not in keys], F.lit(True).alias("_left"))
    b = right.select(*[F.col(k).alias(f"_r{k}") for k in keys], *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in keys], F.lit(True).alias("_right"))
    on = None
    for k in keys:
        on = F.col(f"_l{k}").eqNullSafe(F.col(f"_r{k}")) if on is None else on & F.col(f"_l{k}").eqNullSafe(F.col(f"_r{k}"))
    joined = a.join(b, on, "full")
    equal = same if same is not None else F.lit(True)
    status = F.when(F.col("_right").isNull(), "leftOnly").when(F.col("_left").isNull(), "rightOnly").when(F.coalesce(equal, F.lit(False)), "equal").otherwise("changed")
    return joined.select(*[F.when(F.col("_left"), F.col(f"_l{k}")).otherwise(F.col(f"_r{k}")).alias(k) for k in keys], status.alias("status"))


def compare_sources(rows: DataFrame, source: str, keys: list[str]) -> DataFrame:
    """source, keys and status of every key for every source: leftOnly (no other source has it), rightOnly (others have, this has not), equal.

    Repeats combine before the shuffle, and a key's sources are bounded by the number of sources. Rows without a
    source are left out; null keys are equal to each other.
    """
    known = rows.filter(F.col(source).isNotNull())
    every = known.select(F.col(source).alias("_s")).agg(F.collect_set("_s")).scalar()
    held = known.groupBy(*keys).agg(F.collect_set(source).alias("_have")).withColumn("_every", every)
    status = F.when(~F.array_contains("_have", F.col(source)), "rightOnly").when(F.size("_have") > 1, "equal").otherwise("leftOnly")
    return held.select(*keys, "_have", F.explode("_every").alias(source)).select(source, *keys, status.alias("status"))


def within(left: Column, right: Column, tolerance: float) -> Column:
    """Whether two numbers lie within the tolerance; null is equal to null only."""
    return F.when(left.isNull() | right.isNull(), left.isNull() & right.isNull()).otherwise(F.abs(left - right) <= tolerance)


def dangling_edges(edges: DataFrame, known: DataFrame) -> DataFrame:
    """Edges of which an endpoint is not in known (type, id); each once, also if both are missing."""
    ids = known.select("type", "id").distinct()
    end = lambda side: edges[f"{side}_type"]
    a = ids.select(F.col("type").alias("_ft"), F.col("id").alias("_fi"))
    b = ids.select(F.col("type").alias("_tt"), F.col("id").alias("_ti"))
    joined = edges.join(a, (end("from") == F.col("_ft")) & (edges.from_id == F.col("_fi")), "left").join(b, (end("to") == F.col("_tt")) & (edges.to_id == F.col("_ti")), "left")
    return joined.filter(F.col("_fi").isNull() | F.col("_ti").isNull()).select(*edges.columns)


def upsert(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """base with the rows of changes in place of its own where keys agree, and the others added. Columns are base's."""
    return base.join(changes.select(*keys).distinct(), keys, "left_anti").unionByName(changes.select(*base.columns))


def pending(jobs: DataFrame, done: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Jobs without a result in order of key, at most limit of them (a report of the next ones)."""
    left = jobs.join(done.select(key).distinct(), key, "left_anti")
    return left.orderBy(key).limit(limit) if limit is not None else left


def semantic_changes(before: DataFrame, after: DataFrame, ignore: list[str]) -> DataFrame:
    """Rows that are on one side only once the ignored columns are left out: side, and the other columns. Repeats count."""
    kept = [c for c in before.columns if c not in ignore]
    a, b = before.select(*kept), after.select(*kept)
    return a.exceptAll(b).withColumn("side", F.lit("before")).unionByName(b.exceptAll(a).withColumn("side", F.lit("after")))
