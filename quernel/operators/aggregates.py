"""Aggregations with a defined choice: votes, first and last writers, repeats, indexes, shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernel.session import cut


def mode_vote(df: DataFrame, key: str, choice: str) -> DataFrame:
    """key, choice (the most frequent, of ties the smallest), confidence (its share, 3 places), samples.

    Null keys and choices do not vote. Counts combine before the shuffle, so hot keys do no harm.
    """
    votes = df.dropna(subset=[key, choice]).groupBy(key, choice).agg(F.count("*").alias("n"))
    best = F.min_by(choice, F.struct(-F.col("n"), F.col(choice))).alias(choice)
    return votes.groupBy(key).agg(best, F.round(F.max("n") / F.sum("n"), 3).alias("confidence"), F.sum("n").alias("samples"))


def inverted_index(df: DataFrame, key: str, member: str, width: int | None = None) -> DataFrame:
    """key, members: the distinct members of each key in order, joined by commas.

    With a width, for whole numbers as members, also chunk: the member divided by width, rounded down. A key then
    has a row for each chunk, with at most width members however many the key has; without one a key's members
    must fit a row. Null keys and members are left out. Distinct pairs are formed before members come together.
    """
    pairs = df.select(key, member).dropna().distinct()
    chunk = [F.floor(F.col(member) / width).alias("chunk")] if width else []
    return pairs.groupBy(key, *chunk).agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(member)), lambda m: m.cast("string"))).alias("members"))


def number_rows(df: DataFrame, key: str, parts: int = 64) -> DataFrame:
    """df with row_no from 1 in order of key, without gathering all rows in one task.

    Rows are laid out in ranges of the key and numbered within them; the counts of the ranges, one row each,
    give the offset. Equal keys are numbered in no defined order; null keys come first.
    """
    # written down before it is read twice: ranges are sampled, and would differ the second time
    ranged = cut(df.repartitionByRange(parts, key).withColumn("_part", F.spark_partition_id()))
    local = ranged.withColumn("_no", F.row_number().over(Window.partitionBy("_part").orderBy(key)))
    sizes = local.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
    joined = local.join(before.select("_part", F.coalesce("_before", F.lit(0)).alias("_before")), "_part")
    return joined.select(*df.columns, (F.col("_no") + F.col("_before")).alias("row_no"))


def shards(df: DataFrame, key: str, size: int) -> DataFrame:
    """shard_no from 1, id_first, id_last, n_rows: fixed numbers of rows in order of key.

    With whole ids 1..n per shard the number of a row is its rank, found by ranges (see number_rows).
    """
    numbered = number_rows(df, key)
    return numbered.groupBy(F.ceil(F.col("row_no") / size).alias("shard_no")).agg(F.min(key).alias("id_first"), F.max(key).alias("id_last"), F.count("*").alias("n_rows"))


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key. A row number of 1 is cut down in each task before the shuffle."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rank = 1").drop("_rank")


def last_writer(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """keys, value as the last row wrote it (a null counts as written), written_at of that row."""
    last = F.max_by(F.struct(F.col(value).alias("v"), F.struct(*order).alias("w")), F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("_l")).select(*keys, F.col("_l.v").alias(value), F.col("_l.w")[order[0]].alias("written_at"))


def repeat_declarations(df: DataFrame, key: str, value: str) -> DataFrame:
    """key, value where all rows agree, else null, and n_values: different declarations cancel each other."""
    n = F.count_distinct(value)
    return df.groupBy(key).agg(F.when(n == 1, F.min(value)).alias(value), n.alias("n_values"))


def unique_candidate(df: DataFrame, key: str, candidate: str) -> DataFrame:
    """key, candidate of the keys that have exactly one candidate."""
    return repeat_declarations(df, key, candidate).filter("n_values = 1").select(key, candidate)


def retention(before: DataFrame, after: DataFrame, keys: list[str], least: float = 0.5) -> DataFrame:
    """keys, n_before, n_after, kept: whether at least that share of rows is left. Only keys on both sides; nothing before passes."""
    a = before.groupBy(*keys).agg(F.count("*").alias("n_before"))
    b = after.groupBy(*keys).agg(F.count("*").alias("n_after"))
    return a.join(b, keys).select(*keys, "n_before", "n_after", (F.col("n_after") >= F.lit(least) * F.col("n_before")).alias("kept"))


def running_ids(df: DataFrame, group: str, order: str, delta: Column) -> DataFrame:
    """Absolute ids from differences: each is the last one plus its difference plus one, from -1 on, per group."""
    return df.withColumn("absolute_id", F.sum(delta + 1).over(Window.partitionBy(group).orderBy(order)) - 1)


def bit_or_masks(df: DataFrame, key: str, bits: Column) -> DataFrame:
    return df.groupBy(key).agg(F.bit_or(bits).alias("mask"))
