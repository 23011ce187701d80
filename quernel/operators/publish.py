"""Publication of rows as numbered shards of JSON lines, with indexes and a check against what is there."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.operators.aggregates import inverted_index, number_rows
from quernel.session import cut
from quernel.sources.datasets import DatasetError, _files, replace_tree

#: Bytes that one shard may have; more is an error, as readers load a shard whole.
SHARD_BYTES = 20 << 20


def shard_rows(rows: DataFrame, key: str, per_shard: int) -> DataFrame:
    """shard_no, key, line: the rows as canonical JSON text, numbered in order of key, per_shard to a shard."""
    numbered = number_rows(rows, key)
    line = F.to_json(F.parse_json(F.to_json(F.struct(*rows.columns))))
    return numbered.select(F.ceil(F.col("row_no") / per_shard).cast("int").alias("shard_no"), key, line.alias("line"))


def shard_manifest(sharded: DataFrame, key: str) -> DataFrame:
    """shard_no, id_first, id_last, n_rows, n_bytes, sha256 of every shard.

    A shard is bounded by SHARD_BYTES, so its lines come together in one row for the checksum; a larger one
    fails the job instead of being cut.
    """
    sized = sharded.groupBy("shard_no").agg(F.min(key).alias("id_first"), F.max(key).alias("id_last"), F.count("*").alias("n_rows"), F.sum(F.octet_length("line") + 1).alias("n_bytes"))
    guarded = sized.withColumn("n_bytes", F.when(F.col("n_bytes") <= SHARD_BYTES, F.col("n_bytes")).otherwise(F.raise_error(F.concat(F.lit("shard too large: "), F.col("shard_no").cast("string"))).cast("bigint")))
    whole = sharded.groupBy("shard_no").agg(F.sha2(F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, "line"))), lambda r: r["line"]), "\n"), F.lit("\n")), 256).alias("sha256"))
    return guarded.join(whole, "shard_no")


def publish(rows: DataFrame, key: str, path: str, per_shard: int = 500, indexes: dict[str, str] | None = None) -> DataFrame:
    """Write shards (shard_no=N/), index_<name>/ and manifest/ below path in place of what is there; gives the manifest.

    indexes: name -> column by which ids are listed. The same rows give the same manifest, whatever their order.
    A row without a key, or a key twice, is an error before anything is replaced.
    """
    spark = rows.sparkSession
    rows = cut(rows)
    if rows.filter(F.col(key).isNull()).take(1) or rows.groupBy(key).count().filter("count > 1").take(1):
        raise DatasetError(f"{key} is missing or repeats")
    sharded = cut(shard_rows(rows, key, per_shard))
    staged = f"{path.rstrip('/')}.new"
    fs, new_path = _files(spark, path)
    fs.delete(new_path(staged), True)
    sharded.repartition("shard_no").sortWithinPartitions("shard_no", key).select("shard_no", "line").write.partitionBy("shard_no").text(f"{staged}/shards")
    for name, column in (indexes or {}).items():
        inverted_index(rows, column, key).write.json(f"{staged}/index_{name}")
    shard_manifest(sharded, key).coalesce(1).write.json(f"{staged}/manifest")
    replace_tree(spark, staged, path)
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("shard_no int, id_first bigint, id_last bigint, n_rows bigint, n_bytes bigint, sha256 string").json(f"{path}/manifest")


def check(rows: DataFrame, key: str, path: str, per_shard: int = 500) -> DataFrame:
    """shard_no, problem (missing, stale or changed) of the shards that a new publication would alter; nothing is written."""
    wanted = shard_manifest(cut(shard_rows(rows, key, per_shard)), key).select("shard_no", F.col("sha256").alias("wanted"))
    there = read_manifest(rows.sparkSession, path).select("shard_no", F.col("sha256").alias("there"))
    both = wanted.join(there, "shard_no", "full")
    problem = F.when(F.col("there").isNull(), "missing").when(F.col("wanted").isNull(), "stale").when(F.col("there") != F.col("wanted"), "changed")
    return both.select("shard_no", problem.alias("problem")).filter("problem IS NOT NULL")


def zone_bundles(rows: DataFrame, zone: str, path: str, only: list[int] | None = None) -> None:
    """Write rows by zone; with only, the folders of these zones alone are replaced (dynamic partition overwrite) and an unknown zone is an error."""
    chosen = rows
    if only is not None:
        chosen = rows.filter(F.col(zone).isin(only))
        known = {r[0] for r in chosen.select(zone).distinct().collect()}  # at most as many as were asked for
        if missing := set(only) - known:
            raise DatasetError(f"unknown zones {json.dumps(sorted(missing))}")
    chosen.repartition(zone).write.mode("overwrite").option("partitionOverwriteMode", "static" if only is None else "dynamic").partitionBy(zone).json(path)
