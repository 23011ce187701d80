"""Problem 5: the records of very many tiny raw files in a few files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.operators.compaction import VersionedStore, compact
from quernel.session import shared_dir, table
from quernel.sources.raw_documents import raw_documents


def compacted(spark: SparkSession, sf: str, target_bytes: int = 128 << 20) -> DataFrame:
    files = table(spark, sf, "raw_files")
    # one row: how many buckets a new store gets
    size = files.agg(F.sum(F.octet_length("file_text"))).first()[0] or 0
    docs = raw_documents(files, "file_id", "size_bytes", "modified_at")
    records = docs.select("file_id", F.col("size_bytes").alias("file_bytes"), "kind", "record_id", "body", F.get_json_object("body", "$.fetchedAt").alias("fetched_at"), "modified_at")
    store = VersionedStore(spark, shared_dir(spark, "compacted"), buckets=max(1, -(-size // target_bytes)))
    return compact(store, records, target_bytes=target_bytes)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return compacted(spark, sf).select("kind", "record_id")


def p5_spawns(spark: SparkSession, sf: str) -> DataFrame:
    """Objects per spawn zone, read from the compacted store."""
    spawns = F.from_json(F.get_json_object("body", "$.spawns"), "array<struct<zoneId: double>>")
    objects = compacted(spark, sf).filter("kind = 'object'")
    zones = objects.select("record_id", F.explode(F.array_distinct(F.transform(spawns, lambda s: s["zoneId"].cast("long")))).alias("zone_id"))
    return zones.groupBy("zone_id").agg(F.count("*").alias("n_objects"))
