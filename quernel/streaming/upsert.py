"""Record files as they arrive, merged into the newest record of every entity and source.

A stream of record files is reduced batch by batch: the newest record of each key in the batch
takes the place of the stored one if it is newer. Every batch writes its own version and names it
in a log last, so a batch that is run again after a failure replaces its own output and nothing is
lost or counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

KEY = ["entity_type", "entity_id", "source"]


def newest(records: DataFrame) -> DataFrame:
    """The newest record of each key, by generated_at, delivered_at, row_id; combines before the shuffle."""
    kept = F.max_by(F.struct(*[c for c in records.columns if c not in KEY]), F.struct("generated_at", "delivered_at", "row_id"))
    return records.groupBy(*KEY).agg(kept.alias("_r")).select(*KEY, "_r.*")


def current(spark: SparkSession, store: str, schema: T.StructType) -> DataFrame:
    """The newest records as of the last finished batch; empty before the first."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(store)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    versions = sorted(int(n[6:]) for n in done if n.startswith("batch-") and fs.exists(hadoop.Path(f"{store}/{n}/_SUCCESS")))
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{store}/batch-{versions[-1]}")


def upsert_stream(spark: SparkSession, incoming: str, schema: T.StructType, store: str, checkpoint: str) -> StreamingQuery:
    """Start merging parquet files of records that arrive in a folder; what is there is merged, then the query ends."""

    def merge(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        before = current(own, store, schema) if number else own.createDataFrame([], schema)
        newest(before.unionByName(batch.select(*schema.names))).select(*schema.names).write.mode("overwrite").parquet(f"{store}/batch-{number}")

    stream = spark.readStream.schema(schema).parquet(incoming)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_counts(events: DataFrame, late: str = "2 hours", window: str = "1 day") -> DataFrame:
    """Counts per window of ts and event_type, for batch tables and streams; a stream closes a window once ts is late past it."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    return marked.groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), "event_type", "n")
