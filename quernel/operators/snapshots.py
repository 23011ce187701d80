"""What changed between full snapshots: validity intervals and the events at their ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def complete_revisions(manifests: DataFrame) -> DataFrame:
    """source, source_revision, revision_no (from 1, in order of generated_at) and last_no, of revisions whose shards are all complete.

    Revisions without a time come first, ties go by name. One row per revision: metadata, small beside the rows.
    """
    whole = (
        manifests.filter("source IS NOT NULL AND source_revision IS NOT NULL")
        .groupBy("source", "source_revision")
        .agg(F.min(F.coalesce(F.col("status") == "complete", F.lit(False))).alias("whole"), F.min("generated_at").alias("at"))
        .filter("whole")
    )
    order = Window.partitionBy("source").orderBy(F.col("at").asc_nulls_first(), "source_revision")
    numbered = whole.select("source", "source_revision", F.row_number().over(order).alias("revision_no"))
    return numbered.withColumn("last_no", F.max("revision_no").over(Window.partitionBy("source")))


def validity_intervals(rows: DataFrame, revisions: DataFrame, keys: list[str], row_hash: Column, loaded_at: str | None = None) -> DataFrame:
    """source, keys, row_hash, valid_from, valid_to (revision numbers, both inclusive), last_no.

    Gaps and islands: a key's rows in order of revision form one interval as long as revisions follow
    one another and the hash stays. Repeated rows of a key in one snapshot count once; if they differ,
    the one loaded last counts. Rows of unknown or partial revisions and rows without a key are left out.
    Repeats are combined before the first shuffle, so a key has one row per revision afterwards.
    """
    kept = rows.select("source", "source_revision", *keys, row_hash.alias("row_hash"), (F.col(loaded_at) if loaded_at else F.lit(None).cast("timestamp_ntz")).alias("_at"))
    kept = kept.dropna(subset=["source", *keys]).join(revisions, ["source", "source_revision"])
    once = kept.groupBy("source", "revision_no", "last_no", *keys).agg(F.max(F.struct("_at", "row_hash")).alias("_r")).select("source", "revision_no", "last_no", *keys, F.col("_r.row_hash").alias("row_hash"))
    order = Window.partitionBy("source", *keys).orderBy("revision_no")
    starts = (F.lag("revision_no").over(order) == F.col("revision_no") - 1) & (F.lag("row_hash").over(order) == F.col("row_hash"))
    marked = once.withColumn("_start", F.when(F.coalesce(starts, F.lit(False)), 0).otherwise(1))
    islands = marked.withColumn("_island", F.sum("_start").over(order))
    return islands.groupBy("source", *keys, "_island").agg(F.first("row_hash").alias("row_hash"), F.min("revision_no").alias("valid_from"), F.max("revision_no").alias("valid_to"), F.first("last_no").alias("last_no")).drop("_island")


def change_events(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """source, keys, revision_no, change_kind: interval starts (added), ends (removed), adjacencies (changed).

    Nothing is known before a source's first revision and after its last, so intervals that touch them
    have no event there.
    """
    order = Window.partitionBy("source", *keys).orderBy("valid_from")
    near = intervals.withColumn("_before", F.lag("valid_to").over(order)).withColumn("_after", F.lead("valid_from").over(order))
    joined = F.coalesce(F.col("_before") == F.col("valid_from") - 1, F.lit(False))
    start = F.when(F.col("valid_from") > 1, F.struct(F.col("valid_from").alias("revision_no"), F.when(joined, "changed").otherwise("added").alias("change_kind")))
    ends = (F.col("valid_to") < F.col("last_no")) & ~F.coalesce(F.col("_after") == F.col("valid_to") + 1, F.lit(False))
    end = F.when(ends, F.struct((F.col("valid_to") + 1).alias("revision_no"), F.lit("removed").alias("change_kind")))
    return near.select("source", *keys, F.explode(F.array_compact(F.array(start, end))).alias("_e")).select("source", *keys, "_e.*")
