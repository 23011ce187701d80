"""Problem 6: changes between full snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.functions.canonical import canonical_map, map_text
from quernel.operators.snapshots import change_events, complete_revisions, validity_intervals
from quernel.session import table

_KEYS = ["entity_type", "entity_id"]


def _intervals(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    revisions = complete_revisions(table(spark, sf, "manifests"))
    content = F.map_filter("attributes", lambda k, _: k != "fetchedAt")
    rows = table(spark, sf, "snapshot_rows")
    return revisions, validity_intervals(rows, revisions, _KEYS, F.md5(map_text(canonical_map(content))), "loaded_at")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    revisions, intervals = _intervals(spark, sf)
    events = change_events(intervals, _KEYS)
    return events.join(revisions.select("source", "revision_no", "source_revision"), ["source", "revision_no"]).select("source", "source_revision", *_KEYS, "change_kind")


def p6_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Validity intervals of every entity version, by number of revision."""
    return _intervals(spark, sf)[1].select("source", *_KEYS, "row_hash", "valid_from", "valid_to")
