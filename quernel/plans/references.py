"""Problem 3: orphan references, per row and per table and period."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.operators.references import attribute_targets, classify_references, parent_spans, plain_id, references
from quernel.session import table


def _target(kind: str, ref: str) -> F.Column:
    text = F.col(ref).cast("string")
    return F.struct(F.col(kind).alias("target_type"), F.coalesce(plain_id(text), F.when(text != "0", text)).alias("target_id"))


def all_references(spark: SparkSession, sf: str) -> DataFrame:
    edges = table(spark, sf, "relationships")
    held = table(spark, sf, "containments")
    records = table(spark, sf, "source_records").filter("record_status = 'present'")
    return (
        references(edges, "relationships", "edge_id", "observed_at", F.array_distinct(F.array(_target("from_type", "from_id"), _target("to_type", "to_id"))))
        .unionByName(references(held, "containments", "containment_id", "observed_at", F.array(_target("child_type", "child_id"))))
        .unionByName(references(records, "source_records", "row_id", "delivered_at", attribute_targets(F.col("attributes"))))
    )


def all_parents(spark: SparkSession, sf: str) -> DataFrame:
    """Timelines of the entities of source_records, and of the zones, which are always there; a zone in source_records does not count."""
    entities = parent_spans(table(spark, sf, "source_records").filter("entity_type IS DISTINCT FROM 'zone'"))
    zones = table(spark, sf, "zones").filter("area_id IS NOT NULL").select(F.lit("zone").alias("parent_type"), F.col("area_id").cast("string").alias("parent_id")).distinct()
    never = F.lit(None).cast("timestamp_ntz")
    always = zones.select("parent_type", "parent_id", never.alias("span_from"), never.alias("span_to"), F.lit(True).alias("present"), never.alias("first_delivered"), F.lit(True).alias("live"))
    return entities.unionByName(always)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    states = classify_references(all_references(spark, sf), all_parents(spark, sf))
    return states.filter("ref_state = 'missing' OR NOT live").select("ref_table", "ref_id", "target_type", "target_id")


def p3_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """The times from which and until which each entity was present; valid_to is null while it is."""
    spans = parent_spans(table(spark, sf, "source_records")).filter("present")
    return spans.select(F.col("parent_type").alias("entity_type"), F.col("parent_id").alias("entity_id"), F.col("span_from").alias("valid_from"), F.col("span_to").alias("valid_to"))


def p3_report(spark: SparkSession, sf: str) -> DataFrame:
    """References per table, month and state, orphans and others; references without a time stand under a null month."""
    states = classify_references(all_references(spark, sf), all_parents(spark, sf))
    month = F.date_format(F.date_trunc("month", "referred_at"), "yyyy-MM")
    return states.groupBy("ref_table", month.alias("period"), "ref_state").agg(F.count("*").alias("n_references"), F.countDistinct("target_type", "target_id").alias("n_targets"))
