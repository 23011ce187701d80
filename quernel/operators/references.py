"""References to records that do not exist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Attributes that hold ids of quests: a number or a list of numbers.
QUEST_ID_FIELDS = ("nextQuestInChain", "parentQuest", "startQuest", "preQuestSingle", "questStarts", "startsQuestIds")
#: Attributes that hold a list of {type, id}.
TYPED_ID_FIELDS = ("startedBy",)

_TARGET = "struct<target_type: string, target_id: string>"
_OLDEST = "0001-01-01"


def plain_id(text: Column) -> Column:
    """A whole number as plain text (20.0 and 2e1 are 20); null for 0 and for anything else that is no whole number."""
    digits = F.when(text.rlike(r"^[1-9][0-9]{0,37}$"), text)
    number = text.try_cast("decimal(38,6)")
    whole = F.when((number == F.floor(number)) & (number != 0), number.cast("decimal(32,0)").cast("string"))
    return F.coalesce(digits, whole)


def _elements(text: Column) -> Column:
    """The elements of a JSON list as texts (strings without quotes), or the one value of anything else; null where broken."""
    return F.from_json(F.when(text.rlike(r"^\s*\["), text).otherwise(F.concat(F.lit("["), text, F.lit("]"))), "array<string>")


def attribute_targets(attributes: Column) -> Column:
    """Distinct targets named by the id fields of a map<string, JSON text>; empty for null maps and unreadable values.

    Ids are numbers or strings of digits; an element that is no id does not spoil the others of its list.
    """
    one = lambda kind, i: F.struct(kind.alias("target_type"), plain_id(F.trim(i)).alias("target_id"))
    none = F.array().cast("array<string>")
    held = lambda names: F.flatten(F.array(*[F.coalesce(_elements(attributes[f]), none) for f in names]))
    typed = F.transform(held(TYPED_ID_FIELDS), lambda t: F.from_json(t, "struct<type: string, id: string>"))
    both = F.concat(F.transform(held(QUEST_ID_FIELDS), lambda i: one(F.lit("quest"), i)), F.transform(typed, lambda t: one(t["type"], t["id"])))
    return F.array_distinct(both.cast(f"array<{_TARGET}>"))


def references(rows: DataFrame, name: str, key: str, at: str, targets: Column) -> DataFrame:
    """ref_table, ref_id, referred_at, target_type, target_id: one row per distinct target of a row.

    targets is an array<struct<target_type, target_id>>; targets without type or id are none.
    """
    exploded = rows.select(F.lit(name).alias("ref_table"), F.col(key).alias("ref_id"), F.col(at).alias("referred_at"), F.explode(targets).alias("_t"))
    exploded = exploded.filter("_t.target_type IS NOT NULL AND _t.target_id IS NOT NULL AND _t.target_id <> ''")
    return exploded.select("ref_table", "ref_id", "referred_at", "_t.target_type", "_t.target_id")


def parent_spans(records: DataFrame) -> DataFrame:
    """parent_type, parent_id, span_from, span_to, present, first_delivered, live: the whole timeline of every entity ever delivered.

    records: entity_type, entity_id, source, generated_at, delivered_at, record_status. A source has the
    entity from the time (generated_at) of a present record until that of a removal; of records of one
    time the one delivered last counts, and of those a removal. The entity is present while at least one
    source has it. Spans of one entity follow each other without gaps: the first has no span_from, the last
    no span_to (null times are the oldest), and live says whether the entity is present in the last one.
    first_delivered is the first delivery as present. Rows without type or id are left out. Records combine
    to one per source and time before they are brought together, so a key is bounded by its revisions.
    """
    oldest = F.lit(_OLDEST).cast("timestamp_ntz")
    present = F.coalesce(F.col("record_status") == "present", F.lit(False))
    named = records.filter("entity_type IS NOT NULL AND entity_id IS NOT NULL").select(
        F.col("entity_type").alias("parent_type"), F.col("entity_id").alias("parent_id"), "source", F.coalesce("generated_at", oldest).alias("at"), F.coalesce("delivered_at", oldest).alias("_d"), present.alias("_p"), "delivered_at"
    )
    key = ["parent_type", "parent_id"]
    # not present sorts last of equal deliveries
    told = named.groupBy(*key, "source", "at").agg(F.max(F.struct("_d", (~F.col("_p")).alias("gone"))).alias("_m"), F.min(F.when(F.col("_p"), F.col("delivered_at"))).alias("_f"))
    told = told.select(*key, "source", "at", F.when(F.col("_m.gone"), 0).otherwise(1).alias("has"), "_f").repartition(*key)
    # one partitioning serves all that follows
    by_source = Window.partitionBy(*key, "source").orderBy("at")
    steps = told.withColumn("step", F.col("has") - F.coalesce(F.lag("has").over(by_source), F.lit(0)))
    moments = steps.groupBy(*key, "at").agg(F.sum("step").alias("step"), F.min("_f").alias("_f"))
    timeline, whole = Window.partitionBy(*key).orderBy("at"), Window.partitionBy(*key)
    running = moments.withColumn("present", F.sum("step").over(timeline.rowsBetween(Window.unboundedPreceding, 0)) > 0).withColumn("first_delivered", F.min("_f").over(whole))
    changes = running.withColumn("_same", F.coalesce(F.lag("present").over(timeline) == F.col("present"), F.lit(False))).filter("NOT _same")
    spans = changes.withColumn("span_to", F.lead("at").over(timeline)).withColumn("_last", F.row_number().over(whole.orderBy(F.col("at").desc())))
    spans = spans.withColumn("live", F.max(F.when(F.col("_last") == 1, F.col("present"))).over(whole)).withColumn("_first", F.lag("at").over(timeline).isNull())
    here = F.struct(F.col("at").alias("span_from"), "span_to", "present")
    before = F.struct(F.lit(None).cast("timestamp_ntz").alias("span_from"), F.col("at").alias("span_to"), F.lit(False).alias("present"))
    return spans.select(*key, F.explode(F.when(F.col("_first"), F.array(before, here)).otherwise(F.array(here))).alias("_s"), "first_delivered", "live").select(*key, "_s.*", "first_delivered", "live")


def classify_references(refs: DataFrame, spans: DataFrame) -> DataFrame:
    """refs with valid_from and valid_to (the span of the parent's timeline the reference falls into), live and ref_state.

    missing: no source ever had the entity; live: it is there and was when the reference was made; late: it is
    there, but was not yet delivered then, or was between removal and return; deleted: it is gone, and was
    not yet when the reference was made; stale: it was removed already when the reference was made, and is
    still gone. References without a time count as made at the end. References and spans are co-partitioned and
    sorted by target and merged in one linear pass (a sort-merge join); a reference falls into exactly one span
    of its target, so a hot target only makes its reference side large, which adaptive execution splits. Neither
    side is broadcast, collected or grouped in memory.
    """
    at = F.col("referred_at")
    within = (F.col("span_from").isNull() | F.coalesce(at >= F.col("span_from"), F.lit(True))) & (F.col("span_to").isNull() | F.coalesce(at < F.col("span_to"), F.lit(False)))
    joined = refs.hint("merge").join(spans.hint("merge"), (refs.target_type == spans.parent_type) & (refs.target_id == spans.parent_id) & within, "left")
    late = ~F.col("present") | F.coalesce(F.col("first_delivered") > at, F.lit(False))
    gone = F.when(F.col("present") | F.col("span_from").isNull(), "deleted").otherwise("stale")
    state = F.when(F.col("live").isNull(), "missing").when(~F.col("live"), gone).when(late, "late").otherwise("live")
    return joined.select(*[refs[c] for c in refs.columns], F.col("span_from").alias("valid_from"), F.col("span_to").alias("valid_to"), "live", state.alias("ref_state"))
