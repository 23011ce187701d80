"""Reconciliation of observations from many sources into one record per entity.

Works on the long form FIELD, one row per record and field: entity_type, entity_id, source,
revision, field, value (canonical JSON text or null), state (why there is no usable value, or
null). Equal observations combine on an exchange of their own, before which each task has combined its
own, so an entity with very many rows does no harm; what is left is bounded by sources and fields, is
brought together by entity once, and both groupings above it need no further exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.functions.canonical import canonical_map

KEY = ["entity_type", "entity_id"]
#: Which state wins where no source has a value, strongest first.
STATE_ORDER = ("invalid", "conflicting", "unsupported", "unavailable", "missing", "empty")
#: Canonical texts of empty values.
EMPTY_TEXTS = ("null", '""', "[]", "{}")


def state_rank(state: Column) -> Column:
    """Small numbers are strong; unknown states come last."""
    return F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(s) for s in STATE_ORDER]), state), F.lit(0)), F.lit(99).cast("long"))


def is_empty_json(value: Column) -> Column:
    """Whether a canonical JSON text is null, an empty text, list or object; SQL null is empty too."""
    return value.isNull() | value.isin(*EMPTY_TEXTS)


def explode_fields(records: DataFrame) -> DataFrame:
    """FIELD rows of records with maps attributes and field_states; a field with a state only has value null.

    Values under a state other than empty are not usable and come out as their state; an empty value without
    a state has the state empty; an explicit null under the state empty stays a value, as it says that there
    is nothing. Null maps have no fields.
    """
    base = [*KEY, "source", F.col("source_revision").alias("revision")]
    attributes = F.coalesce(canonical_map(F.col("attributes")), F.create_map().cast("map<string,string>"))
    states = F.coalesce(F.col("field_states"), F.create_map().cast("map<string,string>"))
    named = records.select(*base, attributes.alias("_a"), states.alias("_s"))
    long = named.select(*KEY, "source", "revision", "_a", "_s", F.explode(F.array_union(F.map_keys("_a"), F.map_keys("_s"))).alias("field"))
    raw, mark = F.col("_a")[F.col("field")], F.col("_s")[F.col("field")]
    state = F.when(mark.isNotNull() & (mark != "empty"), mark).when(is_empty_json(raw) & mark.isNull(), F.lit("empty")).when(raw.isNull(), mark)
    return long.select(*KEY, "source", "revision", "field", F.when(state.isNull(), raw).alias("value"), state.alias("state"))


#: Rows up to which a policy is broadcast, of under 200 bytes each; a larger one is joined by a shuffle.
POLICY_ROWS = 100_000


def _policy(policy: DataFrame) -> DataFrame:
    rows = policy.select("entity_type", "field", "source", "priority")
    return F.broadcast(rows) if rows.limit(POLICY_ROWS + 1).count() <= POLICY_ROWS else rows


def group_values(fields: DataFrame, policy: DataFrame) -> DataFrame:
    """One row per entity, field and distinct value (or state): owners, and the best rank an owner has in policy.

    policy: entity_type, field, source, priority; broadcast if it has at most POLICY_ROWS rows.
    """
    ranked = fields.join(_policy(policy), ["entity_type", "field", "source"], "left")
    owners = F.array_sort(F.collect_set(F.struct("source", "revision")))
    return ranked.groupBy(*KEY, "field", "value", "state").agg(owners.alias("owners"), F.min("priority").alias("priority"))


def resolve(fields: DataFrame, policy: DataFrame) -> DataFrame:
    """One row per entity and field: value, state, rule, owners, n_values, candidates.

    One value: taken, whatever states others have. Several: the one owned by the source that policy lists
    first, with rule "<entity_type>.<field>" and that value's owners only; none listed: state conflicting and
    all owners. No value: the strongest state. candidates holds, for fields with several values, every value
    with its sources and then every state, each in order of source; else it is empty. The values of a field are
    bounded by the number of sources.
    """
    grouped = group_values(fields, policy)
    item = F.struct(F.col("priority").alias("priority"), F.col("value").alias("value"), F.col("owners").alias("owners"))
    has = F.col("value").isNotNull()
    merged = grouped.repartition(*KEY).groupBy(*KEY, "field").agg(
        F.array_sort(F.collect_list(F.when(has, item))).alias("_values"),
        F.array_sort(F.collect_list(F.when(~has, F.struct(state_rank(F.col("state")).alias("rank"), F.col("state").alias("state"), F.col("owners").alias("owners"))))).alias("_states"),
    )
    listed = F.filter("_values", lambda v: v["priority"].isNotNull())
    first = F.try_element_at(listed, F.lit(1))
    n = F.size("_values")
    value = F.when(n == 1, F.col("_values")[0]["value"]).when(n > 1, first["value"])
    state = F.when(n == 0, F.try_element_at("_states", F.lit(1))["state"]).when((n > 1) & first.isNull(), "conflicting")
    every = F.array_sort(F.array_distinct(F.flatten(F.concat(F.transform("_values", lambda v: v["owners"]), F.transform("_states", lambda s: s["owners"])))))
    owners = F.when(n == 1, F.col("_values")[0]["owners"]).when((n > 1) & first.isNotNull(), first["owners"]).otherwise(every)
    flat = lambda items, name: F.flatten(F.transform(items, lambda v: F.transform(v["owners"], lambda o: F.struct(o["source"].alias("source"), F.when(F.lit(name == "value"), v[name]).alias("value"), F.when(F.lit(name == "state"), v[name]).alias("state")))))
    candidates = F.when(n > 1, F.concat(F.array_sort(flat("_values", "value")), F.array_sort(flat("_states", "state")))).otherwise(F.array().cast("array<struct<source:string,value:string,state:string>>"))
    rule = F.when((n > 1) & first.isNotNull(), F.concat_ws(".", "entity_type", "field"))
    return merged.select(*KEY, "field", value.alias("value"), state.alias("state"), rule.alias("rule"), owners.alias("owners"), n.alias("n_values"), candidates.alias("candidates"))


def merged_records(resolved: DataFrame) -> DataFrame:
    """One row per entity: attributes, field_states and sources (field -> owning sources) as maps in field order."""
    rows = F.array_sort(F.collect_list(F.struct("field", "value", "state", F.array_distinct(F.transform("owners", lambda o: o["source"])).alias("sources"))))
    whole = resolved.groupBy(*KEY).agg(rows.alias("_r"))
    as_map = lambda name: F.map_from_entries(F.transform(F.filter("_r", lambda r: r[name].isNotNull()), lambda r: F.struct(r["field"], r[name])))
    return whole.select(*KEY, as_map("value").alias("attributes"), as_map("state").alias("field_states"), as_map("sources").alias("sources"))


def dispositions(resolved: DataFrame) -> DataFrame:
    """Counts of what became of fields: in total, by entity type and by field (null where summed up).

    equivalent: a value that several sources share; selected: decided by policy; unresolved: conflicting
    values without a decision; no_value: states only; single: one source's value.
    """
    kind = (
        F.when(F.col("rule").isNotNull(), "selected")
        .when(F.col("n_values") > 1, "unresolved")
        .when(F.col("n_values") == 0, "no_value")
        .when(F.size("owners") > 1, "equivalent")
        .otherwise("single")
    )
    flat = resolved.select("entity_type", "field", kind.alias("kind"))
    count = lambda k: F.sum(F.when(F.col("kind") == k, 1).otherwise(0)).alias(f"n_{k}")
    return flat.groupingSets([[], ["entity_type"], ["entity_type", "field"]], "entity_type", "field").agg(*[count(k) for k in ("equivalent", "selected", "unresolved", "no_value", "single")])


def strip_revisions(owners: Column) -> Column:
    """Owners without their revisions, so that a new revision alone is no change."""
    return F.array_distinct(F.transform(owners, lambda o: o["source"]))
