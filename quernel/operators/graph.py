"""Edges between entities, as their records name them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.operators.references import plain_id

#: Attributes that become edges of their own kind; lists keep their order.
LIST_EDGES = ("preQuestSingle", "preQuestGroup", "exclusiveTo", "breadcrumbs", "childQuests", "inGroupWith")
SINGLE_EDGES = ("nextQuestInChain", "parentQuest", "breadcrumbForQuestId")
PROVIDER_EDGES = ("startedBy", "finishedBy")
_EDGE = "array<struct<to_type: string, to_id: string, kind: string, role: string, ord: int>>"


def _edge(kind: str | Column, to_type: Column, to_id: Column, role: Column, ord_: Column) -> Column:
    return F.struct(to_type.alias("to_type"), to_id.alias("to_id"), (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), role.alias("role"), ord_.alias("ord"))


def edges_of(attributes: Column) -> Column:
    """Edges of one record's attributes (field -> JSON text): providers, ordered lists, single links; ids of 0 and unreadable values give none."""
    none_s, none_i = F.lit(None).cast("string"), F.lit(None).cast("int")
    empty = F.array().cast(_EDGE)

    def provided(field: str) -> Column:
        listed = F.from_json(attributes[field], "array<struct<id: string, type: string>>")
        return F.transform(listed, lambda p: _edge("quest-provider", p["type"], plain_id(p["id"]), F.lit(field), none_i)).cast(_EDGE)

    def ordered(field: str) -> Column:
        ids = F.from_json(attributes[field], "array<string>")
        return F.transform(ids, lambda i, n: _edge(field, F.lit("quest"), plain_id(F.ltrim(i, F.lit("-"))), none_s, n)).cast(_EDGE)

    def single(field: str) -> Column:
        one = plain_id(attributes[field])
        return F.when(one.isNotNull(), F.array(_edge(field, F.lit("quest"), one, none_s, none_i)).cast(_EDGE))

    parts = [F.coalesce(make(f), empty) for make, fields in ((provided, PROVIDER_EDGES), (ordered, LIST_EDGES), (single, SINGLE_EDGES)) for f in fields]
    return F.filter(F.flatten(F.array(*parts)), lambda e: e["to_id"].isNotNull() & e["to_type"].isNotNull())


def record_edges(records: DataFrame) -> DataFrame:
    """from_type, from_id, to_type, to_id, kind, role, ord, source: the edges that records name. Null attributes name none."""
    rows = records.select("entity_type", "entity_id", "source", F.explode(edges_of(F.col("attributes"))).alias("_e"))
    return rows.select(F.col("entity_type").alias("from_type"), F.col("entity_id").alias("from_id"), "_e.to_type", "_e.to_id", "_e.kind", "_e.role", "_e.ord", "source")


def chain_entries(edges: DataFrame) -> DataFrame:
    """quest_id, links: kind -> ids in order, one row per quest that has any.

    Pairs combine before the links of a quest come together, so repeated edges do no harm.
    """
    own = edges.filter(F.col("kind").isin(*LIST_EDGES, *SINGLE_EDGES)).groupBy("from_id", "kind", "to_id").agg(F.min("ord").alias("ord"))
    lists = own.groupBy("from_id", "kind").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "to_id"))), lambda e: e["to_id"]).alias("ids"))
    return lists.groupBy(F.col("from_id").alias("quest_id")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "ids")))).alias("links"))
