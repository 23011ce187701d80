"""Queries over the canonical records themselves: contract, shapes, edges, arrivals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.functions.canonical import canonical_map
from quernel.functions.shapes import normalize
from quernel.operators import graph
from quernel.operators.conform import conform_fields, policy_errors
from quernel.session import table
from quernel.sources.datasets import record_errors
from quernel.streaming.upsert import late_counts, newest


def record_edges(spark: SparkSession, sf: str) -> DataFrame:
    """How many edges of each kind the records of each source name, and between how many entities."""
    edges = graph.record_edges(table(spark, sf, "source_records"))
    return edges.groupBy("source", "kind", "to_type").agg(F.count("*").alias("n_edges"), F.count_distinct("to_id").alias("n_targets"))


def chain_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links of every quest by kind, over all sources."""
    chains = graph.chain_entries(graph.record_edges(table(spark, sf, "source_records")))
    return chains.select("quest_id", F.explode("links").alias("kind", "ids")).select("quest_id", "kind", F.concat_ws(",", "ids").alias("ids"))


def contract_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Broken rules of the record contract, by source and rule."""
    rows = table(spark, sf, "source_records").select("source", F.explode(record_errors()).alias("rule"))
    return rows.groupBy("source", "rule").agg(F.count("*").alias("n"))


def normalized_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Outcomes of bringing every field to its shared shape: values, states and different values."""
    long = table(spark, sf, "source_records").select("entity_type", F.explode(canonical_map(F.col("attributes"))).alias("field", "text"))
    shaped = long.filter("text <> 'null'").select("entity_type", "field", normalize(F.col("field"), F.col("text")).alias("o"))
    return shaped.groupBy("entity_type", "field").agg(F.count("o.value").alias("n_values"), F.count("o.state").alias("n_invalid"), F.count_distinct("o.value").alias("n_distinct"))


def conformed_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """What becomes of every field of every source: taken or misshapen (shaped), marked, cleared or excluded."""
    rows = conform_fields(table(spark, sf, "source_records")).filter("field <> 'spawnPresence'")
    outcome = F.when(F.col("outcome").isin("taken", "misshapen"), "shaped").otherwise(F.col("outcome"))
    return rows.groupBy("source", "entity_type", "field", outcome.alias("outcome")).agg(F.count("*").alias("n_rows"), F.count_distinct("entity_id").alias("n_entities"))


def conformed_integers(spark: SparkSession, sf: str) -> DataFrame:
    """Levels, ranks and the like in their shared shape: how many values, what they add up to, how many fit no shape."""
    rows = conform_fields(table(spark, sf, "source_records")).filter(F.col("field").isin("requiredLevel", "minLevel", "maxLevel", "itemLevel", "questLevel", "zoneID") & F.col("outcome").isin("taken", "misshapen"))
    return rows.groupBy("source", "field").agg(F.count("value").alias("n_values"), F.sum(F.col("value").try_cast("bigint")).alias("total"), F.count_if(F.col("outcome") == "misshapen").alias("n_misshapen"))


def policy_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the field policy that break its rules, for the sources of the records that are not edges."""
    return policy_errors(table(spark, sf, "field_policy"), table(spark, sf, "snapshot_rows"))


def event_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Events per day and type, by the operator that also runs on streams."""
    return late_counts(table(spark, sf, "events"))


def newest_records(spark: SparkSession, sf: str) -> DataFrame:
    """The newest record of every entity and source, as the streaming upsert keeps it."""
    rows = table(spark, sf, "source_records").dropna(subset=["entity_type", "entity_id", "source"])
    return newest(rows.select("entity_type", "entity_id", "source", "generated_at", "delivered_at", "row_id", "record_status")).select("entity_type", "entity_id", "source", "row_id", "record_status")


_CELLS = """WITH cells AS (SELECT source, entity_type, entity_id, a, s, unnest(list_distinct(list_concat(coalesce(map_keys(a), []), coalesce(map_keys(s), [])))) AS field FROM (SELECT source, entity_type, entity_id, attributes AS a, field_states AS s FROM source_records)),
    texts AS (SELECT source, entity_type, entity_id, field, list_contains(map_keys(a), field) AS there, coalesce(a[field], 'null') AS t, s[field] AS mark FROM cells),
    decided AS (SELECT *, CASE WHEN NOT coalesce(there, FALSE) OR mark <> 'empty' THEN 'marked' WHEN mark = 'empty' AND trim(t) = 'null' THEN 'cleared'
      WHEN source = 'allthethings' AND entity_type = 'quest' AND field IN ('places', 'finishedBy', 'questLevel', 'objectivesText', 'zoneOrSort') THEN 'excluded' ELSE 'shaped' END AS outcome FROM texts)"""
_FIELDS = "WITH f AS (SELECT source, unnest(map_entries(attributes)) AS e FROM source_records)"
QUERIES = [record_edges, chain_links, contract_errors, normalized_fields, conformed_outcomes, conformed_integers, policy_faults, event_windows, newest_records]
SQL = {
    "record_edges": f"""{_FIELDS}, edges AS (
        SELECT source, 'quest-provider' AS kind, x ->> '$.type' AS to_type, CAST(CAST(x ->> '$.id' AS DOUBLE) AS BIGINT) AS to_id FROM (SELECT source, unnest(CAST(CAST(e.value AS JSON) AS JSON[])) AS x FROM f WHERE e.key IN ('startedBy', 'finishedBy') AND e.value LIKE '[%')
        UNION ALL SELECT source, key, 'quest', abs(CAST(TRY_CAST(x AS DOUBLE) AS BIGINT)) FROM (SELECT source, e.key AS key, unnest(CAST(CAST(e.value AS JSON) AS JSON[])) AS x FROM f WHERE e.key IN ('preQuestSingle', 'preQuestGroup', 'exclusiveTo', 'breadcrumbs', 'childQuests', 'inGroupWith') AND e.value LIKE '[%')
        UNION ALL SELECT source, e.key, 'quest', CAST(TRY_CAST(e.value AS DOUBLE) AS BIGINT) FROM f WHERE e.key IN ('nextQuestInChain', 'parentQuest', 'breadcrumbForQuestId') AND e.value <> 'null')
        SELECT source, kind, to_type, count(*) AS n_edges, count(DISTINCT to_id) AS n_targets FROM edges WHERE to_id <> 0 GROUP BY ALL""",
    "conformed_outcomes": f"{_CELLS} SELECT source, entity_type, field, outcome, count(*) AS n_rows, count(DISTINCT entity_id) AS n_entities FROM decided GROUP BY ALL",
    "conformed_integers": f"""{_CELLS}, numbers AS (SELECT source, field, TRY_CAST(t AS DOUBLE) AS x FROM decided WHERE outcome = 'shaped' AND field IN ('requiredLevel', 'minLevel', 'maxLevel', 'itemLevel', 'questLevel', 'zoneID'))
        SELECT source, field, count(*) FILTER (x = floor(x) AND (x >= 0 OR field = 'questLevel')) AS n_values, CAST(sum(CAST(x AS BIGINT)) FILTER (x = floor(x) AND (x >= 0 OR field = 'questLevel')) AS BIGINT) AS total, count(*) FILTER (NOT coalesce(x = floor(x) AND (x >= 0 OR field = 'questLevel'), FALSE)) AS n_misshapen FROM numbers GROUP BY ALL""",
    "policy_faults": """WITH c AS (SELECT entity_type, field, source, count(*) AS n FROM field_policy GROUP BY ALL),
        r AS (SELECT *, unnest([CASE WHEN trim(entity_type) <> entity_type OR trim(field) <> field OR trim(source) <> source OR '' IN (entity_type, field, source) THEN 'blank' END, CASE WHEN field LIKE '%.%' OR entity_type LIKE '%.%' THEN 'dotted' END, CASE WHEN n > 1 THEN 'repeated source' END, CASE WHEN source NOT IN (SELECT source FROM snapshot_rows WHERE source IS NOT NULL) THEN 'unknown source' END]) AS error FROM c)
        SELECT entity_type, field, source, error FROM r WHERE error IS NOT NULL""",
    "event_windows": "SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL",
    "newest_records": "SELECT entity_type, entity_id, source, arg_max(row_id, (generated_at, delivered_at, row_id)) AS row_id, arg_max(record_status, (generated_at, delivered_at, row_id)) AS record_status FROM source_records GROUP BY ALL",
}
