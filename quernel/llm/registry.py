"""Queries of the subpackage, by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quernel.llm.encoding import encode_corpus
from quernel.llm.fusion import fuse_records, surviving_records
from quernel.llm.leakage import find_leaks
from quernel.llm.pii import find_personal, redact_documents
from quernel.session import table


#: Fields that say one thing together and are taken from one source.
BUNDLES = {"levels": ["minLevel", "maxLevel"], "quest_levels": ["questLevel", "requiredLevel"], "place": ["zoneID", "spawns"]}


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    fused = fuse_records(table(spark, sf, "source_records"), table(spark, sf, "field_policy"))
    return fused.filter("n_values > 1").select("entity_type", "entity_id", "field", "source")


def p2_survivors(spark: SparkSession, sf: str) -> DataFrame:
    """One record per entity with all its fields, dependent ones from one source; unlisted sources come last."""
    fused = fuse_records(table(spark, sf, "source_records"), table(spark, sf, "field_policy"), BUNDLES, [("name", "rank"), ("zoneID", "factionID")], unlisted=True)
    return surviving_records(fused)


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encode_corpus(table(spark, sf, "documents"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return find_leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return find_personal(table(spark, sf, "documents")).select("doc_id", "pii_type", "start_pos")


def p10_redacted(spark: SparkSession, sf: str) -> DataFrame:
    return redact_documents(table(spark, sf, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p2_found, p2_survivors, p8_ids, p9_found, p10_found, p10_redacted)}


_ORDER = "(generated_at, delivered_at, row_id)"
_LEAF = "CASE WHEN j.type IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN 'NUMBER' ELSE j.type END || CASE WHEN j.type IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(CAST(j.atom AS DOUBLE) AS VARCHAR) WHEN j.type IN ('VARCHAR', 'BOOLEAN') THEN nfc_normalize(j.atom ->> '$') ELSE '' END"

SQL = {
    "p2_found": rf"""
WITH latest AS (SELECT entity_type, entity_id, source, arg_max({{'st': record_status, 'a': attributes, 's': field_states}}, {_ORDER}) AS r FROM source_records WHERE entity_type IS NOT NULL AND entity_id IS NOT NULL AND source IS NOT NULL GROUP BY entity_type, entity_id, source),
cells AS (SELECT entity_type, entity_id, source, r.s AS s, unnest(map_entries(r.a)) AS e FROM latest WHERE r.st = 'present'),
held AS (SELECT entity_type, entity_id, source, e.key AS field, e.value AS v FROM cells WHERE e.value IS NOT NULL AND NOT regexp_full_match(e.value, '\s*(null|""|\[\s*\])?\s*') AND coalesce(s[e.key], '') NOT IN ('missing', 'unsupported', 'unavailable', 'invalid', 'conflicting')),
parsed AS (SELECT v, CAST(v AS JSON) AS j, json_type(CAST(v AS JSON)) = 'ARRAY' AND json_type(CAST(v AS JSON), '$[0]') NOT IN ('VARCHAR', 'ARRAY', 'BOOLEAN', 'NULL') AS is_set FROM (SELECT DISTINCT v FROM held)),
parts AS (SELECT v, is_set, unnest(CASE WHEN is_set THEN CAST(j AS JSON[]) ELSE [j] END) AS x FROM parsed),
texts AS (SELECT v, is_set, x, string_agg(j.fullkey || '=' || {_LEAF}, ';' ORDER BY j.fullkey) AS c FROM (SELECT DISTINCT v, is_set, x FROM parts) p, json_tree(p.x) j GROUP BY ALL),
keys AS (SELECT v, is_set || ':' || string_agg(DISTINCT c, '|' ORDER BY c) AS k FROM texts GROUP BY v, is_set),
fields AS (SELECT entity_type, entity_id, field, count(DISTINCT k) AS n, arg_min(source, priority) AS source FROM held JOIN keys USING (v) LEFT JOIN field_policy USING (entity_type, field, source) GROUP BY ALL)
SELECT entity_type, entity_id, field, source FROM fields WHERE n > 1 AND source IS NOT NULL""",
}


def oracle_sql() -> dict[str, str]:
    return SQL
