"""Queries of the reconciliation operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.operators.reconcile import dispositions, explode_fields, merged_records, resolve
from quernel.plans.adapters import order_fields, order_policy
from quernel.session import table


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return resolve(order_fields(spark, sf), order_policy(spark))


def _entities(spark: SparkSession, sf: str) -> DataFrame:
    records = table(spark, sf, "source_records").filter("record_status = 'present' AND entity_id IS NOT NULL AND source IS NOT NULL")
    newest = records.groupBy("entity_type", "entity_id", "source").agg(F.max_by(F.struct("source_revision", "attributes", "field_states"), F.struct("generated_at", "delivered_at", "row_id")).alias("_r"))
    flat = newest.select("entity_type", "entity_id", "source", "_r.*")
    return resolve(explode_fields(flat), table(spark, sf, "field_policy"))


def merge_orders(spark: SparkSession, sf: str) -> DataFrame:
    merged = merged_records(_orders(spark, sf))
    return merged.select(F.col("entity_id").cast("bigint").alias("order_key"), F.get_json_object(F.col("attributes")["status"], "$").alias("status"), F.col("attributes")["total"].cast("bigint").alias("total"), F.col("field_states")["status"].alias("status_state"))


def conflict_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = _orders(spark, sf).filter("n_values > 1")
    text = F.concat_ws(";", F.transform("candidates", lambda c: F.concat_ws("=", c["source"], F.coalesce(c["value"], c["state"]))))
    return rows.select(F.col("entity_id").cast("bigint").alias("order_key"), "field", F.coalesce("value", "state").alias("outcome"), text.alias("candidates"))


def dispositions_orders(spark: SparkSession, sf: str) -> DataFrame:
    return dispositions(_orders(spark, sf))


def provenance_union(spark: SparkSession, sf: str) -> DataFrame:
    rows = _orders(spark, sf).select("entity_id", F.explode("owners.source").alias("source"))
    return rows.groupBy(F.col("entity_id").cast("bigint").alias("order_key")).agg(F.concat_ws(",", F.array_sort(F.collect_set("source"))).alias("sources"))


def reconcile_entities(spark: SparkSession, sf: str) -> DataFrame:
    """One merged record per entity of source_records."""
    return merged_records(_entities(spark, sf))


def dispositions_entities(spark: SparkSession, sf: str) -> DataFrame:
    return dispositions(_entities(spark, sf))


_LINES = "SELECT l_orderkey AS k, CASE WHEN max(l_linestatus) = min(l_linestatus) THEN max(l_linestatus) ELSE 'P' END AS status, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY 1"
_BOTH = f"WITH l AS ({_LINES}), o AS (SELECT o_orderkey AS k, o_orderstatus AS status, CAST(round(o_totalprice * 100) AS BIGINT) AS total FROM orders), b AS (SELECT coalesce(o.k, l.k) AS k, o.status AS os, l.status AS ls, o.total AS ot, l.total AS lt FROM o FULL JOIN l ON o.k = l.k)"

SQL = {
    "merge_orders": f"{_BOTH} SELECT k AS order_key, CASE WHEN os = ls OR ls IS NULL THEN os WHEN os IS NULL THEN ls END AS status, coalesce(lt, ot) AS total, CASE WHEN os <> ls THEN 'conflicting' END AS status_state FROM b",
    "conflict_rows": f"""{_BOTH} SELECT k AS order_key, 'status' AS field, 'conflicting' AS outcome, 'lines="' || ls || '";orders="' || os || '"' AS candidates FROM b WHERE os <> ls
        UNION ALL SELECT k, 'total', CAST(lt AS VARCHAR), 'lines=' || lt || ';orders=' || ot FROM b WHERE lt <> ot""",
    "dispositions_orders": f"""{_BOTH}, f AS (SELECT 'order' AS entity_type, 'status' AS field, CASE WHEN os <> ls THEN 'unresolved' WHEN os = ls THEN 'equivalent' ELSE 'single' END AS kind FROM b
        UNION ALL SELECT 'order', 'total', CASE WHEN ot <> lt THEN 'selected' WHEN ot = lt THEN 'equivalent' ELSE 'single' END FROM b)
        SELECT entity_type, field, count(*) FILTER (kind = 'equivalent') AS n_equivalent, count(*) FILTER (kind = 'selected') AS n_selected, count(*) FILTER (kind = 'unresolved') AS n_unresolved, count(*) FILTER (kind = 'no_value') AS n_no_value, count(*) FILTER (kind = 'single') AS n_single
        FROM f GROUP BY GROUPING SETS ((), (entity_type), (entity_type, field))""",
    "provenance_union": f"{_BOTH} SELECT k AS order_key, CASE WHEN os IS NULL THEN 'lines' WHEN ls IS NULL THEN 'orders' WHEN ls <> os OR ls = os THEN 'lines,orders' END AS sources FROM b",
}

QUERIES = [merge_orders, conflict_rows, dispositions_orders, provenance_union, reconcile_entities, dispositions_entities]
