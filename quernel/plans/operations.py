"""Queries of the general operators, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.functions import scalars
from quernel.functions.canonical import canonical_json
from quernel.operators import aggregates, intervals, joins
from quernel.operators.reconcile import state_rank
from quernel.plans.adapters import cents
from quernel.session import table

QUERIES: list[Callable[[SparkSession, str], DataFrame]] = []
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a query; sql gives the same rows in DuckDB."""

    def keep(f: Callable) -> Callable:
        QUERIES.append(f)
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


#: Numbers to a row of an index.
_WIDTH = 1 << 20


# ---- states, edges and hierarchies of the entity tables


@query("""WITH s AS (SELECT entity_type, entity_id, unnest(map_entries(field_states)) AS e FROM source_records),
    r AS (SELECT entity_type, entity_id, e.key AS field, coalesce(nullif(list_position(['invalid','conflicting','unsupported','unavailable','missing','empty'], e.value), 0), 99) AS n, e.value AS state FROM s)
    SELECT entity_type, entity_id, field, arg_min(state, n) AS state FROM r GROUP BY ALL""")
def state_precedence(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "source_records").select("entity_type", "entity_id", F.explode("field_states").alias("field", "state"))
    return rows.groupBy("entity_type", "entity_id", "field").agg(F.min_by("state", state_rank(F.col("state"))).alias("state"))


@query("""WITH k AS (SELECT DISTINCT entity_type AS t, entity_id AS i FROM source_records UNION SELECT 'zone', CAST(area_id AS VARCHAR) FROM zones)
    SELECT kind, count(*) AS n_dangling FROM relationships r LEFT JOIN k a ON a.t = r.from_type AND a.i = r.from_id LEFT JOIN k b ON b.t = r.to_type AND b.i = r.to_id WHERE a.i IS NULL OR b.i IS NULL GROUP BY kind""")
def dangling_edges(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "source_records").select(F.col("entity_type").alias("type"), F.col("entity_id").alias("id"))
    zones = table(spark, sf, "zones").select(F.lit("zone").alias("type"), F.col("area_id").cast("string").alias("id"))
    found = joins.dangling_edges(table(spark, sf, "relationships"), known.unionByName(zones))
    return found.groupBy("kind").agg(F.count("*").alias("n_dangling"))


_EDGE_SIDES = """WITH k AS (SELECT from_type, from_id, kind, to_type, to_id, list(DISTINCT source) AS have FROM relationships WHERE source IS NOT NULL GROUP BY ALL), s AS (SELECT DISTINCT source FROM relationships WHERE source IS NOT NULL),
    c AS (SELECT s.source, k.*, CASE WHEN NOT list_contains(have, s.source) THEN 'rightOnly' WHEN len(have) > 1 THEN 'equal' ELSE 'leftOnly' END AS status FROM k, s)"""


@query(f"{_EDGE_SIDES} SELECT source, from_type, from_id, kind, to_type, to_id, status FROM c")
def compare_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Edges of every source against those of all others."""
    return joins.compare_sources(table(spark, sf, "relationships"), "source", ["from_type", "from_id", "kind", "to_type", "to_id"])


@query(f"{_EDGE_SIDES} SELECT source, status, count(*) AS n FROM c GROUP BY ALL")
def compare_counts(spark: SparkSession, sf: str) -> DataFrame:
    return compare_edges(spark, sf).groupBy("source", "status").agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT c_nationkey AS k, sum(CAST(round(c_acctbal * 100) AS BIGINT)) // count(*) AS v FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS k, sum(CAST(round(s_acctbal * 100) AS BIGINT)) // count(*) AS v FROM supplier GROUP BY 1)
    SELECT coalesce(a.k, b.k) AS nation_key, CASE WHEN b.k IS NULL THEN 'leftOnly' WHEN a.k IS NULL THEN 'rightOnly' WHEN abs(a.v - b.v) <= 50000 THEN 'equal' ELSE 'changed' END AS status FROM a FULL JOIN b ON a.k = b.k""")
def tolerance_diff(spark: SparkSession, sf: str) -> DataFrame:
    def mean(name: str, p: str) -> DataFrame:
        return table(spark, sf, name).groupBy(F.col(f"{p}_nationkey").alias("nation_key")).agg(F.expr(f"sum(cast(round({p}_acctbal * 100) as bigint)) div count(*)").alias("v"))

    return joins.compare_keys(mean("customer", "c"), mean("supplier", "s"), ["nation_key"], joins.within(F.col("l_v"), F.col("r_v"), 50000))


@query("""SELECT from_type, from_id, kind, string_agg(to_id, ',' ORDER BY ord, to_id) AS targets FROM (SELECT DISTINCT from_type, from_id, kind, ord, to_id FROM relationships WHERE ord IS NOT NULL AND to_id <> '') GROUP BY ALL""")
def ordered_edges(spark: SparkSession, sf: str) -> DataFrame:
    edges = table(spark, sf, "relationships").filter("ord IS NOT NULL AND to_id <> ''").select("from_type", "from_id", "kind", "ord", "to_id").distinct()
    return edges.groupBy("from_type", "from_id", "kind").agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("ord", "to_id"))), lambda e: e["to_id"])).alias("targets"))


@query("""WITH n AS (SELECT DISTINCT from_id, to_id FROM relationships WHERE kind = 'nextQuestInChain' AND to_id <> '') SELECT a.from_id AS quest_id, a.to_id AS next_id, b.to_id AS after_next_id FROM n a LEFT JOIN n b ON a.to_id = b.from_id""")
def chain_edges(spark: SparkSession, sf: str) -> DataFrame:
    links = table(spark, sf, "relationships").filter("kind = 'nextQuestInChain' AND to_id <> ''").select("from_id", "to_id").distinct()
    ahead = links.select(F.col("from_id").alias("_f"), F.col("to_id").alias("after_next_id"))
    return links.join(ahead, F.col("to_id") == F.col("_f"), "left").select(F.col("from_id").alias("quest_id"), F.col("to_id").alias("next_id"), "after_next_id")


@query("""SELECT parent_type, parent_id, child_type, child_id, count(*) AS n_observed, coalesce(string_agg(DISTINCT source_path, '|' ORDER BY source_path), '') AS paths FROM containments WHERE parent_id IS NOT NULL GROUP BY ALL""")
def containment_edges(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "containments").filter("parent_id IS NOT NULL")
    return rows.groupBy("parent_type", "parent_id", "child_type", "child_id").agg(F.count("*").alias("n_observed"), F.concat_ws("|", F.array_sort(F.collect_set("source_path"))).alias("paths"))


@query("""SELECT ui_map_id, area_id // 1048576 AS chunk, string_agg(area_id, ',' ORDER BY area_id) AS areas FROM zones WHERE ui_map_id IS NOT NULL GROUP BY ALL""")
def reverse_map(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.inverted_index(table(spark, sf, "zones"), "ui_map_id", "area_id", _WIDTH).withColumnRenamed("members", "areas")


@query("""SELECT d.doc_id, z.zone_name, z.ui_map_id FROM documents d LEFT JOIN zones z ON d.zone_id = z.area_id""")
def lookup_zone(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "zone_id")
    return docs.join(table(spark, sf, "zones"), F.col("zone_id") == F.col("area_id"), "left").select("doc_id", "zone_name", "ui_map_id")


@query("""WITH s AS (SELECT source, source_revision, count(*) AS rows, count(DISTINCT (entity_type, entity_id)) AS entities FROM snapshot_rows GROUP BY ALL), m AS (SELECT source, source_revision, CAST(sum(record_count) AS BIGINT) AS declared, min(status) AS status FROM manifests GROUP BY ALL)
    SELECT m.source, m.source_revision, declared, coalesce(entities, 0) AS entities, coalesce(rows, 0) AS row_count, declared = coalesce(entities, 0) AS matches FROM m LEFT JOIN s USING (source, source_revision)""")
def manifest_counts(spark: SparkSession, sf: str) -> DataFrame:
    held = table(spark, sf, "snapshot_rows").groupBy("source", "source_revision").agg(F.count("*").alias("row_count"), F.count_distinct("entity_type", "entity_id").alias("entities"))
    told = table(spark, sf, "manifests").groupBy("source", "source_revision").agg(F.sum("record_count").alias("declared"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return told.join(held, ["source", "source_revision"], "left").select("source", "source_revision", "declared", zero("entities"), zero("row_count"), (F.col("declared") == F.coalesce("entities", F.lit(0))).alias("matches"))


# ---- intervals


_SPANS = "SELECT user_id, event_id, event_id AS s, event_id + CAST(floor(value * 20) AS BIGINT) AS e FROM events"


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    spans = table(spark, sf, "events").select("user_id", "event_id", F.col("event_id").alias("start"), (F.col("event_id") + F.floor(F.col("value") * 20)).alias("end"))
    return intervals.enclosing(spans.select("user_id", F.col("event_id").alias("child_id"), "start", "end"), spans.select("user_id", F.col("event_id").alias("parent_id"), "start", "end", F.col("event_id").alias("ordinal")), ["user_id"], 512)


@query(f"""WITH p AS ({_SPANS}) SELECT c.event_id AS child_id, arg_min(p.event_id, (p.e - p.s, p.event_id)) AS parent_id FROM p c JOIN p ON p.user_id = c.user_id AND p.s < c.s AND p.e > c.s GROUP BY 1""")
def containment_innermost(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.innermost(_pairs(spark, sf), ["child_id"])


@query(f"""WITH p AS ({_SPANS}) SELECT c.event_id AS child_id, max(p.event_id) AS parent_id FROM p c JOIN p ON p.user_id = c.user_id AND p.s < c.s AND p.e > c.s GROUP BY 1""")
def enclosing_last(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.last_enclosing(_pairs(spark, sf), ["child_id"])


# ---- choices and indexes


@query("""WITH v AS (SELECT c_nationkey AS k, c_mktsegment AS s, count(*) AS n FROM customer GROUP BY ALL)
    SELECT k AS c_nationkey, arg_min(s, (-n, s)) AS c_mktsegment, round(max(n) / sum(n), 3) AS confidence, CAST(sum(n) AS BIGINT) AS samples FROM v GROUP BY 1""")
def mode_vote(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.mode_vote(table(spark, sf, "customer"), "c_nationkey", "c_mktsegment")


@query("""SELECT l_suppkey, k // 1048576 AS chunk, string_agg(k, ',' ORDER BY k) AS members FROM (SELECT DISTINCT l_suppkey, l_orderkey AS k FROM lineitem) GROUP BY ALL""")
def inverted_orders(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.inverted_index(table(spark, sf, "lineitem"), "l_suppkey", "l_orderkey", _WIDTH)


@query("""WITH n AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS r FROM part) SELECT CAST(ceil(r / 500) AS BIGINT) AS shard_no, min(p_partkey) AS id_first, max(p_partkey) AS id_last, count(*) AS n_rows FROM n GROUP BY 1""")
def shards(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.shards(table(spark, sf, "part").select("p_partkey"), "p_partkey", 500)


@query("""SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY ALL""")
def first_wins(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.first_wins(table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("""SELECT user_id, event_type, arg_max(props, (ts, event_id)) AS props, max(ts) AS written_at FROM events GROUP BY ALL""")
def last_writer(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.last_writer(table(spark, sf, "events"), ["user_id", "event_type"], "props", ["ts", "event_id"])


@query("""SELECT l_orderkey, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN min(l_returnflag) END AS l_returnflag, count(DISTINCT l_returnflag) AS n_values FROM lineitem GROUP BY 1""")
def repeat_declarations(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.repeat_declarations(table(spark, sf, "lineitem"), "l_orderkey", "l_returnflag")


@query("""SELECT l_orderkey, min(l_linestatus) AS l_linestatus FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linestatus) = 1""")
def unique_candidate(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.unique_candidate(table(spark, sf, "lineitem"), "l_orderkey", "l_linestatus")


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) ORDER BY 1 LIMIT 100""")
def pending_jobs(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.pending(table(spark, sf, "orders").select("o_orderkey"), done, "o_orderkey", 100)


@query("""SELECT o_orderkey AS order_key FROM orders EXCEPT SELECT l_orderkey FROM lineitem""")
def retained_ids(spark: SparkSession, sf: str) -> DataFrame:
    return joins.pending(table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_key")), table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_key")), "order_key")


@query("""WITH a AS (SELECT event_type, user_id, count(*) FILTER (day(ts) <= 15) AS b, count(*) FILTER (day(ts) > 15) AS n FROM events GROUP BY ALL)
    SELECT event_type, user_id, b AS n_before, n AS n_after, n >= 0.5 * b AS kept FROM a WHERE b > 0 AND n > 0""")
def retention(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return aggregates.retention(events.filter(F.day("ts") <= 15), events.filter(F.day("ts") > 15), ["event_type", "user_id"])


@query("""SELECT event_id, user_id, CAST(sum(event_id % 7 + 1) OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS BIGINT) AS absolute_id FROM events""")
def running_ids(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.running_ids(table(spark, sf, "events"), "user_id", "event_id", F.col("event_id") % 7).select("event_id", "user_id", "absolute_id")


@query("""SELECT n.n_name, r.r_name, count(c_custkey) AS n_customers, CAST(sum(o.n) AS BIGINT) AS n_orders FROM customer c JOIN nation n ON c_nationkey = n_nationkey JOIN region r ON n_regionkey = r_regionkey
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o_custkey = c_custkey GROUP BY ALL""")
def zone_bundle(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    customers = table(spark, sf, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    named = customers.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return named.groupBy("n_name", "r_name").agg(F.count("c_custkey").alias("n_customers"), F.sum("n").alias("n_orders"))


@query("""SELECT o_orderkey AS order_key, o_orderstatus AS status, 'orders' AS origin FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT l_orderkey, max(l_linestatus), 'lines' FROM lineitem GROUP BY 1""")
def upsert_routes(spark: SparkSession, sf: str) -> DataFrame:
    base = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("status"), F.lit("orders").alias("origin"))
    changes = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("order_key")).agg(F.max("l_linestatus").alias("status")).withColumn("origin", F.lit("lines"))
    return joins.upsert(base, changes, ["order_key"])


@query("""SELECT l_orderkey, arg_min(l_suppkey, (l_linenumber, l_suppkey)) AS first_supplier, count(DISTINCT l_suppkey) AS n_suppliers FROM lineitem GROUP BY 1""")
def first_provider(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min_by("l_suppkey", F.struct("l_linenumber", "l_suppkey")).alias("first_supplier"), F.count_distinct("l_suppkey").alias("n_suppliers"))


@query("""SELECT p_brand, md5(string_agg(p_partkey || ':' || p_name || ':' || p_size, ';' ORDER BY p_partkey)) AS digest FROM part GROUP BY 1""")
def semantic_hash(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name", "p_size"))).alias("_r"))
    line = lambda r: F.concat_ws(":", r["p_partkey"].cast("string"), r["p_name"], r["p_size"].cast("string"))
    return rows.select("p_brand", F.md5(F.concat_ws(";", F.transform("_r", line))).alias("digest"))


@query("""SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'O') AS n_o, count(*) FILTER (o_orderstatus = 'P') AS n_p FROM orders GROUP BY 1""")
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(*[F.count_if(F.col("o_orderstatus") == s).alias(f"n_{s.lower()}") for s in "FOP"])


@query("""(SELECT n_nationkey AS k, 'both' AS part FROM nation INTERSECT SELECT s_nationkey, 'both' FROM supplier) UNION ALL (SELECT n_nationkey, 'nation' FROM nation EXCEPT SELECT s_nationkey, 'nation' FROM supplier) UNION ALL SELECT k, 'any' FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier)""")
def set_ops(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"))
    supplier = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"))
    customer = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k"))
    named = lambda df, n: df.withColumn("part", F.lit(n))
    return named(nation.intersect(supplier), "both").unionByName(named(nation.subtract(supplier), "nation")).unionByName(named(customer.union(supplier).distinct(), "any"))


@query("""SELECT k, side, n FROM (SELECT o_orderpriority AS k, 'before' AS side, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1 EXCEPT SELECT o_orderpriority, 'before', count(*) FROM orders GROUP BY 1)
    UNION ALL (SELECT o_orderpriority, 'after', count(*) FROM orders GROUP BY 1 EXCEPT SELECT o_orderpriority, 'after', count(*) FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)""")
def semantic_changes(spark: SparkSession, sf: str) -> DataFrame:
    count = lambda df, r: df.groupBy(F.col("o_orderpriority").alias("k")).agg(F.count("*").alias("n")).withColumn("revision", F.lit(r))
    orders = table(spark, sf, "orders")
    return joins.semantic_changes(count(orders.filter("o_orderstatus <> 'P'"), "r1"), count(orders, "r2"), ["revision"])


@query("""SELECT l_partkey AS part_key, string_agg(k, ',' ORDER BY k) AS orders FROM (SELECT DISTINCT l_partkey, CAST(l_orderkey + 1 AS VARCHAR) AS k FROM lineitem) GROUP BY 1""")
def id_set_text_order(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("part_key")).agg(scalars.id_set(F.collect_set(F.col("l_orderkey") + 1)).alias("_o"))
    return ids.select("part_key", F.concat_ws(",", "_o").alias("orders"))


# ---- scalar functions over whole tables


@query("""SELECT event_id, '{"k":' || CAST(json_extract_string(props, '$.k') AS BIGINT) || '}' AS props FROM events""")
def canonical_props(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", canonical_json(F.col("props")).alias("props"))


@query("""SELECT e.key AS field, count(*) AS n, count(*) FILTER (regexp_full_match(e.value, '-?(0|[1-9][0-9]*)')) AS n_exact FROM (SELECT unnest(map_entries(attributes)) AS e FROM source_records) GROUP BY 1""")
def exact_integers(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "source_records").select(F.explode("attributes").alias("field", "value"))
    return rows.groupBy("field").agg(F.count("*").alias("n"), F.count_if(scalars.is_exact_integer(F.col("value"))).alias("n_exact"))


@query("""SELECT doc_id, md5(nfc_normalize(text)) AS digest FROM documents""")
def nfc_documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.md5(scalars.nfc(F.col("text"))).alias("digest"))


@query("""SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_name), '[''’]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part""")
def slugs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", scalars.slugify(F.col("p_name")).alias("slug"))


_BITS = [(1, "dungeon"), (2, "raid"), (4, "pvp"), (8, "daily"), (16, "weekly")]


@query("""SELECT p_partkey, concat_ws(',', CASE WHEN p_size & 1 <> 0 THEN 'dungeon' END, CASE WHEN p_size & 2 <> 0 THEN 'raid' END, CASE WHEN p_size & 4 <> 0 THEN 'pvp' END, CASE WHEN p_size & 8 <> 0 THEN 'daily' END, CASE WHEN p_size & 16 <> 0 THEN 'weekly' END) AS flags, CAST(p_size & ~31 AS BIGINT) AS unknown FROM part""")
def bitmask_decode(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size").cast("bigint")
    return table(spark, sf, "part").select("p_partkey", F.concat_ws(",", scalars.decode_bits(size, _BITS)).alias("flags"), scalars.unknown_bits(size, _BITS).alias("unknown"))


@query("""SELECT p_brand, CAST(bit_or(p_size) AS BIGINT) AS mask FROM part GROUP BY 1""")
def bit_or_masks(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.bit_or_masks(table(spark, sf, "part"), "p_brand", F.col("p_size").cast("bigint"))


@query("""SELECT doc_id, contains(lower(coalesce(text, '')), 'daily') AS daily, contains(lower(coalesce(text, '')), 'dungeon') AS dungeon, contains(lower(coalesce(text, '')), 'level:') AS leveled FROM documents""")
def infobox_flags(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", *scalars.text_flags(F.col("text"), {"daily": "daily", "dungeon": "dungeon", "leveled": "level:"}))


@query("""SELECT doc_id, CASE WHEN source = 'infobox' THEN 'markup' WHEN contains(text, 'daily') THEN 'repeatable' WHEN regexp_matches(text, '[Gg]roup') THEN 'group' ELSE 'normal' END AS category FROM documents""")
def text_category(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    rules = [(F.col("source") == "infobox", "markup"), (text.contains("daily"), "repeatable"), (text.rlike("[Gg]roup"), "group")]
    return table(spark, sf, "documents").select("doc_id", scalars.first_match(rules, "normal").alias("category"))


@query(r"""WITH i AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '\[item=(\d{1,18})\]', 1))) AS t FROM documents) SELECT doc_id, string_agg(t, ',' ORDER BY CAST(t AS BIGINT)) AS items FROM i GROUP BY 1""")
def markup_ids(spark: SparkSession, sf: str) -> DataFrame:
    ids = scalars.markup_ids(F.col("text"), "item")
    return table(spark, sf, "documents").select("doc_id", F.concat_ws(",", F.transform(ids, lambda i: i.cast("string"))).alias("items")).filter("items <> ''")


@query(r"""WITH u AS (SELECT doc_id, unnest(regexp_extract_all(text, 'https?://[^\s<>"\]]+')) AS url FROM documents) SELECT doc_id, regexp_replace(url, '[?#].*$', '') AS path, TRY_CAST(nullif(regexp_extract(regexp_replace(url, '[?#].*$', ''), '(\d{1,18})$', 1), '') AS BIGINT) AS number, count(*) AS n FROM u GROUP BY ALL""")
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    urls = table(spark, sf, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"https?://[^\s<>\"\]]+"), F.lit(0))).alias("url"))
    path, number = scalars.url_parts(F.col("url"))
    return urls.select("doc_id", path.alias("path"), number.alias("number")).groupBy("doc_id", "path", "number").agg(F.count("*").alias("n"))


@query("""SELECT l_orderkey, CAST(sum(a) AS BIGINT) AS a, CAST(sum(b) AS BIGINT) AS b FROM (SELECT l_orderkey, CAST(round(l_discount * 100) AS BIGINT) AS a, CAST(round(l_tax * 100) AS BIGINT) AS b FROM lineitem) WHERE a <> 0 OR b <> 0 GROUP BY 1""")
def pair_decode(spark: SparkSession, sf: str) -> DataFrame:
    lists = table(spark, sf, "lineitem").select("l_orderkey", F.array(F.array(cents("l_discount"), cents("l_tax"))).alias("_p"))
    return lists.select("l_orderkey", F.explode(scalars.pairs(F.col("_p"))).alias("_p")).groupBy("l_orderkey").agg(F.sum("_p.a").alias("a"), F.sum("_p.b").alias("b"))


@query("""SELECT e.key AS field, count(*) AS n, CAST(sum(CAST(TRY_CAST(e.value AS DECIMAL(38,6)) AS BIGINT)) AS BIGINT) AS total FROM (SELECT unnest(map_entries(attributes)) AS e FROM source_records) WHERE TRY_CAST(e.value AS DECIMAL(38,6)) = floor(TRY_CAST(e.value AS DECIMAL(38,6))) AND TRY_CAST(e.value AS DECIMAL(38,6)) <> 0 GROUP BY 1""")
def lenient_integers(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "source_records").select(F.explode("attributes").alias("field", "value")).withColumn("i", scalars.lenient_int(F.col("value"))).filter("i IS NOT NULL")
    return rows.groupBy("field").agg(F.count("*").alias("n"), F.sum("i").alias("total"))
