from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quernel.operators import aggregates, graph, intervals, joins, reconcile
from quernel.operators.compare_copies import difference_paths, near_points
from quernel.sources import client_tables
from quernel.streaming import upsert


def test_edges_of_records(spark):
    data = [("quest", "1", "s", {"startedBy": '[{"id":9,"type":"npc"},{"id":0,"type":"npc"},{"type":"item"}]', "preQuestGroup": "[-4,5.0]", "nextQuestInChain": "7", "parentQuest": "0", "exclusiveTo": "oops"}), ("quest", "2", "s", None), ("quest", "3", "s", {})]
    edges = graph.record_edges(spark.createDataFrame(data, "entity_type string, entity_id string, source string, attributes map<string,string>"))
    got = sorted((e.from_id, e.to_type, e.to_id, e.kind, e.role or "", -1 if e.ord is None else e.ord) for e in edges.collect())
    assert got == [("1", "npc", "9", "quest-provider", "startedBy", -1), ("1", "quest", "4", "preQuestGroup", "", 0), ("1", "quest", "5", "preQuestGroup", "", 1), ("1", "quest", "7", "nextQuestInChain", "", -1)]
    [chain] = graph.chain_entries(edges).collect()
    assert chain.links == {"nextQuestInChain": ["7"], "preQuestGroup": ["4", "5"]}


def test_client_tables(spark, tmp_path):
    head = {"kind": "table", "schemaVersion": 1, "source": "client", "table": "Faction", "clientBuild": 70338, "definitionSha256": "d"}
    rows = [{"kind": "record", "id": 1, "fields": {"Name_lang": "Alliance", "flags": 18446744073709551615}}, {"kind": "record", "id": 2, "fields": {"Name_lang": "", "text": None}}]
    (tmp_path / "Faction.jsonl").write_text("\n".join(json.dumps(x) for x in [head, *rows]) + "\n")
    (tmp_path / "Bad.jsonl").write_text("\n".join(["", json.dumps(rows[0]), json.dumps(rows[0]), '{"kind":"record"}']) + "\n")
    lines = client_tables.table_lines(spark, f"file://{tmp_path}")
    errors = {(r.file.rsplit("/", 1)[1], r.error) for r in client_tables.table_errors(lines).collect()}
    assert errors == {("Bad.jsonl", e) for e in ("not one header", "blank line", "odd row", "repeated id")}
    got = {r.entity_id: r for r in client_tables.table_records(lines).collect()}
    assert got["1"].attributes == {"Name_lang": '"Alliance"', "flags": "18446744073709551615", "name": '"Alliance"', "clientTable": '"Faction"'} and got["1"].source_revision == "70338"
    assert got["2"].field_states == {"text": "unavailable"} and got["2"].entity_type == "faction"


def test_stream_of_records(spark, tmp_path):
    schema = spark.createDataFrame([], "entity_type string, entity_id string, source string, generated_at timestamp_ntz, delivered_at timestamp_ntz, row_id long, note string").schema
    day = lambda n: datetime(2024, 1, n)
    folder = str(tmp_path / "in")
    first = [("npc", "1", "a", day(1), day(1), 1, "old"), ("npc", "2", "a", day(5), day(5), 2, "kept")]
    second = [("npc", "1", "a", day(3), day(3), 3, "new"), ("npc", "2", "a", day(2), day(9), 4, "late")]
    for rows in (first, second):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        query = upsert.upsert_stream(spark, folder, schema, str(tmp_path / "store"), str(tmp_path / "log"))
        assert query.awaitTermination(120)
    assert {r.entity_id: r.note for r in upsert.current(spark, str(tmp_path / "store"), schema).collect()} == {"1": "new", "2": "kept"}


def test_stream_and_batch_counts_agree(spark, tmp_path):
    rows = [(datetime(2024, 1, d, 5), t) for d in (1, 1, 2, 3) for t in ("a", "b")]
    df = spark.createDataFrame(rows, "ts timestamp, event_type string")
    df.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "e"))
    query = upsert.late_counts(stream).writeStream.format("memory").queryName("late_counts").outputMode("complete").trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    key = lambda r: tuple(r)
    assert sorted(spark.table("late_counts").collect(), key=key) == sorted(upsert.late_counts(df).collect(), key=key)


def test_points_within_tolerance():
    load = lambda t: json.loads(t, parse_float=lambda x: (x,), parse_int=lambda x: (x,))
    a, b = load('{"p":{"zone":14,"x":20.0,"y":30.0}}'), load('{"p":{"zone":14,"x":20.005,"y":29.995}}')
    assert difference_paths(a, b, near_points(0.01)) == [] and difference_paths(a, b) == ["p.x", "p.y"]
    assert difference_paths(a, load('{"p":{"zone":15,"x":20.005,"y":30.0}}'), near_points(0.01)) == ["p.x", "p.zone"]
    assert difference_paths(load('{"x":1}'), load('{"x":1.001}'), near_points(0.01)) == ["x"]


def test_reconcile_rules(spark):
    records = [("quest", "1", s, "r", a, f) for s, a, f in [
        ("a", {"name": '"A"', "level": "5.0", "gone": '""', "clear": "null"}, {"clear": "empty", "bad": "invalid"}),
        ("b", {"name": '"B"', "level": "5", "odd": "1"}, {"bad": "missing"}),
        ("c", {"name": '"B"', "odd": "2"}, {"level": "unavailable"}),
        ("d", None, None),
    ]]
    df = spark.createDataFrame(records, "entity_type string, entity_id string, source string, source_revision string, attributes map<string,string>, field_states map<string,string>")
    policy = spark.createDataFrame([("quest", "name", "c", 1), ("quest", "name", "a", 2)], "entity_type string, field string, source string, priority int")
    resolved = reconcile.resolve(reconcile.explode_fields(df), policy)
    got = {r.field: (r.value, r.state, r.rule, [o.source for o in r.owners]) for r in resolved.collect()}
    assert got == {
        "name": ('"B"', None, "quest.name", ["b", "c"]), "level": ("5", None, None, ["a", "b"]), "odd": (None, "conflicting", None, ["b", "c"]),
        "gone": (None, "empty", None, ["a"]), "clear": ("null", None, None, ["a"]), "bad": (None, "invalid", None, ["a", "b"]),
    }
    [merged] = reconcile.merged_records(resolved).collect()
    assert merged.attributes == {"name": '"B"', "level": "5", "clear": "null"} and merged.field_states == {"odd": "conflicting", "gone": "empty", "bad": "invalid"}
    assert [(c.source, c.value) for c in resolved.filter("field = 'name'").first().candidates] == [("a", '"A"'), ("b", '"B"'), ("c", '"B"')]
    # the order of rows and sources changes nothing
    again = reconcile.merged_records(reconcile.resolve(reconcile.explode_fields(df.orderBy(F.desc("source")).repartition(3)), policy)).collect()
    assert again == [merged]
    assert reconcile.resolve(reconcile.explode_fields(df.limit(0)), policy).count() == 0


def test_intervals_of_one_group(spark):
    spans = [(1, 0, 100), (2, 10, 50), (3, 20, 30), (4, 20, 30), (5, 99, 101), (6, None, 3), (7, 60, 60)]
    df = spark.createDataFrame([("f", i, s, e) for i, s, e in spans], "path string, id int, start int, end int")
    pairs = intervals.enclosing(df.select("path", F.col("id").alias("child_id"), "start", "end"), df.select("path", F.col("id").alias("parent_id"), "start", "end", F.col("id").alias("ordinal")), ["path"], 16)
    assert {r.child_id: r.parent_id for r in intervals.innermost(pairs, ["child_id"]).collect()} == {2: 1, 3: 2, 4: 2, 5: 1, 7: 1}
    assert {r.child_id: r.parent_id for r in intervals.last_enclosing(pairs, ["child_id"]).collect()} == {2: 1, 3: 2, 4: 2, 5: 1, 7: 1}


def test_small_operators(spark):
    df = spark.createDataFrame([(k, v) for k, v in [(1, "b"), (1, "a"), (2, "c"), (2, "c"), (3, None), (None, "z")]], "k int, v string")
    assert [tuple(r) for r in aggregates.mode_vote(df, "k", "v").orderBy("k").collect()] == [(1, "a", 0.5, 2), (2, "c", 1.0, 2)]
    assert {r.k: r.members for r in aggregates.inverted_index(df, "k", "v").collect()} == {1: "a,b", 2: "c"}
    assert sorted(r.row_no for r in aggregates.number_rows(df, "k", 3).collect()) == [1, 2, 3, 4, 5, 6]
    assert aggregates.number_rows(df.limit(0), "k").count() == 0
    assert {(r.k, r.status) for r in joins.compare_keys(df.select("k").distinct(), spark.createDataFrame([(2,), (9,), (None,)], "k int"), ["k"]).collect()} == {(1, "leftOnly"), (2, "equal"), (3, "leftOnly"), (9, "rightOnly"), (None, "equal")}
    assert joins.upsert(df, spark.createDataFrame([(2, "new"), (5, "add")], "k int, v string"), ["k"]).count() == 6
    with pytest.raises(Exception):
        joins.upsert(df, df.select("k"), ["k"])
