"""Fields brought to shared shapes, and the rules of policies."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernel.operators.conform import Exclusion, conform_fields, field_name, policy_errors

SCHEMA = "entity_type string, entity_id string, source string, source_revision string, attributes map<string,string>, field_states map<string,string>, value int, _a int"


def outcomes(spark, attributes, states=None, source="s", rules=()):
    df = spark.createDataFrame([("quest", "1", source, "r", attributes, states, 1, 2)], SCHEMA)
    return {r.field: (r.outcome, r.value, r.state) for r in conform_fields(df, rules).collect()}


def test_what_decides_first(spark):
    got = outcomes(spark, {"requiredLevel": "5", "questLevel": "6", "name": "null", "objectivesText": "[]", "zoneOrSort": "7.5"}, {"requiredLevel": "invalid", "name": "empty", "extra": "missing"}, rules=(Exclusion("s", "quest", "questLevel", "why"), Exclusion("s", "quest", "requiredLevel", "later")))
    assert got == {
        "requiredLevel": ("marked", None, "invalid"), "questLevel": ("excluded", None, "unsupported"), "name": ("cleared", "null", None),
        "objectivesText": ("taken", "[]", None), "zoneOrSort": ("misshapen", None, "invalid"), "extra": ("marked", None, "missing"),
    }
    assert outcomes(spark, {"questLevel": "6"}, source="other", rules=(Exclusion("s", "quest", "questLevel", "why"),)) == {"questLevel": ("taken", "6", None)}


def test_objectives_and_presence(spark):
    got = outcomes(spark, {"objectives": "[[[4]]]", "spawns": '{"9":[[-1,-1]],"3":[[1,2]]}'})
    assert got == {"objectives": ("taken", '{"creature":[{"id":4}]}', None), "spawns": ("taken", '[{"x":1,"y":2,"zoneId":3}]', None), "spawnPresence": ("taken", "[9]", None)}
    assert outcomes(spark, {"objectives": "[[[0]]]", "spawns": '{"9":[[-1,-1]]}'}) == {"objectives": ("misshapen", None, "invalid"), "spawns": ("misshapen", None, "unavailable"), "spawnPresence": ("taken", "[9]", None)}


def test_null_and_empty(spark):
    assert outcomes(spark, None) == outcomes(spark, {}, {}) == {}
    assert outcomes(spark, {"name": None}, {"name": None}) == {"name": ("misshapen", None, "invalid")}
    assert conform_fields(spark.createDataFrame([], SCHEMA)).collect() == []


def test_policies(spark):
    policy = spark.createDataFrame([("quest", "name", "a", 1), ("quest", "name", "a", 2), ("quest", "x.y", "a", 1), ("quest", " z", "a", 1), ("quest", "w", "nobody", 1), (None, "v", "a", 1)], "entity_type string, field string, source string, priority int")
    known = spark.createDataFrame([("a",), ("a",), (None,)], "source string")
    got = sorted((r.field, r.error) for r in policy_errors(policy, known).collect())
    assert got == [(" z", "blank"), ("name", "repeated source"), ("v", "blank"), ("w", "unknown source"), ("x.y", "dotted")]
    names = spark.createDataFrame([("a_b-1",), ("a b",), ("",), (None,)], "n string")
    assert [r[0] for r in names.select(field_name(F.col("n"))).collect()] == [True, False, False, False]


def test_sources_against_all_others(spark):
    from quernel.operators.joins import compare_sources

    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("a", 2), ("c", None), (None, 3)], "source string, k int")
    got = {(r.source, r.k): r.status for r in compare_sources(rows, "source", ["k"]).collect()}
    assert got == {("a", 1): "equal", ("b", 1): "equal", ("c", 1): "rightOnly", ("a", 2): "leftOnly", ("b", 2): "rightOnly", ("c", 2): "rightOnly", ("a", None): "rightOnly", ("b", None): "rightOnly", ("c", None): "leftOnly"}
    assert compare_sources(rows.limit(0), "source", ["k"]).collect() == []


def test_chunks_of_an_index(spark):
    from quernel.operators.aggregates import inverted_index

    rows = spark.createDataFrame([(1, n) for n in (0, 9, 10, 25, 25)] + [(2, None), (None, 3)], "k int, m int")
    assert sorted(tuple(r) for r in inverted_index(rows, "k", "m", 10).collect()) == [(1, 0, "0,9"), (1, 1, "10"), (1, 2, "25")]
