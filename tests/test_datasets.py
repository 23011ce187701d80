from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quernel.sources.datasets import DatasetError, compare_trees, parse_lines, read_dataset, record_errors, write_dataset

SCHEMA = "schema_version int, flavor string, entity_type string, entity_id string, source string, source_revision string, attributes map<string,string>, field_states map<string,string>, provenance map<string,struct<source:string,revision:string,sources:array<struct<source:string,revision:string>>,path:string,provider:string,selection_rule:string>>"
MANIFEST = {"flavor": "main", "source": "s", "sourceRevision": "r", "generatedAt": "2024-01-01T00:00:00+00:00"}


def record(i, attributes=None, states=None, **other):
    row = dict(schema_version=1, flavor="main", entity_type="quest", entity_id=str(i), source="s", source_revision="r", attributes=attributes or {}, field_states=states, provenance={"x": ("s", "r", [("s", "r")], None, None, None)} if attributes and "x" in attributes else None) | other
    return tuple(row.values())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_round_trip_and_same_bytes(spark, tmp_path):
    rows = [record(i, {"x": f'[{i},"é\\n"]', 'we"ird': "18446744073709551616", "t": '"20"', "n": "20"}, {"y": "missing"}) for i in range(50)]
    one = write_dataset(frame(spark, *rows), f"file://{tmp_path}/d", MANIFEST, parts=3)
    back = read_dataset(spark, f"file://{tmp_path}/d")
    key = lambda r: r.entity_id
    as_plain = lambda df: [r.asDict(recursive=True) for r in sorted(df.collect(), key=key)]
    want = frame(spark, *rows).withColumn("attributes", F.transform_values("attributes", lambda _, v: F.to_json(F.parse_json(v))))
    assert as_plain(back) == as_plain(want)
    two = write_dataset(frame(spark, *rows[::-1]).repartition(5), f"file://{tmp_path}/d", MANIFEST, parts=3)
    assert [p["sha256"] for p in one["parts"]] == [p["sha256"] for p in two["parts"]] and one["recordCount"] == 50
    assert compare_trees(one["parts"], two["parts"]) == {}
    assert set(compare_trees([{"name": "a", "sha256": "1"}, {"name": "b", "sha256": "1"}], [{"name": "b", "sha256": "2"}, {"name": "c", "sha256": "1"}]).values()) == {"missing", "changed", "stale"}


def test_broken_input_leaves_what_was_there(spark, tmp_path):
    path = f"file://{tmp_path}/d"
    first = write_dataset(frame(spark, record(1, {"x": "1"})), path, MANIFEST)
    for bad in ([record(1), record(1)], [record(1, {"x": "{"})], [record(1, source=None)], [record(1, {"a": "1"}, {"a": "odd"})], [record(1, {"a": "5"}, {"a": "empty"})], [record(1, {"a": "5"}, {"a": "missing"})], [record(1, entity_type="x")]):
        with pytest.raises(DatasetError):
            write_dataset(frame(spark, *bad), path, MANIFEST)
    assert read_dataset(spark, path).count() == 1 and first["recordCount"] == 1
    part = next(p for p in Path(tmp_path, "d").glob("part-*") if p.stat().st_size)
    part.write_text(part.read_text().replace("1", "2"))
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    with pytest.raises(DatasetError):
        read_dataset(spark, path)


def test_lines(spark):
    lines = ['{"schemaVersion":1,"flavor":"f","entityType":"npc","entityId":"1","source":"s","sourceRevision":"r","attributes":{"a":1,"a":2}}', "{", '{"schemaVersion":2,"flavor":"f","entityType":"npc","entityId":"","source":"s","sourceRevision":"r","attributes":{},"more":1}', "null"]
    from quernel.session import configure

    configure(spark)
    got = parse_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert got[0].errors == [] and got[0].attributes == {"a": "2"}
    assert got[1].errors == ["unreadable"] and set(got[2].errors) == {"schema version", "entity id", "unknown member"}
    assert frame(spark, record(1)).select(record_errors()).first()[0] == []
