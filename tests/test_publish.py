from __future__ import annotations

import pytest

from quernel.operators import publish
from quernel.sources.datasets import DatasetError


def test_publication(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    rows = spark.createDataFrame([(i, f"n{i}", i % 3) for i in range(1, 26)], "id long, name string, zone int")
    first = publish.publish(rows, "id", path, per_shard=10, indexes={"zones": "zone"}).orderBy("shard_no").collect()
    assert [(r.shard_no, r.id_first, r.id_last, r.n_rows) for r in first] == [(1, 1, 10, 10), (2, 11, 20, 10), (3, 21, 25, 5)]
    index = {r.zone: r.members for r in spark.read.json(f"{path}/index_zones").collect()}
    assert index[0] == ",".join(str(i) for i in range(3, 26, 3))
    assert spark.read.text(f"{path}/shards/shard_no=3").count() == 5
    again = publish.publish(rows.orderBy("name").repartition(7), "id", path, per_shard=10, indexes={"zones": "zone"}).orderBy("shard_no").collect()
    assert again == first and publish.check(rows, "id", path, 10).count() == 0
    fewer = rows.filter("id <> 15 AND id < 21")
    assert {r.shard_no: r.problem for r in publish.check(fewer, "id", path, 10).collect()} == {2: "changed", 3: "stale"}
    for bad in (rows.union(rows.limit(1)), rows.selectExpr("CAST(NULL AS BIGINT) AS id", "name", "zone")):
        with pytest.raises(DatasetError):
            publish.publish(bad, "id", path, 10)
    assert publish.read_manifest(spark, path).count() == 3


def test_bundles(spark, tmp_path):
    path = f"file://{tmp_path}/zones"
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "zone int, name string")
    publish.zone_bundles(rows, "zone", path)
    publish.zone_bundles(spark.createDataFrame([(1, "new"), (2, "no")], rows.schema), "zone", path, only=[1])
    assert sorted((r.zone, r.name) for r in spark.read.json(path).collect()) == [(1, "new"), (2, "c")]
    with pytest.raises(DatasetError):
        publish.zone_bundles(rows, "zone", path, only=[1, 9])
