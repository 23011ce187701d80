"""Shapes of fields against what their rules say, mostly on values that are made here from the rules."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from quernel.functions import shapes
from quernel.functions.canonical import canonical_json

R = random.Random(41)


def compact(value):
    return json.dumps(value, separators=(",", ":"), sort_keys=True)


def in_text_order(values):
    """Distinct values as a JSON list in order of their texts."""
    return "[" + ",".join(sorted({compact(v) for v in values})) + "]"


def integers():
    """At, below and above every bound, as numbers and as what is none."""
    for field, least in (("requiredLevel", 0), ("zoneOrSort", None)):
        for n in (-(2**40), -7, 0, 7, 2**63, 2**80):
            good = least is None or n >= least
            yield field, str(n), str(n) if good else None, None if good else "invalid"
        yield field, "700.0", "700", None
        yield field, "7E2", "700", None
        for bad in ("7.25", '"7"', "[7]", "true", "{}"):
            yield field, bad, None, "invalid"


def id_sets():
    for _ in range(6):
        ids = [R.randint(1, 3000) for _ in range(R.randint(0, 9))]
        yield "exclusiveTo", json.dumps([*ids, *ids[:2]]), in_text_order(ids), None
    for signed, bad in ((False, "[3,0]"), (False, "[3,-3]"), (False, '[3,"4"]'), (False, "[3,4.5]"), (False, "3"), (True, "[3,0]")):
        yield "preQuestGroup" if signed else "exclusiveTo", bad, None, "invalid"
    both = [R.choice([-1, 1]) * R.randint(1, 999) for _ in range(8)]
    yield "preQuestGroup", json.dumps(both), in_text_order(both), None


def all_providers():
    kinds = ("npc", "object", "item")
    for _ in range(6):
        slots = [[R.randint(1, 500) for _ in range(R.randint(0, 4))] for _ in kinds]
        want = in_text_order({"id": i, "type": k} for k, ids in zip(kinds, slots) for i in ids)
        yield "startedBy", json.dumps([s or R.choice([None, []]) for s in slots]), want, None
        listed = [{"type": k, "id": i, "place": "x"} for k, ids in zip(kinds, slots) for i in ids]
        R.shuffle(listed)
        yield "startedBy", json.dumps(listed), want if listed else "[]", None
    yield "finishedBy", "[[31],[32]]", in_text_order([{"id": 31, "type": "npc"}, {"id": 32, "type": "object"}]), None
    for field, bad in (("finishedBy", "[[31],[32],[33]]"), ("startedBy", "[[],[],[],[]]"), ("startedBy", "[[0]]"), ("startedBy", '[["31"]]'), ("startedBy", '[{"id":31,"type":"spell"}]'), ("startedBy", '[{"type":"npc"}]'), ("startedBy", "31")):
        yield field, bad, None, "invalid"


def all_spawns():
    number = lambda: R.choice([0, 100, R.randint(0, 99), R.randint(0, 999) / 10])
    for _ in range(5):
        zones = {R.randint(1, 900): [(number(), number()) for _ in range(R.randint(1, 4))] for _ in range(3)}
        points = [{"zoneId": z, "x": int(x) if x == int(x) else x, "y": int(y) if y == int(y) else y} for z, ps in zones.items() for x, y in ps]
        yield "spawns", json.dumps({str(z): [*ps, ps[0]] for z, ps in zones.items()}), in_text_order(points), None
        yield "spawns", json.dumps(points[::-1]), in_text_order(points), None
    for bad in ('{"8":[[100.5,1]]}', '{"8":[[1,-0.5]]}', '{"8":[[1]]}', '{"north":[[1,1]]}', '{"0":[[1,1]]}', '[{"zoneId":8,"x":1}]', "8"):
        yield "spawns", bad, None, "invalid"
    yield "spawns", '{"71":[[-1,-1]]}', None, "unavailable"


OTHERS = [
    ("name", json.dumps("Zoe\u0308 &lt;"), '"Zo\u00eb &lt;"', None), ("name", "[]", None, "invalid"),
    ("objectivesText", '["second","first","second"]', '["second","first","second"]', None), ("objectivesText", '["first",null]', None, "invalid"), ("objectivesText", '"first"', None, "invalid"),
    ("mood", '{"z":2.50,"a":[1.0]}', '{"a":[1],"z":2.5}', None), ("spawns", None, None, None), ("zoneOrSort", None, None, None),
]
CASES = [*integers(), *id_sets(), *all_providers(), *all_spawns(), *OTHERS]


@pytest.fixture(scope="module")
def outcomes(spark):
    df = spark.createDataFrame([(n, f, v) for n, (f, v, _, _) in enumerate(CASES)], "n int, field string, text string")
    got = df.select("n", shapes.normalize(F.col("field"), canonical_json(F.col("text"))).alias("o")).collect()
    return {r.n: (r.o.value, r.o.state) for r in got}


@pytest.mark.parametrize("n", range(len(CASES)))
def test_shape(outcomes, n):
    assert outcomes[n] == CASES[n][2:], CASES[n]


def test_presence(spark):
    """Zones of which only the presence is known come out sorted and once, beside the points that are known."""
    df = spark.createDataFrame([('{"77":[[-1,-1]],"12":[[4,5],[-1,-1]],"6":[[1,1]]}',), ('{"6":[[1,1]]}',)], "t string")
    assert [r[0] for r in df.select(shapes.spawns(F.col("t"))["presence"]).collect()] == ["[12,77]", None]


#: One entry for each slot, whole and cut down to what is required.
ENTRIES = {
    "creature": ([61, "Free the owl", 8], {"id": 61, "text": "Free the owl", "iconFile": 8}, [61], {"id": 61}),
    "object": ([62, None, 9], {"id": 62, "iconFile": 9}, [62], {"id": 62}),
    "item": ([63, "Find it"], {"id": 63, "text": "Find it"}, [63], {"id": 63}),
    "reputation": ([64, -500], {"id": 64, "value": -500}, None, None),
    "killCredit": ([[66, 65, 66], 65, "Any of them", 7], {"ids": [65, 66], "baseId": 65, "text": "Any of them", "iconFile": 7}, [[65]], {"ids": [65]}),
    "spell": ([67, "Learn", 68], {"id": 67, "text": "Learn", "itemId": 68}, [67], {"id": 67}),
}


@pytest.mark.parametrize("kind", ENTRIES)
def test_each_slot_of_objectives(kind):
    from quernel.functions.objectives import normalize_objectives

    whole, named, short, least = ENTRIES[kind]
    place = list(ENTRIES).index(kind)
    slot = lambda entry: json.dumps([None] * place + [entry if kind == "reputation" else [entry]])
    assert normalize_objectives(slot(whole)) == (compact({kind: [named]}), None)
    if short:
        assert normalize_objectives(slot(short)) == (compact({kind: [least]}), None)
    # a member too many, a first member that is none, and a first member of another kind
    for bad in ([*whole, 1, 1], [None, *whole[1:]], ["x", *whole[1:]]):
        assert normalize_objectives(slot(bad)) == (None, "invalid")


def test_whole_objectives():
    from quernel.functions.objectives import normalize_objectives

    every = json.dumps([e[0] if k == "reputation" else [e[0], e[0]] for k, e in ENTRIES.items()])
    assert normalize_objectives(every) == (compact({k: [e[1]] if k == "reputation" else [e[1], e[1]] for k, e in ENTRIES.items()}), None)
    by_name = {"object": [{"id": 3, "note": "kept"}], "creature": []}
    assert normalize_objectives(json.dumps(by_name)) == (compact(by_name), None)
    for bad in ({"spell": []}, {"item": [{"note": 1}]}, {"item": {}}, [[]] * 7, 3, "text", [3]):
        assert normalize_objectives(json.dumps(bad)) == (None, "invalid")
    assert normalize_objectives("[[") == (None, "invalid") and normalize_objectives("[]") == ("{}", None)


def test_objectives_of_columns(spark):
    from quernel.functions.objectives import objectives

    got = [r[0] for r in spark.createDataFrame([("[]",), (None,)], "t string").select(objectives(F.col("t"))).collect()]
    assert got[0].value == "{}" and got[1].value is None and got[1].state is None
