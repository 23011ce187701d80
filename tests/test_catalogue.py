from __future__ import annotations

import pytest

from quernel.sources import catalogue as c
from quernel.sources.lua import LuaError

KINDS = {"n": "npc", "i": "item", "o": "object", "ach": "achievement", "q": "quest"}


def grown(r, depth, above, links, labels, ids):
    """Text of a declaration with others inside it, down to depth; notes who stands in whom and what it is called."""
    call, number = r.choice(list(KINDS)), next(ids)
    me = (KINDS[call], number)
    if above:
        links.add((*above, *me))
    labels[me] = f"what {number} is"
    inside = [grown(r, depth - 1, me, links, labels, ids) for _ in range(r.randint(0, 3))] if depth else []
    groups = f"groups = {{ {' '.join(inside)} }}," if inside else ""
    return f"{call}({number}, {{ -- {labels[me]}\n mark = 'm{number} -- no remark', {groups} }}),\n"


def test_random_trees(spark):
    """Containment, labels and fields of trees that were made here."""
    import itertools
    import random

    r, ids, links, labels = random.Random(6), itertools.count(11), set(), {}
    files = [(f"f{n}", f"top({{\n{grown(r, 3, None, links, labels, ids)}{grown(r, 2, None, links, labels, ids)}}})") for n in range(5)]
    found = c.read_catalogue(spark.createDataFrame([*files, ("empty", ""), ("none", None), ("cut", "-- #if X\nq(1)")], "path string, text string"), {}).cache()
    assert {(x.entity_type, x.entity_id): x.label for x in found.collect()} == labels and len(links) > 10
    assert all(x.fields == {"mark": f'"m{x.entity_id} -- no remark"'} for x in found.collect())
    assert {(x.parent_type, x.parent_id, x.child_type, x.child_id) for x in c.contained_in(found).collect()} == links


def test_inherited_fields_and_labels_behind(spark):
    text = "q(5, { tier = 3, groups = { o(6), -- the well\n i(7, { tier = 4 }) } })"
    rows = {x.entity_id: x for x in c.read_catalogue(spark.createDataFrame([("a", text)], "path string, text string"), {"x": 1}).collect()}
    assert rows[6].label == "the well" and rows[7].fields == {"tier": "4"} and rows[5].fields == {"tier": "3"}


@pytest.mark.parametrize("tags", [frozenset(), frozenset({"RED"}), frozenset({"BLUE"}), frozenset({"RED", "BLUE"})])
def test_branches_keep_places(tags):
    """Of a branch in a branch what remains follows from the tags, and keeps its place."""
    lines = ["-- #if RED", "o(71)", "-- #if NOT BLUE", "o(72)", "-- #endif", "-- #elseif BLUE", "o(73)", "-- #else", "o(74)", "-- #endif", "o(75)"]
    text = "\n".join(lines)
    red, blue = "RED" in tags, "BLUE" in tags
    stays = {71: red, 72: red and not blue, 73: blue and not red, 74: not red and not blue, 75: True}
    out = c.blank_branches(text, tags, ())
    assert len(out) == len(text) and {n: f"o({n})" in out for n in stays} == stays
    assert all(out.index(f"o({n})") == text.index(f"o({n})") for n, here in stays.items() if here)


def test_branches_that_do_not_close():
    for bad in ("o(1)\n-- #endif", "-- #if RED\no(1)", "-- #else\no(1)", "-- #elseif RED\n-- #endif"):
        with pytest.raises(LuaError):
            c.blank_branches(bad, frozenset({"RED"}), ())


@pytest.mark.parametrize("minor", [0, 59, 60, 61])
def test_conditions_on_versions(minor):
    holds = lambda x: c.applies(x, frozenset({"RED"}), (1, minor, 5))
    assert holds("AFTER 1.60") == (minor >= 60) and holds("BEFORE 1.60") == (minor < 60) and holds("NOT AFTER 1.60") == (minor < 60)
    assert holds("RED") and not holds("BLUE") and not holds("") and not holds("AFTER one") and not holds("AFTER 9")


def test_constants_inheritance_and_evidence():
    constants = c.constants_of("HUMAN = 1; ORC = 2;\nHORDE_ONLY = { ORC, 9 }; MAP = { ZONE = 14 }; ODD = f(1)")
    assert constants == {"HUMAN": 1, "ORC": 2, "HORDE_ONLY": [2, 9], "MAP": {"ZONE": 14}, "MAP.ZONE": 14}
    text = """n(1, { races = HORDE_ONLY, lvl = 20, groups = {
 q(201, { groups = { i(9, { lvl = 99, races = HUMAN }) } }),
 q(202, { races = HUMAN, requireSkill = UnknownSkill(), sum = 1 + 2, coord = { 1.5, -2, MAP.ZONE } }),
} }) x = q(203, sharedData({ lvl = 40 }, { q(204) }))"""
    got = {d["id"]: d for d in c.declarations(text, constants)}
    assert got[201]["inherited"] == {"races": [2, 9], "lvl": 20} and got[201]["fields"] == {}
    assert got[9]["fields"] == {"lvl": 99, "races": 1}
    assert got[202]["fields"] == {"races": 1, "coord": [1.5, -2, 14]} and got[202]["unresolved"] == {"requireSkill": "UnknownSkill(...)", "sum": "1 + 2"}
    assert got[204]["inherited"] == {"lvl": 40}


def test_declarations_that_disagree(spark):
    files = spark.createDataFrame([("a", "q(1, { lvl = 5, name = 'x' })"), ("b", "q(1, { lvl = 6, name = 'x' }) q(2) q(((")], "path string, text string")
    merged = {(r.entity_id, r.field): (r.value, r.n_values) for r in c.merge_declarations(c.read_catalogue(files, {})).collect()}
    assert merged == {(1, "lvl"): (None, 2), (1, "name"): ('"x"', 1)}
