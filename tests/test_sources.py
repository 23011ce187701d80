from __future__ import annotations

import json
import random
import zlib

import pytest

from quernel.sources import binary, lua, pages

def written(value):
    """A Python value as a Lua literal."""
    if isinstance(value, dict):
        return "{" + "; ".join(f"[{written(k)}] = {written(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "{ " + ", ".join(map(written, value)) + " }"
    if isinstance(value, str):
        return '"' + "".join(ch if ch.isalnum() else "".join(f"\\{b:03d}" for b in ch.encode()) for ch in value) + '"'
    return {None: "nil", True: "true", False: "false"}[value] if value is None or isinstance(value, bool) else repr(value)


def some_value(r, depth):
    kind = r.randrange(7 if depth else 5)
    if kind < 5:
        return [r.randint(-99, 99), r.random() * 8, "".join(r.choice("ab 9\n\"\\é") for _ in range(5)), r.random() < 0.5, r.randint(1, 2**40)][kind]
    if kind == 5:
        return [some_value(r, depth - 1) for _ in range(r.randint(1, 4))]
    return {r.choice([f"k{n}", n * 1000 + 7]): some_value(r, depth - 1) for n in range(r.randint(1, 4))}


@pytest.mark.parametrize("seed", range(40))
def test_lua_round_trip(seed):
    value = [some_value(random.Random(seed), 3)]
    assert lua.parse(f"return {written(value)}") == value


def test_lua_words():
    assert lua.parse("{ --[[ gone ]] tea = [[two\nlines]], ['milk'] = 0xFF, 3, nil, 5e-1 --last\n}") == {1: 3, 2: None, 3: 0.5, "tea": "two\nlines", "milk": 255}
    assert lua.parse("{ brew(4, 'hot'), Pot.SIZE }") == [{"$luaExpression": "brew", "arguments": [4, "hot"]}, {"$luaExpression": "Pot.SIZE"}]
    for bad in ("{ 2 * 3 }", "{ { }", "{ } , { }", "brew(4", "\"open", "   "):
        with pytest.raises(lua.LuaError):
            lua.parse(bad)


def test_lua_files(spark):
    rows = {6: ["Ash", 2.5], 8: [None, [1, 2]], 9: ["Oak", None]}
    shelf = "Wood.treeKeys = { ['label'] = 1, ['rings'] = 2 }\nWood.treeData = [[return " + written(rows) + "]]\n"
    files = spark.createDataFrame([("w", shelf), ("x", "local a = 1"), ("y", None)], "path string, text string")
    got = [(r.path, r.id, r.fields) for r in lua.keyed_files(files, "tree", "path").orderBy("id").collect()]
    assert got == [("w", 6, {"label": '"Ash"', "rings": "2.5"}), ("w", 8, {"rings": "[1, 2]"}), ("w", 9, {"label": '"Oak"'})]
    texts = spark.createDataFrame([("{true,'x'}",), ("{true",), (None,)], "t string")
    parsed = [r[0] for r in texts.select(lua.lua_to_json("t")).collect()]
    assert parsed[0].value == json.dumps([True, "x"]) and parsed[1].value is None and parsed[1].error and parsed[2].error is None


def test_page_blocks(spark):
    """A page put together from rows that were made here gives the rows back."""
    r = random.Random(2)
    lists = [("herb", f"list{n}", [{"id": r.randint(1, 99), "name": r.choice(["a ] b", "c ' d", "e } f"])} for _ in range(r.randint(1, 4))]) for n in range(3)]
    points = [[r.randint(0, 1000) / 10, r.randint(0, 1000) / 10] for _ in range(4)]
    giver = {"type": 1, "id": 77, "name": "Old \"Ned\"", "coords": points[:1], "quests": [{"name": "Two; three"}, {}]}
    page = "<html><script>" + " ".join(f"new Listview({{template: '{t}', id: '{i}', data: {json.dumps(d)}}});" for t, i, d in lists)
    page += f"var g_mapperData = {json.dumps({'31': [{'coords': [*points, [1]], 'uiMapId': 310}]})}; var mapShowObject = new ShowOnMap({json.dumps({'alliancequests': [giver], 'hordequests': []})}); new Listview({{template: 'torn', data: [{{]}});</script>"
    page += f"<script type=\"application/json\" id=\"data.page.listPage.listviews\">{json.dumps([{'template': 'root', 'id': 'late', 'data': [{'id': 5}, {'id': 'no'}]}])}</script></html>"
    df = spark.createDataFrame([(1, page), (2, " "), (3, None), (4, "<b>" * 9000)], "page_id int, html string")
    found = pages.page_blocks(df, "page_id").cache()
    rows = sorted((x.template, x.id, x.row_id or 0) for x in pages.listview_rows(found, "page_id").collect())
    assert rows == sorted([(t, i, d["id"]) for t, i, ds in lists for d in ds] + [("root", "late", 5), ("root", "late", 0)])
    assert sorted((x.zone_id, x.ui_map_id, x.x, x.y) for x in pages.mapper_spawns(found, "page_id").collect()) == sorted((31, 310, *map(float, p)) for p in points)
    [got] = pages.quest_givers(found, "page_id").collect()
    assert (got.side, got.giver_id, got.quest_names, got.coords) == ("alliancequests", 77, ["Two; three"], [list(map(float, p)) for p in points[:1]])


def test_links_and_kinds(spark):
    from pyspark.sql import functions as F

    links = spark.createDataFrame([("quest=40 and [url=/a/quest=8/b]quest=40[/url]", "https://site.example/zone=52/old-mill?tab=2#top"), (None, None)], "t string, u string")
    kind, slug = pages.page_kind(F.col("u"))
    assert [tuple(r) for r in links.select(pages.linked_ids(F.col("t")), kind, slug).collect()] == [([8, 40], "zone", "old-mill"), ([], "other", None)]


def blocks(parts):
    """A file of blocks; parts are (mode, bytes): N as they are, Z packed, E another key."""
    stored = [(m, data, m.encode() + (zlib.compress(data) if m == "Z" else data)) for m, data in parts]
    size = 12 + 24 * len(parts)
    heads = b"".join(len(s).to_bytes(4, "big") + len(d).to_bytes(4, "big") + bytes(16) for _, d, s in stored)
    return b"BLTE" + size.to_bytes(4, "big") + b"\x0f" + len(parts).to_bytes(3, "big") + heads + b"".join(s for *_, s in stored)


@pytest.mark.parametrize("seed", range(12))
def test_blocks(seed):
    """Any number of blocks of any mode; those of another key are left zero."""
    r = random.Random(seed)
    parts = [(r.choice("NZE"), r.randbytes(r.randint(1, 300))) for _ in range(r.randint(1, 6))]
    file = blocks(parts)
    assert binary.decode_blte(file) == b"".join(bytes(len(d)) if m == "E" else d for m, d in parts)
    with pytest.raises(binary.BinaryError):
        binary.decode_blte(file[: r.randrange(8, len(file))] if r.random() < 0.5 else b"blte" + file[4:])


def test_single_blocks_and_columns(spark):
    single = lambda mode, data: b"BLTE" + bytes(4) + mode + data
    assert binary.decode_blte(single(b"N", b"oats")) == b"oats" and binary.decode_blte(single(b"E", b"locked"), 3) == bytes(3)
    for bad, size in ((single(b"N", b"oats"), 9), (single(b"F", b"oats"), 0), (single(b"", b""), 0), (b"", 0)):
        with pytest.raises(binary.BinaryError):
            binary.decode_blte(bad, size)
    df = spark.createDataFrame([(bytearray(single(b"N", b"rye")),), (bytearray(b"bran"),), (None,)], "c binary")
    got = [r[0] for r in df.select(binary.blte("c")).collect()]
    assert bytes(got[0].content) == b"rye" and got[1].error == "no BLTE file" and got[2].content is None


def test_bits_at_every_offset():
    data = bytes(random.Random(1).randrange(256) for _ in range(16))
    whole = int.from_bytes(data, "little")
    for offset in range(64):
        for width in range(1, 64):
            want = whole >> offset & (1 << width) - 1
            assert binary.read_bits(data, offset, width) == want
            assert binary.read_bits(data, offset, width, signed=True) == (want - (1 << width) if want >> (width - 1) else want) == binary.as_integer(want, width, True)
    with pytest.raises(binary.BinaryError):
        binary.read_bits(data, 120, 9)


DEFINITION = """COLUMNS
int ID
int<Item::ID> ItemID
uint Flags
float Coefficient
locstring Name
int Unverified?

LAYOUT 0A1B2C3D
BUILD 5.5.0.60000
COMMENT older
$id$ID<32>
Name

LAYOUT 4E5F6071, 8899AABB
BUILD 5.5.4.68571, 5.5.4.68806
BUILD 5.4.0.10000-5.4.9.19999
$noninline,id$ID<32>
$relation$ItemID<32>
Flags<u8>[3]
Coefficient
Name
Unverified<32>
"""


def test_definitions():
    columns, versions = binary.parse_definition(DEFINITION)
    assert columns["ItemID"].refers == "Item::ID" and not columns["Unverified"].sure
    new = binary.select_version(versions, "5.5.4.68806")
    assert new is versions[1] and binary.select_version(versions, "5.4.1.15000") is None and new.holds((5, 4, 1, 15000))
    first = new.members[0]
    assert first.is_id and not first.inline and new.members[1].is_relation and (new.members[2].size, new.members[2].signed, new.members[2].length) == (8, False, 3)
    assert binary.table_schema(columns, new).simpleString() == "struct<ID:int,ItemID:int,Flags:array<smallint>,Coefficient:float,Name:string,Unverified:int>"
    for bad in ("COLUMNS\nodd X\n", "COLUMNS\nint X\n\nBUILD 1.2\nX\n", "COLUMNS\nint X\n\nBUILD 1.2.3.4\nY\n", ""):
        with pytest.raises(binary.BinaryError):
            binary.parse_definition(bad)
    rows = binary.build_info("Branch!STRING:0|Active!DEC:1|Product!STRING:0\neu|1|game\nus|0|game\n", "game")
    assert rows == [{"Branch": "eu", "Active": "1", "Product": "game"}]
    assert binary.index_bucket(bytes([0x12, 0x34])) == ((0x26 & 15) ^ 2)
