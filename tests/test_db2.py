from __future__ import annotations

import json
import struct

import pytest

from quernel.sources import binary, db2

DEFINITION = """COLUMNS
int ID
int Owner
string Name
uint Mask
float Weight
int Kind
int Pair
int Rare

BUILD 1.2.3.4
$noninline,id$ID<32>
Name
Mask<u8>
Weight
Kind<16>
Pair<32>[2]
Rare<32>
$noninline,relation$Owner<32>
"""


def build(sections):
    """A table with one column of each storage; sections: lists of (id, name, mask, weight, kind no, pair no, owner), key, copies."""
    pallet = struct.pack("<3I", 100, 0xFFFFFFFE, 300)
    pairs = struct.pack("<4I", 1, 2, 3, 4)
    common = struct.pack("<2I", 7, 77)
    # name 0:32, mask 32:5 packed, weight 64:32, kind 40:2 pallet, pair 42:1 pallet array
    storage = [(0, 32, 0, 0, 0, 0, 0), (32, 5, 0, 1, 0, 0, 0), (64, 32, 0, 0, 0, 0, 0), (40, 2, 12, 3, 0, 0, 0), (42, 1, 16, 4, 0, 0, 2), (0, 0, 8, 2, 5, 0, 0)]
    total, size = sum(len(s[0]) for s in sections), 12
    texts, bodies, before, text_before = [], [], 0, 0
    for rows, _, _ in sections:
        text, body = b"", b""
        for n, (_, name, mask, weight, kind, pair, _) in enumerate(rows):
            place = (before + n) * size
            offset = total * size + text_before + len(text) - place if name else 0
            body += struct.pack("<IBBHf", offset, mask, kind | pair << 2, 0, weight)
            text += name.encode() + b"\0" if name else b""
        texts.append(text)
        bodies.append(body)
        before, text_before = before + len(rows), text_before + len(text)
    head_size = db2._HEADER.size + len(sections) * db2._SECTION.size + 4 * 6 + 24 * 6 + len(pallet + pairs) + len(common)
    heads, data, at = b"", b"", head_size
    for (rows, key, copies), text, body in zip(sections, texts, bodies, strict=True):
        relation = struct.pack("<3I", len(rows), 0, 9) + b"".join(struct.pack("<2I", r[6], n) for n, r in enumerate(rows))
        whole = body + text + b"".join(struct.pack("<I", r[0]) for r in rows) + b"".join(struct.pack("<2I", *c) for c in copies) + relation
        if key:
            whole = bytes(len(body + text)) + whole[len(body + text) :]
        heads += struct.pack("<Q8I", key, at, len(rows), len(text), 0, 4 * len(rows), len(relation), 0, len(copies))
        data += whole
        at += len(whole)
    header = db2._HEADER.pack(b"WDC5", 5, b"", total, 6, size, sum(map(len, texts)), 0, 0, 1, 9, 0, db2.IDS_OUTSIDE, 0, 6, 0, 1, 24 * 6, len(common), len(pallet + pairs), len(sections))
    return header + heads + b"".join(struct.pack("<hH", 0, 0) for _ in range(6)) + b"".join(db2._STORAGE.pack(*s) for s in storage) + pallet + pairs + common + data


ROWS = [(5, "five", 31, 1.5, 0, 1, 50), (7, "séven", 1, -2.0, 1, 0, 70)]


def decode(data):
    columns, versions = binary.parse_definition(DEFINITION)
    table = db2.read_table(data)
    return table, db2.rows_of(table, columns, versions[0])


def test_columns_sections_and_copies():
    table, rows = decode(build([(ROWS, 0, [(8, 5)]), ([(3, "", 0, 0.25, 2, 0, 30)], 0, []), ([(9, "hidden", 1, 1.0, 0, 0, 1)], 12345, [])]))
    assert table.skipped == 1 and [i for i, _ in rows] == [3, 5, 7, 8]
    got = dict(rows)
    assert got[5] == {"ID": 5, "Name": "five", "Mask": 31, "Weight": 1.5, "Kind": 100, "Pair": [3, 4], "Rare": 5, "Owner": 50}
    assert got[7] == {"ID": 7, "Name": "séven", "Mask": 1, "Weight": -2.0, "Kind": -2, "Pair": [1, 2], "Rare": 77, "Owner": 70}
    assert got[8] == got[5] | {"ID": 8} and got[3]["Name"] == "" and got[3]["Kind"] == 300


def test_broken_files(spark):
    whole = build([(ROWS, 0, [])])
    for bad in (b"", b"WDC4" + whole[4:], whole[:100], whole[:260], whole[:-4]):
        with pytest.raises((binary.BinaryError, struct.error)):
            decode(bad)
    columns, versions = binary.parse_definition(DEFINITION)
    files = spark.createDataFrame([("a", bytearray(whole)), ("b", bytearray(b"x")), ("c", None)], "path string, content binary")
    got = db2.table_files(files, columns, versions[0]).collect()
    assert sorted((r.path, r.id) for r in got if r.id) == [("a", 5), ("a", 7)] and json.loads(next(r.fields for r in got if r.id == 5))["Name"] == "five"
    assert {r.path for r in got if r.error} == {"b", "c"}
