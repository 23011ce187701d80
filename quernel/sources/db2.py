"""Packed client tables (WDC5): header, sections and columns to rows.

The layout is the published one: a header, section headers, per column its storage, then pallets and
common values, then sections of fixed or sparse records with strings, ids, copies and relations.
A file is decoded by one task; files are independent. Sections under a key nobody has hold zeros
and are counted, not decoded.
"""

from __future__ import annotations

import json
import struct

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernel.sources.binary import BinaryError, Member, TableColumn, Version, as_integer

_HEADER = struct.Struct("<4sI128s9I2H7I")
_SECTION = struct.Struct("<Q8I")
_STORAGE = struct.Struct("<2H5I")
#: Flags of the header.
SPARSE, RELATED, IDS_OUTSIDE = 1, 2, 4
#: How a column is stored.
PLAIN, PACKED, COMMON, PALLET, PALLET_ARRAY, PACKED_SIGNED = range(6)


@dataclass
class Storage:
    offset: int
    width: int
    extra: int
    kind: int
    first: int
    second: int
    third: int
    pallet: bytes = b""
    common: dict[int, int] = field(default_factory=dict)


@dataclass
class Section:
    key: int
    offset: int
    rows: int
    strings: int
    sparse_end: int
    id_bytes: int
    relation_bytes: int
    sparse_rows: int
    copies: int


@dataclass
class PackedTable:
    row_bytes: int
    min_id: int
    flags: int
    id_column: int
    storage: list[Storage]
    sections: list[Section]
    data: bytes
    skipped: int = 0


def read_table(data: bytes) -> PackedTable:
    """The parts of a WDC5 file; BinaryError if it is cut off or of another kind."""
    try:
        head = _HEADER.unpack_from(data)
        if head[0] != b"WDC5":
            raise BinaryError("no WDC5 file")
        _, _, _, _, _, row_bytes, _, _, _, min_id, _, _, flags, id_column, columns, _, _, storage_bytes, common_bytes, pallet_bytes, n_sections = head
        at = _HEADER.size
        sections = [Section(*_SECTION.unpack_from(data, at + n * _SECTION.size)) for n in range(n_sections)]
        at += n_sections * _SECTION.size + 4 * columns
        storage = [Storage(*_STORAGE.unpack_from(data, at + n)) for n in range(0, storage_bytes, _STORAGE.size)]
        at += storage_bytes
        end = at + pallet_bytes
        for s in storage:
            if s.kind in (PALLET, PALLET_ARRAY):
                s.pallet = data[at : at + s.extra]
                at += s.extra
        at = end
        for s in storage:
            if s.kind == COMMON:
                pairs = struct.unpack_from(f"<{s.extra // 4}I", data, at)
                s.common = dict(zip(pairs[::2], pairs[1::2], strict=True))
                at += s.extra
        if end + common_bytes > len(data):
            raise BinaryError("cut off")
    except struct.error as error:
        raise BinaryError("cut off") from error
    return PackedTable(row_bytes, min_id, flags, id_column, storage, sections, data)


class _Bits:
    """Fields of one record, as bits of one number."""

    def __init__(self, record: bytes) -> None:
        self.number, self.size = int.from_bytes(record, "little"), 8 * len(record)

    def take(self, offset: int, width: int) -> int:
        if offset + width > self.size:
            raise BinaryError("field beyond its record")
        return self.number >> offset & (1 << width) - 1


def _number(raw: int, width: int, kind: str, signed: bool) -> object:
    if kind == "float":
        return struct.unpack("<f", (raw & 0xFFFFFFFF).to_bytes(4, "little"))[0]
    return as_integer(raw, width, signed)


def _text(data: bytes, at: int) -> tuple[str, int]:
    end = data.find(b"\0", at)
    if at < 0 or end < 0:
        raise BinaryError("text without an end")
    return data[at:end].decode("utf-8", "replace"), end + 1


def rows_of(table: PackedTable, columns: dict[str, TableColumn], version: Version) -> list[tuple[int, dict]]:
    """(id, {column: value}) of all readable rows in order of id; copies are rows of their own.

    Members that are not inline come from the id list and the relations; of two rows with one id the later
    section's counts.
    """
    inline = [m for m in version.members if m.inline]
    outside_id = next((m.name for m in version.members if m.is_id and not m.inline), None)
    outside_relation = next((m.name for m in version.members if m.is_relation and not m.inline), None)
    if len(inline) > len(table.storage):
        raise BinaryError("the definition has more columns than the file")
    every_row = sum(s.rows for s in table.sections) * table.row_bytes
    texts = b"".join(table.data[s.offset + s.rows * table.row_bytes :][: s.strings] for s in table.sections) if not table.flags & SPARSE else b""
    out: dict[int, dict] = {}
    before = 0
    for s in table.sections:
        fixed = s.rows * table.row_bytes
        at = s.sparse_end if table.flags & SPARSE else s.offset + fixed + s.strings
        body = table.data[s.offset : at]
        if s.key and not any(body):
            table.skipped += 1
            before += fixed
            continue
        try:
            ids = list(struct.unpack_from(f"<{s.id_bytes // 4}I", table.data, at))
            at += s.id_bytes
            copies = [struct.unpack_from("<2I", table.data, at + 8 * n) for n in range(s.copies)]
            at += 8 * s.copies
            places = [struct.unpack_from("<IH", table.data, at + 6 * n) for n in range(s.sparse_rows)]
            at += 6 * s.sparse_rows
            late_ids = table.flags & RELATED == 0
            if not late_ids:
                sparse_ids = struct.unpack_from(f"<{s.sparse_rows}I", table.data, at)
                at += 4 * s.sparse_rows
            relations: dict[int, int] = {}
            if s.relation_bytes:
                count = struct.unpack_from("<I", table.data, at)[0]
                relations = {row: other for other, row in (struct.unpack_from("<2I", table.data, at + 12 + 8 * n) for n in range(count))}
                at += s.relation_bytes
            if late_ids:
                sparse_ids = struct.unpack_from(f"<{s.sparse_rows}I", table.data, at)
        except struct.error as error:
            raise BinaryError("cut off") from error
        records = [(n, table.data[o : o + size], o) for n, (o, size) in enumerate(places)] if table.flags & SPARSE else [(n, table.data[s.offset + n * table.row_bytes :][: table.row_bytes], before + n * table.row_bytes) for n in range(s.rows)]
        for n, record, place in records:
            own_id = sparse_ids[n] if table.flags & SPARSE else ids[n] if n < len(ids) else None
            row = _sparse_row(record, inline, columns) if table.flags & SPARSE else _fixed_row(record, place, own_id, table, inline, columns, texts, every_row)
            if own_id is None:
                own_id = next((row[m.name] for m in inline if m.is_id), table.min_id + n)
            if outside_id:
                row[outside_id] = own_id
            if outside_relation:
                row[outside_relation] = relations.get(n)
            out[own_id] = row
        for new, old in copies:
            if old in out:
                id_name = outside_id or next((m.name for m in inline if m.is_id), None)
                out[new] = out[old] | ({id_name: new} if id_name else {})
        before += fixed
    return sorted(out.items())


def _sparse_row(record: bytes, inline: list[Member], columns: dict[str, TableColumn]) -> dict:
    row, at = {}, 0
    for m in inline:
        kind, values = columns[m.name].kind, []
        for _ in range(max(1, m.length)):
            if kind in ("string", "locstring"):
                value, at = _text(record, at)
            else:
                size = (m.size or 32) // 8
                if at + size > len(record):
                    raise BinaryError("field beyond its record")
                value = _number(int.from_bytes(record[at : at + size], "little"), 8 * size, kind, m.signed)
                at += size
            values.append(value)
        row[m.name] = values if m.length else values[0]
    return row


def _fixed_row(record: bytes, place: int, own_id: int | None, table: PackedTable, inline: list[Member], columns: dict[str, TableColumn], texts: bytes, every_row: int) -> dict:
    bits, row = _Bits(record), {}
    if own_id is None and table.id_column < len(table.storage):
        s = table.storage[table.id_column]
        own_id = bits.take(s.offset, s.width)
    for m, s in zip(inline, table.storage, strict=False):
        kind, count = columns[m.name].kind, max(1, m.length)
        width = m.size or 32
        if s.kind == COMMON:
            raws = [s.common.get(own_id, s.first)] * count
        elif s.kind in (PALLET, PALLET_ARRAY):
            index, each = bits.take(s.offset, s.width), s.third if s.kind == PALLET_ARRAY else 1
            raws = list(struct.unpack_from(f"<{each}I", s.pallet, 4 * each * index))
        elif s.kind in (PACKED, PACKED_SIGNED):
            raws, width = [bits.take(s.offset, s.width)], max(width, s.width)
            if s.kind == PACKED_SIGNED:
                raws = [as_integer(raws[0], s.width, True)]
        elif s.kind == PLAIN:
            width = s.width // count
            raws = [bits.take(s.offset + n * width, width) for n in range(count)]
        else:
            raise BinaryError(f"storage {s.kind}")
        if kind in ("string", "locstring"):
            # a text lies as far behind its field as the field says, with all records and then all texts in one line
            step = [place + (s.offset + n * width) // 8 + raw - every_row for n, raw in enumerate(raws)]
            values = [_text(texts, p)[0] if raw else "" for p, raw in zip(step, raws, strict=True)]
        else:
            values = [_number(raw, width, kind, m.signed) for raw in raws]
        row[m.name] = values if m.length else values[0]
    return row


_ROWS = T.StructType([
    T.StructField("rows", T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("fields", T.StringType())]))),
    T.StructField("sections_skipped", T.IntegerType()), T.StructField("error", T.StringType()),
])


def table_files(files: DataFrame, columns: dict[str, TableColumn], version: Version) -> DataFrame:
    """path, id, fields (JSON text), sections_skipped, error of files in columns path and content.

    A file that can't be read gives one row with its error; so does a null content.
    """

    @F.pandas_udf(_ROWS)
    def decode(contents: pd.Series) -> pd.DataFrame:
        def one(data: bytes | None) -> tuple:
            try:
                table = read_table(bytes(data or b""))
                found = rows_of(table, columns, version)
                return [{"id": i, "fields": json.dumps(r, ensure_ascii=False)} for i, r in found], table.skipped, None
            except (BinaryError, struct.error) as error:
                return None, None, str(error)

        return pd.DataFrame([one(c) for c in contents], columns=["rows", "sections_skipped", "error"])

    decoded = files.select("path", decode("content").alias("_d"))
    return decoded.select("path", F.explode_outer("_d.rows").alias("_r"), "_d.sections_skipped", "_d.error").select("path", "_r.id", "_r.fields", "sections_skipped", "error")


