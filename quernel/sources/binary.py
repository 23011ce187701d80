"""Binary client files: block-encoded archives, table definitions, packed bits."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class BinaryError(ValueError):
    """Bytes that are not what they say they are."""


def _block(data: bytes, size: int | None) -> bytes:
    """One block by its mode: N plain, Z deflated, E encrypted (left as zeros); F is refused."""
    if not data:
        raise BinaryError("empty block")
    mode, body = data[:1], data[1:]
    if mode == b"N":
        out = body
    elif mode == b"Z":
        try:
            out = zlib.decompress(body)
        except zlib.error as error:
            raise BinaryError("broken deflate data") from error
    elif mode == b"E":
        if size is None:
            raise BinaryError("encrypted block of unknown size")
        return bytes(size)
    else:
        raise BinaryError(f"block mode {mode!r}")
    if size is not None and len(out) != size:
        raise BinaryError(f"block has {len(out)} bytes, not {size}")
    return out


def decode_blte(data: bytes, size: int = 0) -> bytes:
    """The content of a BLTE file; size is its length if known, else 0."""
    if data[:4] != b"BLTE" or len(data) < 8:
        raise BinaryError("no BLTE file")
    head = int.from_bytes(data[4:8], "big")
    if head == 0:
        return _block(data[8:], size or None)
    count = int.from_bytes(data[9:12], "big")
    if len(data) < 12 or data[8] != 0x0F or count == 0 or head != 12 + 24 * count or len(data) < head:
        raise BinaryError("broken table of blocks")
    out, at = [], head
    for n in range(count):
        entry = data[12 + 24 * n : 36 + 24 * n]
        packed, plain = int.from_bytes(entry[:4], "big"), int.from_bytes(entry[4:8], "big")
        if at + packed > len(data):
            raise BinaryError("block beyond the end")
        out.append(_block(data[at : at + packed], plain))
        at += packed
    whole = b"".join(out)
    if size and len(whole) != size:
        raise BinaryError(f"{len(whole)} bytes, not {size}")
    return whole


_DECODED = T.StructType([T.StructField("content", T.BinaryType()), T.StructField("error", T.StringType())])


@F.pandas_udf(_DECODED)
def _blte(contents: pd.Series) -> pd.DataFrame:
    def one(data: bytes | None) -> tuple[bytes | None, str | None]:
        if data is None:
            return None, None
        try:
            return decode_blte(bytes(data)), None
        except BinaryError as error:
            return None, str(error)

    return pd.DataFrame([one(c) for c in contents], columns=["content", "error"])


def blte(content: Column) -> Column:
    """struct<content, error> of a column of file contents (for spark.read.format('binaryFile'))."""
    return _blte(content)


def read_bits(data: bytes, offset: int, width: int, signed: bool = False) -> int:
    """An integer of width bits that starts offset bits into little-endian data."""
    if width < 0 or offset < 0 or offset + width > 8 * len(data):
        raise BinaryError("bits beyond the end")
    first, last = offset // 8, (offset + width + 7) // 8
    value = int.from_bytes(data[first:last], "little") >> offset % 8 & (1 << width) - 1
    return value - (1 << width) if signed and width and value >> (width - 1) else value


def as_integer(value: int, width: int, signed: bool) -> int:
    """The low bits of a raw value as an integer of that width."""
    low = value & (1 << width) - 1
    return low - (1 << width) if signed and low >> (width - 1) else low


def index_bucket(key: bytes) -> int:
    """Which of 16 index files lists a key: all bytes folded together, then both halves of the result."""
    folded = 0
    for byte in key[:9]:
        folded ^= byte
    return (folded & 15) ^ (folded >> 4)


def build_info(text: str, product: str | None = None) -> list[dict[str, str]]:
    """Rows of a .build.info file whose columns are named name!TYPE:size; active ones of the product only if it is given."""
    lines = [x for x in text.replace("\r", "").split("\n") if x.strip()]
    names = [c.split("!")[0] for c in lines[0].split("|")] if lines else []
    rows = [dict(zip(names, x.split("|"), strict=False)) for x in lines[1:]]
    return [r for r in rows if product is None or (r.get("Product") == product and r.get("Active") == "1")]


#: Types of columns in definitions, and what Spark calls them.
COLUMN_TYPES = {"int": "int", "uint": "bigint", "float": "float", "string": "string", "locstring": "string"}
Build = tuple[int, int, int, int]


@dataclass
class TableColumn:
    """A column as all versions share it."""

    name: str
    kind: str
    refers: str | None
    sure: bool


@dataclass
class Member:
    """A column as one version stores it."""

    name: str
    size: int = 0
    signed: bool = True
    length: int = 0
    is_id: bool = False
    is_relation: bool = False
    inline: bool = True


@dataclass
class Version:
    builds: list[Build] = field(default_factory=list)
    ranges: list[tuple[Build, Build]] = field(default_factory=list)
    layouts: list[str] = field(default_factory=list)
    members: list[Member] = field(default_factory=list)

    def holds(self, build: Build) -> bool:
        return build in self.builds or any(a <= build <= b for a, b in self.ranges)


def parse_build(text: str) -> Build:
    if not re.fullmatch(r"\d+\.\d+\.\d+\.\d+", text):
        raise BinaryError(f"build {text!r}")
    return tuple(int(x) for x in text.split("."))


_MEMBER = re.compile(r"(?:\$([\w,]+)\$)?(\w+)(?:<(u?)(\d+)>)?(?:\[(\d+)\])?$")


def parse_definition(text: str) -> tuple[dict[str, TableColumn], list[Version]]:
    """Columns and versions of a table definition file; BinaryError where a version names an unknown column or a type is unknown."""
    columns: dict[str, TableColumn] = {}
    versions: list[Version] = []
    for block in re.split(r"\n\s*\n", re.sub(r"\r", "", text).strip()):
        lines = [re.sub(r"\s*//.*$", "", x).strip() for x in block.split("\n")]
        if lines[0] == "COLUMNS":
            for line in filter(None, lines[1:]):
                m = re.fullmatch(r"(\w+)(?:<(\w+::\w+)>)?\s+(\w+)(\??)", line)
                if m is None or m[1] not in COLUMN_TYPES:
                    raise BinaryError(f"column {line!r}")
                columns[m[3]] = TableColumn(m[3], m[1], m[2], not m[4])
            continue
        version = Version()
        for line in filter(None, lines):
            word, _, rest = line.partition(" ")
            if word == "LAYOUT":
                version.layouts += [x.strip() for x in rest.split(",")]
            elif word == "BUILD":
                for part in (x.strip() for x in rest.split(",")):
                    low, dash, high = part.partition("-")
                    if dash:
                        version.ranges.append((parse_build(low), parse_build(high)))
                    else:
                        version.builds.append(parse_build(low))
            elif word != "COMMENT":
                m = _MEMBER.match(line)
                if m is None or m[2] not in columns:
                    raise BinaryError(f"member {line!r}")
                marks = (m[1] or "").split(",")
                version.members.append(Member(m[2], int(m[4] or 0), not m[3] and columns[m[2]].kind != "uint", int(m[5] or 0), "id" in marks, "relation" in marks, "noninline" not in marks))
        versions.append(version)
    if not columns:
        raise BinaryError("no columns")
    return columns, versions


def select_version(versions: list[Version], build: str) -> Version | None:
    """The last version that lists exactly this build; ranges and layouts do not count."""
    wanted = parse_build(build)
    return next((v for v in reversed(versions) if wanted in v.builds), None)


def table_schema(columns: dict[str, TableColumn], version: Version) -> T.StructType:
    """Spark's schema of the rows of a version."""
    wide = {8: "smallint", 16: "int", 32: "bigint", 64: "decimal(20,0)"}
    narrow = {8: "tinyint", 16: "smallint", 32: "int", 64: "bigint"}
    out = T.StructType()
    for m in version.members:
        kind = columns[m.name].kind
        simple = (narrow if m.signed else wide).get(m.size or 32, "bigint") if kind in ("int", "uint") else COLUMN_TYPES[kind]
        one = _SIMPLE[simple]
        out = out.add(m.name, T.ArrayType(one) if m.length else one)
    return out


_SIMPLE = {"tinyint": T.ByteType(), "smallint": T.ShortType(), "int": T.IntegerType(), "bigint": T.LongType(), "decimal(20,0)": T.DecimalType(20, 0), "float": T.FloatType(), "string": T.StringType()}
