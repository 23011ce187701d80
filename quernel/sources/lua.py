"""Lua table literals as JSON, without ever running them.

Reads what data files hold: nil, booleans, numbers, strings (short, long, with escapes), tables
with positions, names and [keys], and comments. Names and calls become evidence
{"$luaExpression": name, "arguments": [...]}; arithmetic is refused. Keyed files hold a table of
column positions by name and a long string with the rows.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class LuaError(ValueError):
    """Text that is no literal."""


_TOKEN = re.compile(
    r"""(?P<space>\s+|--\[(?P<eq>=*)\[.*?\](?P=eq)\]|--[^\n]*)
    |(?P<long>\[(?P<le>=*)\[\n?(?P<body>.*?)\](?P=le)\])
    |(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')
    |(?P<number>0[xX][0-9a-fA-F]+|(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)
    |(?P<name>[A-Za-z_]\w*(?:[.:][A-Za-z_]\w*)*)
    |(?P<mark>[{}\[\](),;=-])""",
    re.DOTALL | re.VERBOSE,
)
#: Escapes of one letter.
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "a": "\a", "b": "\b", "f": "\f", "v": "\v", "\\": "\\", '"': '"', "'": "'", "\n": "\n"}


def unescape(text: str) -> str:
    """The content of a quoted string; numbered escapes are bytes, and bytes that are UTF-8 are text."""

    def one(m: re.Match) -> str:
        code = m[1]
        if code[0] == "z":
            return ""
        if code[0] == "x":
            return chr(int(code[1:], 16))
        if code[0].isdigit():
            if int(code) > 255:
                raise LuaError(f"escape \\{code}")
            return chr(int(code))
        if code not in _ESCAPES:
            raise LuaError(f"escape \\{code}")
        return _ESCAPES[code]

    plain = re.sub(r"(?s)\\(\d{1,3}|x[0-9a-fA-F]{2}|z\s*|.)", one, text)
    try:
        return plain.encode("latin-1").decode("utf-8")
    except (UnicodeEncodeError, UnicodeDecodeError):
        return plain


def _tokens(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if m is None:
            raise LuaError(f"unexpected {text[at : at + 20]!r} at {at}")
        if m["string"]:
            out.append(("string", unescape(m["string"][1:-1])))
        elif m["long"] is not None:
            out.append(("string", m["body"]))
        elif m["space"] is None:
            out.append((m.lastgroup if m.lastgroup in ("number", "name", "mark") else "mark", m[0]))
        at = m.end()
    return [*out, ("end", "")]


class _Reader:
    def __init__(self, text: str) -> None:
        self.tokens, self.at = _tokens(text), 0

    def take(self, mark: str | None = None) -> tuple[str, str]:
        token = self.tokens[self.at]
        if mark is not None and token != ("mark", mark):
            raise LuaError(f"{mark!r} expected, {token[1]!r} found")
        self.at += 1
        return token

    def next_is(self, *marks: str) -> bool:
        kind, text = self.tokens[self.at]
        return kind == "mark" and text in marks

    def value(self) -> object:
        kind, text = self.take()
        if kind == "string":
            out: object = text
        elif kind == "number":
            out = int(text, 0) if re.fullmatch(r"\d+|0[xX][0-9a-fA-F]+", text) else float(text)
        elif (kind, text) == ("mark", "{"):
            out = self.table()
        elif (kind, text) == ("mark", "-"):
            inner = self.value()
            out = -inner if isinstance(inner, (int, float)) and not isinstance(inner, bool) else {"$luaExpression": "-", "arguments": [inner]}
        elif kind == "name":
            out = {"nil": None, "true": True, "false": False}[text] if text in ("nil", "true", "false") else self.expression(text)
        else:
            raise LuaError(f"value expected, {text!r} found")
        return out

    def expression(self, name: str) -> dict:
        if not self.next_is("("):
            return {"$luaExpression": name}
        self.take("(")
        arguments = []
        while not self.next_is(")"):
            arguments.append(self.value())
            if not self.next_is(")"):
                self.take(",")
        self.take(")")
        return {"$luaExpression": name, "arguments": arguments}

    def table(self) -> object:
        listed: list = []
        keyed: dict = {}
        while not self.next_is("}"):
            kind, text = self.tokens[self.at]
            if (kind, text) == ("mark", "["):
                self.take("[")
                key = self.value()
                self.take("]")
                self.take("=")
                keyed[key if isinstance(key, (int, str)) else json.dumps(key, sort_keys=True)] = self.value()
            elif kind == "name" and self.tokens[self.at + 1] == ("mark", "="):
                self.take()
                self.take("=")
                keyed[text] = self.value()
            else:
                listed.append(self.value())
            if not self.next_is("}"):
                self.take("," if self.next_is(",") else ";")
        self.take("}")
        if not keyed:
            return listed
        return {n + 1: v for n, v in enumerate(listed)} | keyed


def parse(text: str) -> object:
    """The value of `return <literal>` or of a literal; LuaError for anything else."""
    reader = _Reader(text)
    if reader.tokens[0] == ("name", "return"):
        reader.take()
    value = reader.value()
    if reader.next_is(";"):
        reader.take()
    if reader.tokens[reader.at][0] != "end":
        raise LuaError(f"{reader.tokens[reader.at][1]!r} behind the literal")
    return value


def keyed_rows(text: str, kind: str) -> list[tuple[int, dict]]:
    """(id, {column: value}) of a keyed file: <kind>Keys names the positions, <kind>Data holds the rows. nil is left out, empty stays."""
    keys = re.search(rf"{kind}Keys\s*=\s*(?=\{{)", text)
    data = re.search(rf"{kind}Data\s*=\s*\[(=*)\[(.*?)\]\1\]", text, re.DOTALL)
    if not keys or not data:
        raise LuaError(f"no {kind}Keys or {kind}Data")
    reader = _Reader(text[keys.end() : data.start()].rpartition("}")[0] + "}")
    names = {position: name for name, position in reader.value().items()}
    rows = parse(data[2])
    out = []
    for i, row in (rows.items() if isinstance(rows, dict) else enumerate(rows, 1)):
        cells = row.items() if isinstance(row, dict) else enumerate(row, 1)
        out.append((int(i), {names[p]: v for p, v in cells if v is not None and p in names}))
    return sorted(out, key=lambda r: r[0])


@F.pandas_udf(T.StructType([T.StructField("value", T.StringType()), T.StructField("error", T.StringType())]))
def _parse(texts: pd.Series) -> pd.DataFrame:
    def one(text: str | None) -> tuple[str | None, str | None]:
        if text is None:
            return None, None
        try:
            return json.dumps(parse(text), ensure_ascii=False), None
        except (LuaError, RecursionError, KeyError) as error:
            return None, str(error)[:200]

    return pd.DataFrame([one(t) for t in texts], columns=["value", "error"])


def lua_to_json(text: Column) -> Column:
    """struct<value (JSON text), error>; both null for null."""
    return _parse(text)


_ROWS = T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("fields", T.MapType(T.StringType(), T.StringType()))]))


def keyed_files(files: DataFrame, kind: str, *keep: str) -> DataFrame:
    """keep, id, fields (column -> JSON text) of the rows of keyed files in column text; a file that can't be read has no rows."""

    @F.pandas_udf(_ROWS)
    def rows(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> list[dict]:
            try:
                return [{"id": i, "fields": {k: json.dumps(v, ensure_ascii=False) for k, v in f.items()}} for i, f in keyed_rows(text or "", kind)]
            except (LuaError, RecursionError):
                return []

        return texts.map(one)

    return files.select(*keep, F.explode(rows("text")).alias("_r")).select(*keep, "_r.*")
