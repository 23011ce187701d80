"""Declarations of entities in catalogue source files, read without running them.

A catalogue is Lua text in which calls such as q(101, {...}) or n(7, {...}) declare quests, persons,
items, objects and achievements, nested in one another. Each file is read by itself: branches that
do not apply are blanked (places stay), calls become declarations with their span, label and own
fields, constants are replaced by their values, and whatever is no literal is kept as evidence.
What is declared several times, contained or inherited is then settled on the rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernel.operators import intervals
from quernel.sources.lua import LuaError, unescape

#: Calls that declare an entity, and its type.
KINDS = {"q": "quest", "n": "npc", "i": "item", "o": "object", "ach": "achievement"}
#: Fields that a declaration takes from the ones around it unless it has its own.
INHERITED = ("races", "classes", "lvl", "requireSkill")
#: Names of later expansions; all data is before them.
LATER = ("TBC", "WRATH", "CATA", "MOP", "WOD", "LEGION", "BFA", "SL", "DF", "TWW", "MID")
#: Names of the phase the data is in; its own tag can be added by the caller's tags.
NOW = ("CLASSIC",)

_DIRECTIVE = re.compile(r"(?im)^[ \t]*--[ \t]*#(if|elseif|elif|else|endif)\b[ \t]*([^\r\n]*)")


def applies(condition: str, tags: frozenset[str], version: tuple[int, ...]) -> bool:
    """Whether a condition holds: NOT ..., a tag, AFTER or BEFORE an expansion or a version. Anything else does not."""
    words = condition.upper().split()
    if not words:
        return False
    if words[0] == "NOT":
        return not applies(" ".join(words[1:]), tags, version)
    if words[0] in tags:
        return True
    if len(words) != 2 or words[0] not in ("AFTER", "BEFORE"):
        return False
    if words[1] in NOW:
        earlier = False
    elif words[1] in LATER:
        earlier = True
    elif re.fullmatch(r"\d+(\.\d+)*", words[1]):
        other = tuple(int(x) for x in words[1].split("."))
        earlier = (version + (0,) * len(other))[: len(other)] < other
    else:
        return False
    return earlier == (words[0] == "BEFORE")


def blank_branches(text: str, tags: frozenset[str], version: tuple[int, ...]) -> str:
    """text with what does not apply, and the directives, as spaces: no place moves. LuaError where they do not pair up."""
    out, last, stack = [], 0, []  # a stack entry: whether the block around is active, whether one branch was taken, whether this one is active

    def put(upto: int) -> None:
        part = text[last:upto]
        out.append(part if all(s[2] for s in stack) else re.sub(r"[^\r\n]", " ", part))

    for m in _DIRECTIVE.finditer(text):
        put(m.start())
        last = m.end()
        out.append(" " * len(m[0]))
        word = m[1].lower()
        if word == "if":
            holds = applies(m[2], tags, version)
            stack.append((True, holds, holds))
            continue
        if not stack:
            raise LuaError(f"#{word} without #if")
        _, taken, _ = stack.pop()
        if word != "endif":
            holds = not taken and (word == "else" or applies(m[2], tags, version))
            stack.append((True, taken or holds, holds))
    put(len(text))
    if stack:
        raise LuaError("#if without #endif")
    return "".join(out)


_TOKEN = re.compile(
    r"""(?P<gap>\s+|--\[(?P<a>=*)\[.*?\](?P=a)\]|--[^\n]*)|\[(?P<b>=*)\[\n?(?P<long>.*?)\](?P=b)\]|(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')
    |(?P<number>0[xX][0-9a-fA-F]+|(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)|(?P<name>[A-Za-z_]\w*(?:[.:][A-Za-z_]\w*)*)|(?P<mark>.)""",
    re.DOTALL | re.VERBOSE,
)


@dataclass
class Call:
    """A call with its arguments and its span in the text."""

    name: str
    start: int
    end: int = 0
    arguments: list = field(default_factory=list)


@dataclass
class Other:
    """Text that is no literal and no call."""

    text: str


class _Text:
    def __init__(self, text: str) -> None:
        self.text, self.at = text, 0
        self.tokens: list[tuple[str, object, int, int]] = []
        for m in _TOKEN.finditer(text):
            if m["gap"] is not None:
                continue
            if m["long"] is not None:
                self.tokens.append(("value", m["long"], m.start(), m.end()))
            elif m["string"]:
                try:
                    self.tokens.append(("value", unescape(m["string"][1:-1]), m.start(), m.end()))
                except LuaError:
                    self.tokens.append(("other", m[0], m.start(), m.end()))
            elif m["number"]:
                number = m["number"]
                self.tokens.append(("value", int(number, 0) if re.fullmatch(r"0[xX][0-9a-fA-F]+|\d+", number) and not re.fullmatch(r"0\d+", number) else float(number), m.start(), m.end()))
            else:
                self.tokens.append(("name" if m["name"] else m["mark"], m[0], m.start(), m.end()))
        self.tokens.append(("", "", len(text), len(text)))

    def kind(self) -> str:
        return self.tokens[self.at][0]

    def value(self) -> object:
        """The next value; if it goes on behind what was read, all of it up to the next separator as Other."""
        first = self.at
        out = self.simple()
        if self.kind() not in (",", ";", "}", ")", "]", ""):
            depth = 0
            while self.kind() and (depth or self.kind() not in (",", ";", "}", ")", "]")):
                depth += {"{": 1, "(": 1, "[": 1, "}": -1, ")": -1, "]": -1}.get(self.kind(), 0)
                self.at += 1
            return Other(self.text[self.tokens[first][2] : self.tokens[self.at - 1][3]])
        return out

    def simple(self) -> object:
        kind, text, start, _ = self.tokens[self.at]
        if kind == "value":
            self.at += 1
            return text
        if kind == "-" and self.tokens[self.at + 1][0] == "value" and isinstance(self.tokens[self.at + 1][1], (int, float)):
            self.at += 2
            return -self.tokens[self.at - 1][1]
        if kind == "{":
            return self.table()
        if kind == "name":
            self.at += 1
            if self.kind() == "(":
                call = Call(str(text), start)
                self.at += 1
                while self.kind() not in (")", ""):
                    call.arguments.append(self.value())
                    if self.kind() in (",", ";"):
                        self.at += 1
                    elif self.kind() != ")":
                        break
                call.end = self.tokens[self.at][3]
                self.at += self.kind() == ")"
                return call
            return {"true": True, "false": False, "nil": None}[text] if text in ("true", "false", "nil") else Other(str(text))
        self.at += kind not in ("}", ")", "]", ",", ";", "")
        return Other(str(text))

    def table(self) -> dict:
        """Positions and names of a table: {1: ..., 'name': ...}."""
        self.at += 1
        out: dict = {}
        position = 0
        while self.kind() not in ("}", ""):
            key: object = None
            if self.kind() == "[":
                self.at += 1
                key = self.value()
                self.at += self.kind() == "]"
                self.at += self.kind() == "="
            elif self.kind() == "name" and self.tokens[self.at + 1][0] == "=":
                key = self.tokens[self.at][1]
                self.at += 2
            if key is None:
                position += 1
                key = position
            before = self.at
            out[key if isinstance(key, (int, str)) else str(key)] = self.value()
            if self.kind() in (",", ";"):
                self.at += 1
            elif self.at == before:
                self.at += 1
        self.at += self.kind() == "}"
        return out


def _calls(value: object) -> Iterator[Call]:
    if isinstance(value, Call):
        yield value
        for a in value.arguments:
            yield from _calls(a)
    elif isinstance(value, dict):
        for v in value.values():
            yield from _calls(v)


def literal(value: object, constants: dict) -> tuple[object, bool]:
    """(value with constants in place of their names, whether all of it is known)."""
    if isinstance(value, Other):
        return (constants[value.text], True) if value.text in constants else (value.text, False)
    if isinstance(value, Call):
        return f"{value.name}(...)", False
    if isinstance(value, dict):
        parts = {k: literal(v, constants) for k, v in value.items()}
        known = all(ok for _, ok in parts.values())
        plain = {k: v for k, (v, _) in parts.items()}
        return (list(plain.values()) if list(plain) == list(range(1, len(plain) + 1)) else {str(k): v for k, v in plain.items()}), known
    return value, True


def constants_of(text: str) -> dict:
    """NAME = value; of a constants file, values that name others resolved where those come first; also the members of NAME = { A = 1 }."""
    out: dict = {}
    reader = _Text(text)
    while reader.kind():
        here = reader.at
        if reader.kind() == "name" and reader.tokens[here + 1][0] == "=":
            name = str(reader.tokens[here][1])
            reader.at += 2
            value, known = literal(reader.value(), out)
            if known:
                out[name] = value
                if isinstance(value, dict):
                    out |= {f"{name}.{k}": v for k, v in value.items()}
        reader.at = max(reader.at, here + 1)
    return out


def declarations(text: str, constants: dict, shared: tuple[str, ...] = ("sharedData",)) -> list[dict]:
    """Declarations of one file in order: type, id, start, end, label, fields, inherited, unresolved (field -> text)."""
    found: list[dict] = []

    def walk(value: object, above: dict) -> None:
        if isinstance(value, dict):
            for v in value.values():
                walk(v, above)
        elif isinstance(value, Call):
            own: dict = {}
            if value.name in KINDS and value.arguments and isinstance(value.arguments[0], int):
                fields = value.arguments[1] if len(value.arguments) > 1 and isinstance(value.arguments[1], dict) else {}
                own = {str(k): v for k, v in fields.items() if isinstance(k, str) and k != "groups"}
                plain, odd = {}, {}
                for k, v in own.items():
                    settled, known = literal(v, constants)
                    (plain if known else odd)[k] = settled
                line = text[value.start :].split("\n", 1)[0]
                label = re.search(r"--\s*(.*?)\s*$", line)
                found.append({"type": KINDS[value.name], "id": value.arguments[0], "start": value.start, "end": value.end, "label": label[1] if label else None, "fields": plain, "inherited": {k: v for k, v in above.items() if k not in own}, "unresolved": odd})
                own = {k: v for k, v in plain.items() if k in INHERITED}
            elif value.name in shared and value.arguments and isinstance(value.arguments[0], dict):
                settled = {k: literal(v, constants) for k, v in value.arguments[0].items()}
                own = {k: v for k, (v, known) in settled.items() if known and k in INHERITED}
            for a in value.arguments:
                walk(a, above | own)

    reader = _Text(text)
    while reader.kind():
        here = reader.at
        if reader.kind() == "name" and reader.tokens[here + 1][0] == "(":
            walk(reader.simple(), {})
        reader.at = max(reader.at, here + 1)
    return sorted(found, key=lambda d: d["start"])


_TEXTS = T.MapType(T.StringType(), T.StringType())
_ROWS = T.ArrayType(T.StructType([
    T.StructField("entity_type", T.StringType()), T.StructField("entity_id", T.LongType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("label", T.StringType()), T.StructField("fields", _TEXTS), T.StructField("inherited", _TEXTS), T.StructField("unresolved", _TEXTS),
]))


def read_catalogue(files: DataFrame, constants: dict, tags: frozenset[str] = frozenset(), version: tuple[int, ...] = ()) -> DataFrame:
    """path, ordinal and the declarations of files in columns path and text, field values as JSON text.

    constants come from the few files that hold nothing else (see constants_of). A file whose directives do
    not pair up has no rows, as have null and empty ones.
    """

    @F.pandas_udf(_ROWS)
    def rows(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> list[dict]:
            try:
                found = declarations(blank_branches(text or "", tags, version), constants)
            except (LuaError, RecursionError):
                return []
            dump = lambda m: {k: json.dumps(v, ensure_ascii=False) for k, v in m.items()}
            return [{"entity_type": d["type"], "entity_id": d["id"], "start": d["start"], "end": d["end"], "label": d["label"], "fields": dump(d["fields"]), "inherited": dump(d["inherited"]), "unresolved": dump(d["unresolved"])} for d in found]

        return texts.map(one)

    return files.select("path", F.posexplode(rows("text")).alias("ordinal", "_d")).select("path", "ordinal", "_d.*")


def contained_in(found: DataFrame) -> DataFrame:
    """path, parent and child (type, id) of declarations directly inside another one; a thing inside itself is left out."""
    own = found.select("path", F.col("ordinal").alias("child_id"), "start", "end")
    pairs = intervals.enclosing(own, found.select("path", F.col("ordinal").alias("parent_id"), "start", "end", "ordinal"), ["path"], 4096)
    near = intervals.innermost(pairs, ["path", "child_id"])
    end = lambda side: found.select("path", F.col("ordinal").alias(f"{side}_id"), F.col("entity_type").alias(f"{side}_type"), F.col("entity_id").alias(f"{side}_entity"))
    both = near.join(end("parent"), ["path", "parent_id"]).join(end("child"), ["path", "child_id"])
    return both.filter("parent_type <> child_type OR parent_entity <> child_entity").select("path", "parent_type", F.col("parent_entity").alias("parent_id"), "child_type", F.col("child_entity").alias("child_id"))


def merge_declarations(found: DataFrame) -> DataFrame:
    """entity_type, entity_id, field, value, n_values: a field that declarations give different values has none."""
    both = F.map_concat("inherited", "fields")
    long = found.select("entity_type", "entity_id", F.explode(both).alias("field", "value"))
    n = F.count_distinct("value")
    return long.groupBy("entity_type", "entity_id", "field").agg(F.when(n == 1, F.min("value")).alias("value"), n.alias("n_values"))
