"""Objectives of quests: positional slots or named groups to named groups.

Slots nest four levels deep and every slot has members of its own, so this one shape runs in
Python, from a table of what each slot holds; all other shapes are in the JVM (see shapes).
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class _Exact(str):
    """A number by its digits."""


def _is_id(v: object) -> bool:
    return isinstance(v, _Exact) and re.fullmatch(r"[1-9]\d*", v) is not None


def _is_ids(v: object) -> bool:
    return isinstance(v, list) and all(map(_is_id, v))


def _is_text(v: object) -> bool:
    return isinstance(v, str) and not isinstance(v, _Exact)


def _is_number(v: object) -> bool:
    return isinstance(v, _Exact)


#: Slots in order, and of each the members of an entry with what they must be. The first member is required.
_SLOTS = (
    ("creature", (("id", _is_id), ("text", _is_text), ("iconFile", None))),
    ("object", (("id", _is_id), ("text", _is_text), ("iconFile", None))),
    ("item", (("id", _is_id), ("text", _is_text), ("iconFile", None))),
    ("reputation", (("id", _is_id), ("value", _is_number))),
    ("killCredit", (("ids", _is_ids), ("baseId", _is_id), ("text", _is_text), ("iconFile", None))),
    ("spell", (("id", _is_id), ("text", _is_text), ("itemId", _is_id))),
)
#: Groups that may come by name.
_NAMED = ("creature", "object", "item")


def _entry(parts: object, members: tuple) -> dict | None:
    """Members by name, or None if the entry is not what the slot holds."""
    if not isinstance(parts, list) or not parts or len(parts) > len(members):
        return None
    out = {}
    for n, ((name, check), value) in enumerate(zip(members, parts, strict=False)):
        if value is None and n:
            continue
        if check is not None and not check(value):
            return None
        out[name] = sorted(set(value)) if name == "ids" else value
    return out


def group_objectives(value: object) -> dict | None:
    """Named groups of a parsed value, or None if any part of it is wrong."""
    if value == []:
        return {}
    if isinstance(value, dict):
        good = all(k in _NAMED and isinstance(v, list) and all(isinstance(e, dict) and _is_id(e.get("id")) for e in v) for k, v in value.items())
        return value if good else None
    if not isinstance(value, list) or len(value) > len(_SLOTS):
        return None
    out = {}
    for (kind, members), slot in zip(_SLOTS, value, strict=False):
        if slot is None:
            continue
        if not isinstance(slot, list):
            return None
        entries = [_entry(e, members) for e in ([slot] if kind == "reputation" else slot)]
        if any(e is None for e in entries) or (kind == "reputation" and len(slot) != 2):
            return None
        out[kind] = entries
    return out


def _dump(value: object) -> str:
    if isinstance(value, _Exact):
        return str(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_dump(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_dump, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


def normalize_objectives(text: str | None) -> tuple[str | None, str | None]:
    """(canonical text of the groups, state) of a canonical JSON text."""
    if text is None:
        return None, None
    try:
        groups = group_objectives(json.loads(text, parse_int=_Exact, parse_float=_Exact))
    except (ValueError, RecursionError):
        groups = None
    return (None, "invalid") if groups is None else (_dump(groups), None)


@F.pandas_udf(T.StructType([T.StructField("value", T.StringType()), T.StructField("state", T.StringType())]))
def _objectives(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([normalize_objectives(t) for t in texts], columns=["value", "state"])


def objectives(text: Column) -> Column:
    """struct<value, state> of objectives in canonical JSON text; null for null."""
    return _objectives(text)

