"""Plain Python versions of the problems of the subpackage, for comparison with the operators."""

from __future__ import annotations

import json
import unicodedata
from collections import defaultdict
from fractions import Fraction


def key(v):
    if isinstance(v, str):
        return ("text", unicodedata.normalize("NFC", v))
    if isinstance(v, dict):
        return ("object", tuple(sorted((k, key(x)) for k, x in v.items())))
    if isinstance(v, list):
        parts = [key(x) for x in v]
        return ("set", frozenset(parts)) if v and not isinstance(v[0], str) else ("list", tuple(parts))
    return (type(v).__name__, v)


def p2(records, policy):
    latest = {}
    for r in records:
        k = (r["entity_type"], r["entity_id"], r["source"])
        if k not in latest or r["generated_at"] > latest[k]["generated_at"]:
            latest[k] = r
    values = defaultdict(dict)
    for (kind, entity, source), r in latest.items():
        if r["record_status"] != "present":
            continue
        states = dict(r["field_states"] or [])
        for field, text in r["attributes"] or []:
            v = json.loads(text, parse_float=Fraction, parse_int=Fraction) if text is not None else None
            if v is None or v == "" or v == [] or states.get(field) in ("missing", "unsupported", "unavailable", "invalid", "conflicting"):
                continue
            values[kind, entity, field][source] = key(v)
    order = defaultdict(list)
    for p in sorted(policy, key=lambda p: p["priority"]):
        order[p["entity_type"], p["field"]].append(p["source"])
    rows = set()
    for (kind, entity, field), held in values.items():
        if len(set(held.values())) > 1:
            first = next((s for s in order[kind, field] if s in held), None)
            if first:
                rows.add((kind, entity, field, first))
    return rows
