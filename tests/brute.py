"""Plain Python versions of the core problems, for comparison with the operators."""

from __future__ import annotations

import json
from collections import defaultdict
from fractions import Fraction


def value(text):
    """A JSON value to compare: numbers exact, objects as sorted members."""
    return freeze(json.loads(text, parse_float=Fraction, parse_int=Fraction))


def freeze(v):
    if isinstance(v, dict):
        return ("object", tuple(sorted((k, freeze(x)) for k, x in v.items())))
    if isinstance(v, list):
        return ("list", tuple(freeze(x) for x in v))
    return (type(v).__name__, v)


def documents(text):
    """(kind, id, document) of complete documents, by trying every opening brace."""
    out, at, text = [], 0, text or ""
    while (at := text.find("{", at)) >= 0:
        try:
            doc, end = json.JSONDecoder().raw_decode(text, at)
        except ValueError:
            at += 1
            continue
        if isinstance(doc.get("questId"), int):
            out.append(("details", doc["questId"], doc))
        elif doc.get("kind") == "object" and isinstance(doc.get("id"), int):
            out.append(("object", doc["id"], doc))
        at = end
    return out


def p1(records, conflicts, files):
    rows = set()
    for r in records:
        for key, p in r["provenance"] or []:
            for n, s in enumerate((p or {}).get("sources") or []):
                rows.add(("provenance_source", r["row_id"], key, n))
    for c in conflicts:
        for n, x in enumerate(c["candidates"] or []):
            if x is not None:
                rows.add(("candidate", c["conflict_id"], x["source"], n))
    for f in files:
        for n, (kind, _, doc) in enumerate(documents(f["file_text"])):
            if kind == "details":
                flags = [doc.get("infoboxFlags"), (doc.get("detail") or {}).get("infoboxFlags")]
                flags = [json.loads(x) if isinstance(x, str) else x for x in flags]
                if any(str((x or {}).get("daily")).lower() in ("true", "1") for x in flags):
                    rows.add(("daily", f["file_id"], "daily", n))
    return rows


def live_entities(records, zones):
    latest = {}
    for r in records:
        k = (r["entity_type"], r["entity_id"], r["source"])
        if k not in latest or r["generated_at"] > latest[k]["generated_at"]:
            latest[k] = r
    live = {(k[0], k[1]) for k, r in latest.items() if r["record_status"] == "present" and k[0] != "zone"}
    return live | {("zone", str(z["area_id"])) for z in zones}


def p3(records, relationships, containments, zones):
    live, rows = live_entities(records, zones), set()

    def refer(name, ref, kind, to):
        if to not in (None, "", 0) and (kind, str(to)) not in live:
            rows.add((name, ref, kind, str(to)))

    for e in relationships:
        refer("relationships", e["edge_id"], e["from_type"], e["from_id"])
        refer("relationships", e["edge_id"], e["to_type"], e["to_id"])
    for c in containments:
        refer("containments", c["containment_id"], c["child_type"], c["child_id"])
    for r in records:
        if r["record_status"] != "present":
            continue
        for field, text in r["attributes"] or []:
            v = json.loads(text) if text else None
            if field in ("nextQuestInChain", "parentQuest", "startQuest") and v is not None:
                refer("source_records", r["row_id"], "quest", int(v))
            if field in ("preQuestSingle", "questStarts", "startsQuestIds"):
                for x in v or []:
                    refer("source_records", r["row_id"], "quest", int(x))
            if field == "startedBy":
                for x in v or []:
                    refer("source_records", r["row_id"], x["type"], int(x["id"]))
    return rows


def p4(left, right):
    def latest(rows):
        out = {}
        for r in rows:
            k = (r["flavor"], r["entity_type"], r["entity_id"])
            if k not in out or r["loaded_at"] > out[k]["loaded_at"]:
                out[k] = r
        return out

    def diff(a, b, path):
        for k in {*a, *b}:
            p = f"{path}.{k}" if path else k
            if k not in a or k not in b:
                yield p
            elif isinstance(a[k], dict) and isinstance(b[k], dict):
                yield from diff(a[k], b[k], p)
            elif freeze(a[k]) != freeze(b[k]):
                yield p

    load = lambda s: json.loads(s, parse_float=Fraction, parse_int=Fraction)
    a, b, rows = latest(left), latest(right), set()
    for k in {*a, *b}:
        if k not in b or k not in a:
            rows.add((k[1], k[2], "leftOnly" if k in a else "rightOnly", ""))
            continue
        for p in diff(load(a[k]["attributes"]), load(b[k]["attributes"]), ""):
            rows.add((k[1], k[2], "changed", p))
        s, t = dict(a[k]["field_states"] or []), dict(b[k]["field_states"] or [])
        for f in {*s, *t}:
            if s.get(f) != t.get(f):
                rows.add((k[1], k[2], "changed", f"$fieldStates.{f}"))
    return rows


def p5(files):
    return {(k, i) for f in files for k, i, _ in documents(f["file_text"])}


def p6(snapshots, manifests):
    revisions = defaultdict(dict)
    for m in manifests:
        complete, at = revisions[m["source"]].get(m["source_revision"], (True, None))
        revisions[m["source"]][m["source_revision"]] = (complete and m["status"] == "complete", m["generated_at"])
    held = defaultdict(dict)
    for r in snapshots:
        held[r["source"], r["source_revision"]][r["entity_type"], r["entity_id"]] = frozenset((k, value(v)) for k, v in r["attributes"] or [] if k != "fetchedAt")
    rows = set()
    for source, known in revisions.items():
        order = [r for _, r in sorted((at, r) for r, (complete, at) in known.items() if complete)]
        for before, after in zip(order, order[1:]):
            a, b = held[source, before], held[source, after]
            for k in {*a, *b}:
                if a.get(k) != b.get(k):
                    rows.add((source, after, *k, "added" if k not in a else "removed" if k not in b else "changed"))
    return rows


def p7(containments):
    up = {(c["child_type"], c["child_id"]): (c["parent_type"], c["parent_id"]) for c in containments if c["parent_id"] is not None}
    rows = set()
    for node in up:
        at, depth, seen = node, 0, set()
        while at in up and at not in seen:
            seen.add(at)
            at, depth = up[at], depth + 1
        rows.add((*node, "cycle", -1, -1) if at in up else (*node, *at, depth))
    return rows
