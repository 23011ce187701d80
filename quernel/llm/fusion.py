"""One surviving record per entity from records of several sources that disagree.

Fields that belong together form bundles, which are taken whole from one source; every other
field is a bundle of its own. The choice of a source for each bundle that maximizes the sum of
trust, among those that respect the given functional dependencies, is found by branch and bound.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernel.functions.canonical import plain_number

#: States under which a value cannot be used.
UNUSABLE = ("missing", "unsupported", "unavailable", "invalid", "conflicting")

Bundles = dict[str, list[str]]

#: Where unlisted sources count, sums are whole numbers in which a higher power of this goes before all lower ones.
_STEP = 1 << 60


def value_key(text: str) -> str:
    """Text that is equal for equal values: canonical JSON, texts composed, lists of ids or objects as sets.

    Numbers are exact whatever their size; a text that is no JSON stands for itself.
    """
    try:
        value = json.loads(text, parse_int=_number, parse_float=_number, parse_constant=_refuse)
    except (ValueError, RecursionError):
        return unicodedata.normalize("NFC", text)
    if isinstance(value, list) and value and isinstance(value[0], (tuple, dict)):
        return "[" + ",".join(sorted({_written(v) for v in value})) + "]"
    return _written(value)


def _number(digits: str) -> tuple[str]:
    return (plain_number(digits),)


def _refuse(word: str) -> None:
    raise ValueError(word)


def _written(value: object) -> str:
    if isinstance(value, tuple):
        return value[0]
    if isinstance(value, str):
        return json.dumps(unicodedata.normalize("NFC", value), ensure_ascii=False)
    if isinstance(value, dict):
        return "{" + ",".join(f"{_written(k)}:{_written(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_written, value)) + "]"
    return json.dumps(value)


def usable_values(records: DataFrame) -> DataFrame:
    """entity_type, entity_id, source, generated_at, field, value of the usable values of each source's latest record.

    The latest record has the greatest generated_at (null is oldest), then delivered_at, then row_id; unless
    it is present it has no values. A value is usable unless it is SQL or JSON null, an empty text or list,
    or its state is one of UNUSABLE. Rows without an entity or source are left out. Older rows are cut off
    within each task before the shuffle, so an entity with very many rows does no harm.
    """
    names = ["entity_type", "entity_id", "source"]
    order = Window.partitionBy(*names).orderBy(F.col("generated_at").desc_nulls_last(), F.col("delivered_at").desc_nulls_last(), F.col("row_id").desc_nulls_last())
    kept = records.select(*names, "generated_at", "delivered_at", "row_id", "record_status", "attributes", "field_states").dropna(subset=names)
    latest = kept.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1 AND record_status = 'present'")
    states = F.coalesce("field_states", F.create_map().cast("map<string,string>"))
    usable = lambda e: e["value"].isNotNull() & ~e["value"].rlike(r'^\s*(?:null|""|\[\s*\])?\s*$') & ~F.coalesce(states[e["key"]], F.lit("")).isin(*UNUSABLE)
    cells = latest.select(*names, "generated_at", F.filter(F.map_entries("attributes"), usable).alias("_cells"))
    # records meet by entity while they are whole; taken apart they would be several times as large
    met = cells.filter(F.size("_cells") > 0).repartition("entity_type", "entity_id").select(*names, "generated_at", F.explode("_cells").alias("_c"))
    return met.select(*names, "generated_at", F.col("_c.key").alias("field"), F.col("_c.value").alias("value"))


def choose_sources(values: list[tuple[str, str, str, int | None]], bundles: Bundles, dependencies: list[tuple[str, str]], order: list[str] | None = None) -> list[tuple[str, str]]:
    """(field, source) of one entity, by branch and bound.

    values: (field, source, key, priority), priority None where the source is not listed for the field; such
    values cannot be chosen, unless the order of unlisted sources, best first, is given. A source's trust for a field is 1 / priority, for a bundle the sum over the
    fields it has. A dependency (a, b) asks that the chosen value of b stands beside the chosen value of a
    in some source, if any source that has that value of a has b at all. A bundle that no choice fits is
    left empty. Of equal sums the first in order of source counts.

    With an order every field survives that the dependencies allow: what counts is the number of fields, then the
    fewest sources in a bundle (the members its source lacks come from another), then trust, then the order.
    """
    held = {(f, s): k for f, s, k, _ in values}
    trust = {(f, s): 1.0 / p for f, s, _, p in values if p is not None and p > 0}
    if order is not None:
        last = {s: len(order) - n for n, s in enumerate(order)}
        trust = {(f, s): _STEP**3 + (round(trust[f, s] * 10**9) * _STEP if (f, s) in trust else last[s]) for f, s in held}
    in_bundle = {f: name for name, fields in bundles.items() for f in fields}
    groups: dict[str, list[str]] = {}
    for f in sorted({f for f, _ in trust}):
        groups.setdefault(in_bundle.get(f, f), []).append(f)
    together: dict[tuple[str, str, str], set[str]] = {}
    for a, b in dependencies:
        for (f, s), k in held.items():
            if f == a and (b, s) in held:
                together.setdefault((a, k, b), set()).add(held[b, s])

    def taken(fields: list[str], sources: tuple[str, ...]) -> dict[str, str]:
        """Each field from the first of the sources that has it."""
        return {f: s for s in reversed(sources) for f in fields if (f, s) in trust}

    def covers(fields: list[str], sources: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
        """Sources in turn, each with members that those before it lack, until no member is left."""
        left = [f for f in fields if not any((f, s) in trust for s in sources)]
        for s in sorted({s for f, s in trust if f in left}):
            yield from covers(fields, (*sources, s))
        if not left:
            yield sources

    options = []
    for fields in groups.values():
        of: dict[tuple[str, ...], float] = {}
        if order is not None and len(fields) > 1:
            for sources in covers(fields):
                of[sources] = sum(trust[x] for x in taken(fields, sources).items()) - (len(sources) - 1) * _STEP**2
        else:
            for f, s in trust:
                if f in fields:
                    of[s,] = of.get((s,), 0) + trust[f, s]
        options.append((fields, sorted(of.items(), key=lambda o: (-o[1], o[0]))))
    # bundles under a dependency first, so that a conflict shows early; then the weighty ones
    bound_fields = {f for d in dependencies for f in d}
    options.sort(key=lambda o: (not bound_fields & set(o[0]), -o[1][0][1], o[0]))
    rest = [0]
    for _, of in reversed(options):
        rest.append(rest[-1] + of[0][1])
    rest.reverse()
    best: tuple[float, list[tuple[str, ...] | None]] = (-1, [])
    rounding = 1e-12 if order is None else 0

    def fits(chosen: dict[str, str]) -> bool:
        for a, b in dependencies:
            if a in chosen and b in chosen:
                allowed = together.get((a, held[a, chosen[a]], b))
                if allowed and held[b, chosen[b]] not in allowed:
                    return False
        return True

    def branch(n: int, total: float, picks: list[tuple[str, ...] | None], chosen: dict[str, str]) -> None:
        nonlocal best
        if total + rest[n] <= best[0] + rounding:
            return
        if n == len(options):
            best = (total, picks)
            return
        fields, of = options[n]
        for sources, gain in of:
            more = chosen | taken(fields, sources)
            if not bound_fields or fits(more):
                branch(n + 1, total + gain, [*picks, sources], more)
        if bound_fields:
            branch(n + 1, total, [*picks, None], chosen)

    branch(0, 0, [], {})
    return [x for (fields, _), sources in zip(options, best[1], strict=False) if sources is not None for x in taken(fields, sources).items()]


_CHOICE = T.MapType(T.StringType(), T.StructType([T.StructField("source", T.StringType()), T.StructField("n_values", T.IntegerType())]))


def fuse_records(records: DataFrame, policy: DataFrame, bundles: Bundles | None = None, dependencies: list[tuple[str, str]] | None = None, unlisted: bool = False) -> DataFrame:
    """entity_type, entity_id, field, source, value, n_values: the surviving value of every field.

    policy: entity_type, field, source, priority (1 is first). n_values counts the different usable values of
    the field over all sources, also unlisted ones. An entity's values are one per source and field, which
    bounds what is brought together for the search. Fields that no listed source has are left out, unless
    unlisted: then sources that are not listed for a field come after all listed ones, the latest generated_at
    first (null is oldest), then the most usable fields, then the name.

    The search is for what can conflict: fields of bundles and dependencies, and fields with several values.
    A field of its own with one value takes its best source at once, as any search would.
    """
    bundles, dependencies = bundles or {}, dependencies or []
    bound = sorted({f for d in dependencies for f in d} | {f for fields in bundles.values() for f in fields})
    entity = ["entity_type", "entity_id"]
    ranks = policy.dropna(subset=["entity_type", "field", "source", "priority"]).filter("priority > 0").groupBy("entity_type", "field", "source").agg(F.min("priority").alias("priority"))
    values = usable_values(records).join(ranks, ["entity_type", "field", "source"], "left")
    # the values are together by entity already; texts are compared before any is parsed
    item = F.struct("source", "value", "priority", F.unix_micros(F.col("generated_at").cast("timestamp")).alias("at"))
    fields = values.groupBy(*entity, "field").agg(F.collect_list(item).alias("held"), (F.min("value") != F.max("value")).alias("several"))
    whole = fields.groupBy(*entity).agg(F.collect_list(F.struct("field", "held", "several")).alias("fields"))
    if unlisted:
        # sources of the entity, best first
        seen = F.flatten(F.transform("fields", lambda f: F.transform(f["held"], lambda h: F.struct(h["source"].alias("source"), h["at"].alias("at")))))
        count = lambda s: F.size(F.filter("_seen", lambda x: x["source"] == s["source"]))
        best = F.transform(F.array_distinct("_seen"), lambda s: F.struct((-F.coalesce(s["at"], F.lit(-(1 << 62)))).alias("at"), (-count(s)).alias("n"), s["source"].alias("source")))
        whole = whole.withColumn("_seen", seen).withColumn("sources", F.transform(F.array_sort(best), lambda s: s["source"])).drop("_seen")
    else:
        whole = whole.withColumn("sources", F.lit(None).cast("array<string>"))

    @F.pandas_udf(_CHOICE)
    def choose(fields: pd.Series, sources: pd.Series) -> pd.Series:
        def one(fields: list[dict] | None, sources: list[str] | None) -> dict[str, dict] | None:
            if fields is None:
                return None
            # where all texts are the same they need no parsing
            keys = {f["field"]: [value_key(h["value"]) if f["several"] else "" for h in f["held"]] for f in fields}
            wanted = [(f["field"], h["source"], k, None if pd.isna(h["priority"]) else int(h["priority"])) for f in fields for h, k in zip(f["held"], keys[f["field"]], strict=True)]
            chosen = dict(choose_sources(wanted, bundles, dependencies, None if sources is None else list(sources)))
            return {f: {"source": chosen.get(f), "n_values": len(set(k))} for f, k in keys.items()}

        return pd.Series([one(f, s) for f, s in zip(fields, sources, strict=True)], dtype=object)

    open_ = lambda f: f["several"] | f["field"].isin(*bound)
    sent = F.filter("fields", open_)
    lean = F.transform(sent, lambda f: f.withField("held", F.transform(f["held"], lambda h: h.dropFields("at"))))
    some = F.size(sent) > 0
    picked = whole.withColumn("picked", choose(F.when(some, lean), F.when(some, F.col("sources"))))
    each = picked.select(*entity, "sources", "picked", F.explode("fields").alias("_f")).select(*entity, "sources", "_f.*", F.col("picked")[F.col("_f.field")].alias("pick"))
    rank = lambda h: F.when(h["priority"].isNotNull(), F.lit(0).cast("bigint")).otherwise(F.array_position("sources", h["source"]))
    allowed = F.col("held") if unlisted else F.filter("held", lambda h: h["priority"].isNotNull())
    first = F.array_min(F.transform(allowed, lambda h: F.struct(h["priority"].isNull(), F.coalesce(h["priority"], F.lit(0)), rank(h), h["source"].alias("source"))))["source"]
    chosen = each.select(*entity, "field", "held", F.when(F.col("pick").isNotNull(), F.col("pick.source")).otherwise(first).alias("source"), F.coalesce("pick.n_values", F.lit(1)).alias("n_values")).filter("source IS NOT NULL")
    value = F.filter("held", lambda h: h["source"] == F.col("source"))[0]["value"]
    return chosen.select(*entity, "field", "source", value.alias("value"), "n_values")


def surviving_records(fused: DataFrame) -> DataFrame:
    """entity_type, entity_id, attributes (field -> JSON text), sources (field -> source): one row per entity."""
    rows = F.array_sort(F.collect_list(F.struct("field", "value", "source")))
    whole = fused.groupBy("entity_type", "entity_id").agg(rows.alias("_r"))
    pairs = lambda m: F.map_from_entries(F.transform("_r", lambda r: F.struct(r["field"], r[m])))
    return whole.select("entity_type", "entity_id", pairs("value").alias("attributes"), pairs("source").alias("sources"))
