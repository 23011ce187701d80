"""Shared shapes of fields: source spellings of providers, points, id sets and numbers to one form.

Every function takes canonical JSON text and gives a struct of value (canonical JSON text or null)
and state (null, or why there is no value). One bad member makes the whole field invalid: half a
list would be a wrong list. Null input gives null for both.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quernel.functions.scalars import is_exact_integer, nfc

#: Kinds of provider by slot.
SLOT_KINDS = ("npc", "object", "item")
_ID = r"^[1-9][0-9]*$"


def _outcome(text: Column, good: Column, value: Column) -> Column:
    ok = F.coalesce(good, F.lit(False))
    return F.struct(F.when(text.isNotNull() & ok, value).alias("value"), F.when(text.isNotNull() & ~ok, F.lit("invalid")).alias("state"))


def _list(items: Column) -> Column:
    """Distinct texts in order of text, as a JSON list."""
    return F.concat(F.lit("["), F.concat_ws(",", F.array_sort(F.array_distinct(items))), F.lit("]"))


def integer(text: Column, signed: bool = False) -> Column:
    """Integers of any size, at least 0 unless signed; 20.0 is written 20 in canonical text and so is one."""
    good = is_exact_integer(text) if signed else is_exact_integer(text) & ~text.startswith("-")
    return _outcome(text, good, text)


def text_value(text: Column) -> Column:
    """Texts in composed Unicode; entities of markup stay as they are."""
    return _outcome(text, text.rlike(r'^"') & F.try_parse_json(text).isNotNull(), nfc(text))


def text_list(text: Column) -> Column:
    """Lists of texts, order kept."""
    return _outcome(text, text.rlike(r'^\[("(?:[^"\\]|\\.)*"(,"(?:[^"\\]|\\.)*")*)?\]$'), text)


def id_list(text: Column, signed: bool = False) -> Column:
    """Sets of ids above 0 (signed: other than 0), as a list in order of text."""
    ids = F.from_json(text, "array<string>")
    pattern = r"^-?[1-9][0-9]*$" if signed else _ID
    good = text.startswith("[") & ~text.contains('"') & F.forall(ids, lambda i: F.coalesce(i.rlike(pattern), F.lit(False)))
    return _outcome(text, good, _list(ids))


def providers(text: Column, slots: int = 3) -> Column:
    """[[npc ids], [object ids], [item ids]] or [{"id", "type"}, ...] to a sorted set of {"id", "type"}."""
    one = lambda i, kind: F.concat(F.lit('{"id":'), i, F.lit(',"type":"'), kind, F.lit('"}'))
    kinds = F.array(*[F.lit(k) for k in SLOT_KINDS])
    by_slot = F.from_json(text, "array<array<string>>")
    ids = F.transform(by_slot, lambda s: F.coalesce(s, F.array().cast("array<string>")))
    slot_good = (F.size(by_slot) <= slots) & ~text.contains('"') & text.rlike(r"^\[(\[|null|\])") & F.forall(F.flatten(ids), lambda i: F.coalesce(i.rlike(_ID), F.lit(False)))
    from_slots = F.flatten(F.transform(ids, lambda s, n: F.transform(s, lambda i: one(i, F.try_element_at(kinds, n + 1)))))
    listed = F.from_json(text, "array<struct<id: string, type: string>>")
    list_good = text.rlike(r'^\[\{') & ~text.rlike(r'"id":"') & F.forall(listed, lambda p: F.coalesce(p["id"].rlike(_ID) & p["type"].isin(*SLOT_KINDS), F.lit(False)))
    from_list = F.transform(listed, lambda p: one(p["id"], p["type"]))
    return _outcome(text, slot_good | list_good, F.when(text.rlike(r'^\[\{'), _list(from_list)).otherwise(_list(from_slots)))


def spawns(text: Column) -> Column:
    """{"zone": [[x, y], ...]} or [{"zoneId", "x", "y"}, ...] to a sorted set of points, 0 to 100 on either axis.

    The point (-1, -1) says that the thing is in a zone without saying where: such zones come out in a third
    member presence (a sorted list of ids, null if there are none), and the state is unavailable if no point is left.
    """
    number = lambda t: t.try_cast("decimal(38,18)")
    point = lambda z, x, y: F.struct(z.alias("zone"), x.alias("x"), y.alias("y"))
    by_zone = F.from_json(text, "map<string,array<array<string>>>")
    from_map = F.flatten(F.transform(F.map_entries(by_zone), lambda e: F.transform(e["value"], lambda p: F.when(F.size(p) == 2, point(e["key"], p[0], p[1])))))
    listed = F.from_json(text, "array<struct<zoneId: string, x: string, y: string>>")
    from_list = F.transform(listed, lambda p: point(p["zoneId"], p["x"], p["y"]))
    points = F.when(text.startswith("{"), from_map).when(text.startswith("["), from_list)
    unknown = lambda p: (number(p["x"]) == -1) & (number(p["y"]) == -1)
    inside = lambda c: number(c).between(0, 100)
    good = F.forall(points, lambda p: F.coalesce(p["zone"].rlike(_ID) & (unknown(p) | (inside(p["x"]) & inside(p["y"]))), F.lit(False)))
    ok = F.coalesce(good, F.lit(False))
    known = F.filter(points, lambda p: ~unknown(p))
    value = _list(F.transform(known, lambda p: F.concat(F.lit('{"x":'), p["x"], F.lit(',"y":'), p["y"], F.lit(',"zoneId":'), p["zone"], F.lit("}"))))
    zones = F.array_sort(F.array_distinct(F.transform(F.filter(points, unknown), lambda p: p["zone"])))
    only_presence = ok & (F.size(zones) > 0) & (F.size(known) == 0)
    return F.struct(
        F.when(ok & ~only_presence, value).alias("value"),
        F.when(text.isNotNull() & ~ok, "invalid").when(only_presence, "unavailable").alias("state"),
        F.when(ok & (F.size(zones) > 0), F.concat(F.lit("["), F.concat_ws(",", zones), F.lit("]"))).alias("presence"),
    )


#: Fields by shape; all other fields are taken as they are.
SIGNED_FIELDS = ("questLevel", "zoneOrSort", "requiredSpell")
INTEGER_FIELDS = ("requiredLevel", "requiredRaces", "requiredClasses", "questFlags", "nextQuestInChain", "parentQuest", "minLevel", "maxLevel", "rank", "zoneID", "factionID", "itemLevel", "class", "startQuest")
ID_FIELDS = ("preQuestSingle", "exclusiveTo", "childQuests", "inGroupWith", "requiredSourceItems", "breadcrumbs", "npcDrops", "objectDrops", "itemDrops", "questRewards", "vendors", "relatedQuests", "questStarts", "questEnds", "startsQuestIds", "containedItemIds")


def normalize(field: Column, text: Column) -> Column:
    """struct<value, state> of a field by its shape; an unknown field keeps its text."""
    plain = lambda s: F.struct(s["value"].alias("value"), s["state"].alias("state"))
    # each branch sees the text only under its own field, so that no shape parses what it is not for
    under = lambda *names: F.when(field.isin(*names), text)
    return (
        F.when(field.isin(*SIGNED_FIELDS), integer(under(*SIGNED_FIELDS), signed=True))
        .when(field.isin(*INTEGER_FIELDS), integer(under(*INTEGER_FIELDS)))
        .when(field.isin(*ID_FIELDS), id_list(under(*ID_FIELDS)))
        .when(field == "preQuestGroup", id_list(under("preQuestGroup"), signed=True))
        .when(field == "startedBy", providers(under("startedBy")))
        .when(field == "finishedBy", providers(under("finishedBy"), slots=2))
        .when(field == "spawns", plain(spawns(under("spawns"))))
        .when(field == "name", text_value(under("name")))
        .when(field == "objectivesText", text_list(under("objectivesText")))
        .otherwise(F.struct(text.alias("value"), F.lit(None).cast("string").alias("state")))
    )
