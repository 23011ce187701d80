"""Saved web pages: the data that scripts of a page hold, as rows.

Scripts carry JSON behind a marker; where it ends only a JSON reader can tell, so each page is
read once in Python (Arrow batches) and everything else happens on the rows in the JVM. A block
that does not parse is passed over; a page without blocks, an empty and a null page give no rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_JSON = json.JSONDecoder()
#: Marks in front of the data, as pages write them.
LISTVIEW, MAPPER, GIVERS = "new Listview({", "var g_mapperData = ", "var mapShowObject = new ShowOnMap("
#: The head of a list view, in which its template, id and data begin.
HEAD = 700


def json_at(text: str, at: int) -> object:
    """The JSON value that begins at a place, or None."""
    try:
        return _JSON.raw_decode(text, at)[0]
    except (ValueError, RecursionError):
        return None


def blocks(html: str | None) -> Iterator[tuple[str, str | None, object]]:
    """(template, id, data) of every list view; ('mapper', None, ...) and ('givers', None, ...) of maps."""
    if not html:
        return
    at = html.find(LISTVIEW)
    while at >= 0:
        head = html[at : at + HEAD]
        template, name, data = re.search(r"template:\s*'([^']+)'", head), re.search(r"id:\s*'([^']+)'", head), re.search(r"data:", head)
        start = html.find("[", at + data.end()) if data else -1
        rows = json_at(html, start) if start >= 0 else None
        if template and isinstance(rows, list):
            yield template[1], name[1] if name else None, [r for r in rows if isinstance(r, dict)]
        at = html.find(LISTVIEW, at + len(LISTVIEW))
    for kind, mark in (("mapper", MAPPER), ("givers", GIVERS)):
        at = html.find(mark)
        value = json_at(html, at + len(mark)) if at >= 0 else None
        if isinstance(value, dict):
            yield kind, None, value
    listed = re.search(r'(?s)<script type="application/json" id="data\.page\.listPage\.listviews">(\[.*?\])</script>', html)
    for view in (json_at(listed[1], 0) or []) if listed else []:
        if isinstance(view, dict) and isinstance(view.get("data"), list):
            yield str(view.get("template")), view.get("id"), view["data"]


_BLOCKS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("template", "id", "data")]))


@F.pandas_udf(_BLOCKS)
def _blocks(pages: pd.Series) -> pd.Series:
    return pages.map(lambda h: [{"template": t, "id": i, "data": json.dumps(d)} for t, i, d in blocks(h)])


def page_blocks(pages: DataFrame, *keep: str) -> DataFrame:
    """keep, template, id, data (JSON text) of every block of column html."""
    return pages.select(*keep, F.explode(_blocks("html")).alias("_b")).select(*keep, "_b.*")


def listview_rows(found: DataFrame, *keep: str) -> DataFrame:
    """keep, template, id, row_no, row_id (where it is a whole number), row (JSON text): one row per row of a list view."""
    views = found.filter(~F.col("template").isin("mapper", "givers"))
    rows = views.select(*keep, "template", "id", F.posexplode(F.from_json("data", "array<string>")).alias("row_no", "row"))
    return rows.select(*keep, "template", "id", "row_no", F.get_json_object("row", "$.id").try_cast("bigint").alias("row_id"), "row")


_PIN = "coords: array<array<double>>, uiMapId: bigint, uiMapName: string"


def mapper_spawns(found: DataFrame, *keep: str) -> DataFrame:
    """keep, zone_id, ui_map_id, ui_map_name, x, y of every point of a mapper block; pairs of another length are left out."""
    zones = found.filter("template = 'mapper'").select(*keep, F.explode(F.from_json("data", f"map<string, array<struct<{_PIN}>>>")).alias("zone", "_rows"))
    pins = zones.select(*keep, F.col("zone").try_cast("bigint").alias("zone_id"), F.explode("_rows").alias("_p"))
    points = pins.select(*keep, "zone_id", F.col("_p.uiMapId").alias("ui_map_id"), F.col("_p.uiMapName").alias("ui_map_name"), F.explode("_p.coords").alias("_c")).filter(F.size("_c") == 2)
    return points.select(*keep, "zone_id", "ui_map_id", "ui_map_name", F.col("_c")[0].alias("x"), F.col("_c")[1].alias("y"))


def quest_givers(found: DataFrame, *keep: str) -> DataFrame:
    """keep, side, giver_id, name, quest_names, coords of the givers on a zone's map."""
    one = "struct<id: bigint, name: string, type: int, coords: array<array<double>>, quests: array<struct<name: string>>>"
    sides = found.filter("template = 'givers'").select(*keep, F.explode(F.from_json("data", f"map<string, array<{one}>>")).alias("side", "_g"))
    rows = sides.filter(F.col("side").isin("alliancequests", "hordequests")).select(*keep, "side", F.explode("_g").alias("_g"))
    return rows.select(*keep, "side", F.col("_g.id").alias("giver_id"), "_g.name", F.array_compact("_g.quests.name").alias("quest_names"), F.filter("_g.coords", lambda c: F.size(c) == 2).alias("coords"))


def linked_ids(text: Column, kind: str = "quest") -> Column:
    """Distinct numbers of kind=123 in a text, in numeric order; empty for null."""
    found = F.regexp_extract_all(text, F.lit(rf"{kind}=(\d{{1,18}})"), F.lit(1))
    return F.coalesce(F.array_sort(F.array_distinct(F.transform(found, lambda i: i.cast("bigint")))), F.array().cast("array<bigint>"))


#: Paths of list pages by kind.
PAGE_KINDS = (("/quests", "quest-list"), ("/zone=", "zone"), ("/objects", "object-list"), ("/object=", "object"), ("/item=", "item"), ("/npc=", "npc"), ("/quest=", "quest"))


def page_kind(url: Column) -> tuple[Column, Column]:
    """(kind, slug) of a page by its address without query and fragment; kind other and slug '' for unknown ones."""
    bare = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[a-z]+://[^/]+", "")
    kind = F.lit("other")
    for path, name in PAGE_KINDS[::-1]:
        kind = F.when(bare.contains(path), name).otherwise(kind)
    return kind, F.regexp_extract(bare, r"([^/]+)/?$", 1)
