"""Tables extracted from a client: JSON lines with a header line, as records.

The first line names the table and what it was made from; every other line is a row {kind: record,
id, fields}. Rows become records of the entity type the table stands for; a null field becomes the
state unavailable; known client names of fields are also given under their shared name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entity type by table, and whether ids carry the table's name in front (where tables share a type).
TABLES = {
    "QuestV2": ("quest", False), "Creature": ("npc", False), "ItemSparse": ("item", False), "Item": ("item", True), "GameObjects": ("object", False), "AreaTable": ("zone", False), "Map": ("map", False),
    "SpellName": ("spell", False), "Faction": ("faction", False), "Achievement": ("achievement", False), "SkillLine": ("profession", False), "QuestInfo": ("questmetadata", True), "QuestSort": ("questmetadata", True), "QuestLineXQuest": ("relationship", True),
}
#: Client names of fields by entity type, and the shared name they are also known by.
ALIASES = {
    ("npc", "Name_lang"): "name", ("item", "Display_lang"): "name", ("item", "ItemLevel"): "itemLevel", ("item", "RequiredLevel"): "requiredLevel", ("zone", "AreaName_lang"): "name", ("map", "MapName_lang"): "name",
    ("spell", "Name_lang"): "name", ("faction", "Name_lang"): "name", ("achievement", "Title_lang"): "name", ("quest", "UiQuestDetailsThemeID"): "questUiThemeId", ("quest", "UniqueBitFlag"): "uniqueBitFlag",
}
_HEADER = "struct<kind: string, table: string, source: string, clientBuild: bigint, definitionSha256: string, schemaVersion: int>"
_ROW = "struct<kind: string, id: bigint, fields: map<string, variant>>"


def table_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, value: the lines of table files below a folder, gzip or plain."""
    return spark.read.option("recursiveFileLookup", True).text(path).select(F.col("_metadata.file_path").alias("file"), "value")


def table_errors(lines: DataFrame) -> DataFrame:
    """file, error of files that are not as they should be: no header or two, blank lines, rows without an id, repeated ids.

    Counts combine per file; a repeated id is found by one aggregation over file and id.
    """
    kind, row = F.get_json_object("value", "$.kind"), F.get_json_object("value", "$.id").try_cast("bigint")
    marked = lines.select("file", kind.alias("kind"), row.alias("id"), (F.length(F.trim("value")) == 0).alias("blank"))
    count = lambda c, n: F.count_if(F.coalesce(c, F.lit(False))).alias(n)
    sums = marked.groupBy("file").agg(count(F.col("kind") == "table", "headers"), count(F.col("blank"), "blanks"), count(~F.col("blank") & ((F.col("kind").isNull()) | ~F.col("kind").isin("table", "record") | ((F.col("kind") == "record") & F.col("id").isNull())), "odd"))
    twice = marked.filter("kind = 'record' AND id IS NOT NULL").groupBy("file", "id").count().filter("count > 1").select("file", F.lit("repeated id").alias("error")).distinct()
    problems = F.array_compact(F.array(F.when(F.col("headers") != 1, "not one header"), F.when(F.col("blanks") > 0, "blank line"), F.when(F.col("odd") > 0, "odd row")))
    return sums.select("file", F.explode(problems).alias("error")).unionByName(twice)


def alias_fields(entity_type: Column, attributes: Column) -> Column:
    """attributes with the shared name of known client fields added; the client's own name stays."""
    extra = [F.when((entity_type == t) & attributes[f].isNotNull(), F.struct(F.lit(a).alias("key"), attributes[f].alias("value"))) for (t, f), a in ALIASES.items()]
    added = F.map_from_entries(F.array_compact(F.array(*extra)))
    known = F.map_filter(attributes, lambda k, _: ~F.array_contains(F.map_keys(added), k))
    return F.map_concat(known, added)


def table_records(lines: DataFrame) -> DataFrame:
    """Records of the rows of known tables: source as the header says, revision by build; rows of other tables are left out.

    The header of a file is joined to its rows; one row per file, so the join stays as wide as there are files.
    """
    heads = lines.filter(F.get_json_object("value", "$.kind") == "table").select("file", F.from_json("value", _HEADER).alias("h"))
    heads = heads.select("file", "h.table", F.col("h.source").alias("source"), F.col("h.clientBuild").cast("string").alias("source_revision"))
    known = lines.sparkSession.createDataFrame([(t, e, p) for t, (e, p) in TABLES.items()], "table string, entity_type string, prefixed boolean")
    rows = lines.filter(F.get_json_object("value", "$.kind") == "record").select("file", F.from_json("value", _ROW).alias("r"))
    named = rows.join(heads.join(known, "table"), "file")
    values = F.transform_values("r.fields", lambda _, v: F.coalesce(F.to_json(v), F.lit("null")))
    present, gone = F.map_filter(values, lambda _, v: v != "null"), F.map_filter(values, lambda _, v: v == "null")
    own_id = F.when(F.col("prefixed"), F.concat_ws(":", "table", F.col("r.id").cast("string"))).otherwise(F.col("r.id").cast("string"))
    literal = F.create_map(F.lit("clientTable"), F.concat(F.lit('"'), F.col("table"), F.lit('"')))
    return named.select(
        F.lit(1).alias("schema_version"), "entity_type", own_id.alias("entity_id"), "source", "source_revision",
        F.map_concat(alias_fields(F.col("entity_type"), present), literal).alias("attributes"), F.transform_values(gone, lambda _, v: F.lit("unavailable")).alias("field_states"),
    )
