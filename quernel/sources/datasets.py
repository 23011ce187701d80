"""Datasets of records on disk: JSON lines in sorted, checksummed parts with a manifest.

A dataset is a folder with manifest.json and part files of JSON lines. Parts hold ranges of the key
in order, so the whole is sorted without one task writing it all; the manifest lists the rows and
the SHA-256 of every part, and its own checksum is that of the list of parts. A new version is
written beside the old one and takes its place by renaming, so readers see one or the other.
"""

from __future__ import annotations

import hashlib
import json
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.session import cut

#: Members of a record as written, and entity types and states that are allowed.
ENTITY_TYPES = ("quest", "npc", "item", "object", "zone", "map", "spell", "faction", "achievement", "profession", "relationship", "questmetadata")
STATES = ("missing", "unsupported", "unavailable", "invalid", "empty", "conflicting")
_PROVENANCE = "struct<source:string,revision:string,sources:array<struct<source:string,revision:string>>,path:string,provider:string,selectionRule:string>"
_LINE = f"schemaVersion int, flavor string, entityType string, entityId string, source string, sourceRevision string, attributes map<string,variant>, fieldStates map<string,string>, provenance map<string,{_PROVENANCE}>"
#: Parts of at least so many bytes are written as gzip.
GZIP_FROM = 50 << 20


class DatasetError(ValueError):
    """A dataset that does not agree with its manifest or the record contract."""


def to_lines(records: DataFrame) -> Column:
    """One JSON line per record, members in order of name, values canonical; empty maps and nulls are left out."""
    quoted = lambda k: F.regexp_extract(F.to_json(F.array(k)), r"(?s)^\[(.*)\]$", 1)
    entries = F.array_sort(F.map_entries("attributes"), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    attributes = F.concat(F.lit("{"), F.concat_ws(",", F.transform(entries, lambda e: F.concat(quoted(e["key"]), F.lit(":"), F.coalesce(e["value"], F.lit("null"))))), F.lit("}"))
    provenance = F.transform_values("provenance", lambda _, p: F.when(p.isNotNull(), F.struct(p["source"].alias("source"), p["revision"].alias("revision"), p["sources"].alias("sources"), p["path"].alias("path"), p["provider"].alias("provider"), p["selection_rule"].alias("selectionRule"))))
    rest = F.to_json(
        F.struct(
            F.col("schema_version").alias("schemaVersion"), "flavor", F.col("entity_type").alias("entityType"), F.col("entity_id").alias("entityId"), "source", F.col("source_revision").alias("sourceRevision"),
            F.when(F.size("field_states") > 0, F.col("field_states")).alias("fieldStates"), F.when(F.size("provenance") > 0, provenance).alias("provenance"),
        )
    )
    whole = F.concat(F.lit('{"attributes":'), F.coalesce(attributes, F.lit("{}")), F.lit(","), F.substr(rest, F.lit(2)))
    return F.to_json(F.parse_json(whole))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Records of JSON lines in column value; unreadable lines come out with error 'unreadable' and nulls.

    Of a member that is named twice the last counts. Columns: the record, and errors (see record_errors).
    """
    known = F.from_json("value", _LINE, {"mode": "PERMISSIVE"})
    extra = F.array_except(F.json_object_keys("value"), F.array(*[F.lit(c) for c in ("schemaVersion", "flavor", "entityType", "entityId", "source", "sourceRevision", "attributes", "fieldStates", "provenance")]))
    parsed = lines.select(known.alias("r"), F.try_parse_json("value").isNull().alias("_bad"), F.coalesce(F.size(extra) > 0, F.lit(False)).alias("_extra"))
    records = parsed.select(
        F.col("r.schemaVersion").alias("schema_version"), "r.flavor", F.col("r.entityType").alias("entity_type"), F.col("r.entityId").alias("entity_id"), "r.source", F.col("r.sourceRevision").alias("source_revision"),
        F.transform_values("r.attributes", lambda _, v: F.coalesce(F.to_json(v), F.lit("null"))).alias("attributes"), F.col("r.fieldStates").alias("field_states"),
        F.transform_values("r.provenance", lambda _, p: F.struct(p["source"].alias("source"), p["revision"].alias("revision"), p["sources"].alias("sources"), p["path"].alias("path"), p["provider"].alias("provider"), p["selectionRule"].alias("selection_rule"))).alias("provenance"),
        "_bad", "_extra",
    )
    found = F.concat(F.when(F.col("_bad"), F.array(F.lit("unreadable"))).otherwise(record_errors()), F.when(F.col("_extra"), F.array(F.lit("unknown member"))).otherwise(F.array().cast("array<string>")))
    return records.withColumn("errors", found).drop("_bad", "_extra")


def record_errors() -> Column:
    """Names of the rules of the record contract that a row breaks; an empty array if none."""
    one_line = lambda c: F.coalesce((F.length(F.trim(F.col(c))) > 0) & ~F.col(c).rlike(r"[\r\n]"), F.lit(False))
    states = F.coalesce(F.map_values("field_states"), F.array().cast("array<string>"))
    emptied = F.map_filter(F.coalesce("field_states", F.create_map().cast("map<string,string>")), lambda _, s: s == "empty")
    usable = F.map_filter(F.coalesce("field_states", F.create_map().cast("map<string,string>")), lambda _, s: s != "empty")
    not_empty = F.exists(F.map_keys(emptied), lambda k: ~F.coalesce(F.col("attributes")[k].isin("null", '""', "[]", "{}"), F.lit(False)))
    traced = F.coalesce(F.map_keys("provenance"), F.array().cast("array<string>"))
    held = F.array_union(F.coalesce(F.map_keys("attributes"), F.array().cast("array<string>")), F.coalesce(F.map_keys("field_states"), F.array().cast("array<string>")))
    rules = {
        "schema version": ~F.coalesce(F.col("schema_version") == 1, F.lit(False)),
        "flavor": ~one_line("flavor"),
        "entity type": ~F.coalesce(F.col("entity_type").isin(*ENTITY_TYPES), F.lit(False)),
        "entity id": ~one_line("entity_id"),
        "source": ~one_line("source"),
        "revision": ~one_line("source_revision"),
        "attributes": F.col("attributes").isNull(),
        "attribute value": F.coalesce(F.exists(F.map_values("attributes"), lambda v: v.isNull() | F.try_parse_json(v).isNull()), F.lit(False)),
        "state": F.exists(states, lambda s: ~F.coalesce(s.isin(*STATES), F.lit(False))),
        "empty state on a value": not_empty,
        "state beside a value": F.exists(F.map_keys(usable), lambda k: F.coalesce(~F.col("attributes")[k].isin("null", '""', "[]", "{}"), F.lit(False))),
        "provenance of no field": F.size(F.array_except(traced, held)) > 0,
        "provenance source": F.coalesce(F.exists(F.map_values("provenance"), lambda p: p.isNull() | (F.length(F.coalesce(p["source"], F.lit(""))) == 0)), F.lit(False)),
    }
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))


def _files(spark: SparkSession, path: str):  # noqa: ANN202
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def _part_sums(spark: SparkSession, path: str) -> list[dict]:
    """Name, bytes and SHA-256 of every part: one row per file, read where the files are."""
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    rows = parts.select(F.regexp_extract("path", r"(part-\d+)[^/]*$", 1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    return [r.asDict() for r in rows.orderBy("name").collect()]


def _digest(parts: list[dict]) -> str:
    return hashlib.sha256("".join(f"{p['sha256']}\n" for p in parts).encode()).hexdigest()


def write_dataset(records: DataFrame, path: str, manifest: dict, parts: int = 0) -> dict:
    """Write records as a dataset, replacing what is there; gives the manifest as written.

    Rows that break the record contract or repeat a key fail the write before anything is replaced.
    The same records give the same bytes, whatever their order. parts 0: as many as Spark shuffles into.
    """
    spark = records.sparkSession
    checked = cut(records.select("*", record_errors().alias("_e")))
    if bad := checked.filter("size(_e) > 0").select("entity_type", "entity_id", "_e").take(3):
        raise DatasetError(f"records break the contract: {bad}")
    if twice := checked.groupBy("entity_type", "entity_id").count().filter("count > 1").take(3):
        raise DatasetError(f"keys repeat: {twice}")
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = checked.select("entity_type", "entity_id", to_lines(checked).alias("value"))
    total = lines.agg(F.sum(F.octet_length("value") + 1)).first()[0] or 0
    staged = f"{path.rstrip('/')}.new"
    fs, new_path = _files(spark, path)
    fs.delete(new_path(staged), True)
    sorted_lines = lines.repartitionByRange(n, "entity_type", "entity_id").sortWithinPartitions("entity_type", "entity_id")
    sorted_lines.select("value").write.option("compression", "gzip" if total / n >= GZIP_FROM else "none").text(staged)
    listed = _part_sums(spark, staged)
    whole = manifest | {"schemaVersion": 1, "recordCount": checked.count(), "recordsSha256": _digest(listed), "parts": [{k: p[k] for k in ("name", "bytes", "sha256")} for p in listed]}
    whole.setdefault("generatedAt", datetime.now(UTC).isoformat(timespec="seconds"))
    out = fs.create(new_path(f"{staged}/manifest.json"), True)
    out.write(bytearray((json.dumps(whole, sort_keys=True, indent=2) + "\n").encode()))
    out.close()
    replace_tree(spark, staged, path)
    return whole


def replace_tree(spark: SparkSession, staged: str, path: str) -> None:
    """Put a staged folder in place of path; the old one is kept as .old until the new one is there, and comes back if that fails."""
    fs, new_path = _files(spark, path)
    old = new_path(f"{path.rstrip('/')}.old")
    if fs.exists(old):
        raise DatasetError(f"{old} is left over from a broken replacement")
    had = fs.exists(new_path(path))
    if had and not fs.rename(new_path(path), old):
        raise DatasetError(f"{path} can't be moved away")
    if not fs.rename(new_path(staged), new_path(path)):
        if had:
            fs.rename(old, new_path(path))
        raise DatasetError(f"{staged} can't be moved to {path}")
    if had:
        fs.delete(old, True)


def read_manifest(spark: SparkSession, path: str) -> dict:
    rows = spark.read.text(f"{path}/manifest.json", wholetext=True).collect()
    return json.loads(rows[0].value)


def read_dataset(spark: SparkSession, path: str, verify: bool = True) -> DataFrame:
    """Records of a dataset; verify compares parts, sums, count and identity with the manifest and raises DatasetError."""
    manifest = read_manifest(spark, path)
    records = parse_lines(spark.read.option("pathGlobFilter", "part-*").text(path))
    if verify:
        parts = _part_sums(spark, path)
        if _digest(parts) != manifest["recordsSha256"]:
            raise DatasetError(f"{path}: checksums differ from the manifest")
        same = (F.col("source") == manifest["source"]) & (F.col("source_revision") == manifest["sourceRevision"]) & (F.col("flavor") == manifest["flavor"]) if "source" in manifest else F.lit(True)
        seen = records.agg(F.count("*").alias("n"), F.count_if((F.size("errors") > 0) | ~F.coalesce(same, F.lit(False))).alias("bad")).first()
        if seen.n != manifest["recordCount"] or seen.bad:
            raise DatasetError(f"{path}: {seen.n} records, of which {seen.bad} don't agree with the manifest, which has {manifest['recordCount']}")
    return records.drop("errors")


def read_sources(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several datasets as one; each keeps its source."""
    out = None
    for path in paths:
        out = read_dataset(spark, path) if out is None else out.unionByName(read_dataset(spark, path))
    if out is None:
        raise DatasetError("no datasets")
    return out


def compare_trees(left: list[dict], right: list[dict]) -> dict[str, str]:
    """Part name -> missing, stale or changed, from two lists of parts; equal parts are left out."""
    a, b = ({p["name"]: p["sha256"] for p in parts} for parts in (left, right))
    return {n: "missing" if n not in b else "stale" if n not in a else "changed" for n in sorted(a.keys() | b.keys()) if a.get(n) != b.get(n)}
