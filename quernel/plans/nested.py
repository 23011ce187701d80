"""Problem 1: nested records as related flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.operators.nested import shared_inlining
from quernel.session import table
from quernel.sources.raw_documents import raw_documents

#: infoboxFlags stands in the document or in its member detail, as an object or as JSON text; as a string both read alike.
_DETAILS = "struct<infoboxFlags: string, detail: struct<infoboxFlags: string>>"
_FLAGS = "struct<daily: string, weekly: string, monthly: string, repeatable: string>"


def provenance_tables(records: DataFrame) -> dict[str, DataFrame]:
    return shared_inlining(records.select("row_id", "provenance"), "row_id", "record")


def conflict_tables(conflicts: DataFrame) -> dict[str, DataFrame]:
    # presence is explicit, as a null element must not look like one whose members are null
    items = F.transform("candidates", lambda c: F.struct(c.isNotNull().alias("there"), c["source"].alias("source"), c["revision"].alias("revision"), c["value"].alias("value"), c["state"].alias("state")))
    return shared_inlining(conflicts.select("conflict_id", items.alias("candidates")), "conflict_id", "conflict")


def details_tables(files: DataFrame) -> dict[str, DataFrame]:
    """details documents; infoboxFlags is one shared element, whichever parent it stands under."""
    docs = raw_documents(files, "file_id").filter(F.col("kind") == "details")
    parsed = docs.select(F.struct("file_id", "doc_no").alias("doc"), F.from_json("body", _DETAILS).alias("d"))
    one = lambda c: F.from_json(c, _FLAGS)
    shaped = parsed.select("doc", one(F.col("d.infoboxFlags")).alias("infoboxFlags"), F.struct(one(F.col("d.detail.infoboxFlags")).alias("infoboxFlags")).alias("detail"))
    return shared_inlining(shaped, "doc", "details", shared={"infoboxFlags": "infoboxFlags", "detail.infoboxFlags": "infoboxFlags"})


def is_set(flag: str) -> F.Column:
    """A flag however written: true, 1, "true", "1", "yes"; not false, 0, null, other texts."""
    text = F.lower(F.trim(F.col(flag)))
    return F.coalesce(text.isin("true", "yes", "y", "on", "t") | (F.expr(f"try_cast({flag} AS DOUBLE)") != 0), F.lit(False))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    sources = provenance_tables(table(spark, sf, "source_records"))["provenance.sources"]
    # .../provenance/<key>/sources: the key is the second step from the end and may hold slashes itself
    name = F.regexp_extract("parent_path", r"(?s)^/provenance/(.*)/sources$", 1)
    first = sources.select(F.lit("provenance_source").alias("child_table"), F.col("parent_key").alias("parent_id"), name.alias("child_name"), "child_no")
    candidates = conflict_tables(table(spark, sf, "conflicts"))["candidates"]
    second = candidates.filter("there").select(F.lit("candidate").alias("child_table"), F.col("parent_key").alias("parent_id"), F.col("source").alias("child_name"), "child_no")
    # positions count all complete documents of the file
    flags = details_tables(table(spark, sf, "raw_files"))["infoboxFlags"].filter(is_set("daily"))
    third = flags.select(F.lit("daily").alias("child_table"), F.col("parent_key.file_id").alias("parent_id"), F.lit("daily").alias("child_name"), F.col("parent_key.doc_no").alias("child_no")).distinct()
    return first.unionByName(second).unionByName(third)
