"""Complete JSON documents inside the text of small raw files.

A file text is one document, several one after the other, or one array; it may start with a
byte order mark, be cut off anywhere, be blank or null. Every document that is complete comes
out once, in order; a cut-off one is skipped and reading goes on behind it.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DECODER = json.JSONDecoder()


def document_kind(value: object) -> str | None:
    """'details' for a document with an integer questId, 'object' for one with kind object and an id."""
    if not isinstance(value, dict):
        return None
    for kind, key in (("details", "questId"), ("object", "id")):
        number = value.get(key)
        if isinstance(number, (int, float)) and not isinstance(number, bool) and number == int(number):
            if kind == "details" or value.get("kind") == "object":
                return kind
    return None


def complete_documents(text: str | None) -> list[tuple[str, int, str]]:
    """(kind, record id, document text) of each complete document of a file text, in order."""
    found: list[tuple[str, int, str]] = []
    at = text.find("{") if text else -1
    while at >= 0:
        try:
            value, end = _DECODER.raw_decode(text, at)
        except (ValueError, RecursionError):
            end = at + 1
        else:
            kind = document_kind(value)
            if kind:
                found.append((kind, int(value["questId" if kind == "details" else "id"]), text[at:end]))
        at = text.find("{", end)
    return found


_DOCUMENTS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("record_id", T.LongType()), T.StructField("body", T.StringType())]))


@F.pandas_udf(_DOCUMENTS)
def _documents(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: [{"kind": k, "record_id": i, "body": b} for k, i, b in complete_documents(x)])


def documents_of(text: Column) -> Column:
    """array<struct<kind, record_id, body>>; empty for null, blank and broken texts."""
    return _documents(text)


def raw_documents(files: DataFrame, *keep: str) -> DataFrame:
    """One row per complete document: the columns to keep, doc_no from 0 within the file, kind, record_id, body."""
    docs = files.select(*keep, documents_of(F.col("file_text")).alias("_docs"))
    return docs.select(*keep, F.posexplode("_docs").alias("doc_no", "_doc")).select(*keep, "doc_no", "_doc.kind", "_doc.record_id", "_doc.body")
