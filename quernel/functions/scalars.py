"""Scalar functions, all inside the JVM unless said otherwise."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def slugify(text: Column) -> Column:
    """Lower case, apostrophes dropped, everything but letters and digits of ASCII to single hyphens."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), "['’]", ""), "[^a-z0-9]+", "-"), F.lit("-"))


@F.pandas_udf(T.StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def nfc(text: Column) -> Column:
    """Composed form of Unicode; only texts beyond ASCII cross into Python."""
    wide = text.rlike(r"[^\x00-\x7F]")
    return F.when(wide, _nfc(F.when(wide, text))).otherwise(text)


def is_exact_integer(text: Column) -> Column:
    """Whether a JSON text is an integer of any size: 20 is, 20.0, 2e1, "20" and 007 are not."""
    return F.coalesce(text.rlike(r"^-?(0|[1-9][0-9]*)$"), F.lit(False))


def id_set(ids: Column, signed: bool = False) -> Column:
    """Distinct ids in the order of their text ("11" before "9"), or null if one is not positive (signed: is 0)."""
    good = F.forall(ids, lambda i: (i != 0) if signed else (i > 0))
    return F.when(good, F.array_sort(F.array_distinct(F.transform(ids, lambda i: i.cast("string")))))


def decode_bits(mask: Column, names: Sequence[tuple[int, object]]) -> Column:
    """Names of the bits that are set, in the given order; zero and null masks have none."""
    return F.array_compact(F.array(*[F.when(F.coalesce(mask, F.lit(0)).bitwiseAND(F.lit(bit)) != 0, F.lit(name)) for bit, name in names]))


def unknown_bits(mask: Column, names: Sequence[tuple[int, object]]) -> Column:
    """The bits of mask that have no name; 0 if there are none."""
    every = 0
    for bit, _ in names:
        every |= bit
    return F.coalesce(mask, F.lit(0)).bitwiseAND(F.lit(~every))


def first_match(rules: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """The name of the first rule that holds (null does not)."""
    out = None
    for condition, name in rules:
        out = F.when(condition, name) if out is None else out.when(condition, name)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def text_flags(text: Column, phrases: Mapping[str, str]) -> list[Column]:
    """A boolean per name: whether its phrase is in the text, whatever the case; false for null."""
    low = F.lower(text)
    return [F.coalesce(low.contains(phrase), F.lit(False)).alias(name) for name, phrase in phrases.items()]


def unescape_markup(text: Column) -> Column:
    r"""\r\n, \n, \t, \" and \/ of scripts as their characters."""
    for a, b in ((r"\r\n", "\n"), (r"\n", "\n"), (r"\t", "\t"), ('\\"', '"'), (r"\/", "/")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def markup_ids(text: Column, tag: str) -> Column:
    """Distinct ids of [tag=123] in numeric order; empty for null."""
    found = F.regexp_extract_all(text, F.lit(rf"\[{tag}=(\d{{1,18}})\]"), F.lit(1))
    return F.coalesce(F.array_sort(F.array_distinct(F.transform(found, lambda i: i.cast("bigint")))), F.array().cast("array<bigint>"))


def url_parts(url: Column) -> tuple[Column, Column]:
    """(path without query and fragment, number after the last slash or null)."""
    bare = F.regexp_replace(url, r"[?#].*$", "")
    return bare, F.regexp_extract(bare, r"(\d{1,18})$", 1).try_cast("bigint")


def pairs(values: Column) -> Column:
    """[a, b] lists as structs; all-zero pairs are dropped, a list with one of another length gives null."""
    good = F.forall(values, lambda v: F.size(v) == 2)
    kept = F.filter(values, lambda v: (v[0] != 0) | (v[1] != 0))
    return F.when(good, F.transform(kept, lambda v: F.struct(v[0].alias("a"), v[1].alias("b"))))


def lenient_int(text: Column) -> Column:
    """Whole numbers however written (20, 20.0, " 20 "); zero, fractions and other texts give null."""
    number = F.trim(text).try_cast("decimal(38,6)")
    return F.when((number == F.floor(number)) & (number != 0), number.try_cast("bigint"))
