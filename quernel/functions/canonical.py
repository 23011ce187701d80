"""Canonical JSON text: equal values get equal text.

Numbers compare by value, objects by members, lists in order, texts exactly. Spark's variant
parser does all of it in the JVM (sorted members, 20.0 -> 20, escapes resolved) but for numbers
with exponents and those of more than 38 digits, which it reads as doubles. Only texts that hold
such a number go through Python first, where numbers are exact whatever their size.
"""

from __future__ import annotations

import json
import re
from decimal import Context, Decimal, InvalidOperation

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: An exponent, or more digits than a decimal of Spark holds.
_BEYOND = r"[0-9][eE][+-]?[0-9]|[0-9.]{39}"
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?')
_DIGITS = 38
#: Stands before a text that is canonical already.
_DONE = "\x00"
_EXACT = Context(prec=10**9, Emax=10**17, Emin=-(10**17))


def _decimal(token: str) -> Decimal | None:
    try:
        return _EXACT.create_decimal(token)
    except InvalidOperation:
        return None


def _fits(value: Decimal) -> bool:
    """Whether Spark's decimals hold the number in plain digits."""
    _, digits, exponent = value.as_tuple()
    return max(len(digits) + max(exponent, 0), -min(exponent, 0)) <= _DIGITS


def plain_number(token: str) -> str:
    """A number without its exponent: 3e2 -> 300, 1.5E-2 -> 0.015; beyond 38 digits as one digit, the others and an exponent."""
    value = _decimal(token)
    if value is None:
        return token
    if not value:
        return "0"
    sign, digits, exponent = value.as_tuple()
    shown = "".join(map(str, digits)).rstrip("0")
    exponent += len(digits) - len(shown)
    value = Decimal((sign, tuple(map(int, shown)), exponent))
    if _fits(value):
        return format(value, "f")
    rest = f".{shown[1:]}" if len(shown) > 1 else ""
    return f"{'-' if sign else ''}{shown[0]}{rest}E{exponent + len(shown) - 1}"


def plain_numbers(text: str | None) -> str | None:
    """Rewrite the numbers of one JSON text; strings are left alone, and so is a text that is no JSON.

    If one of them does not fit Spark's decimals, the whole text comes out canonical behind a mark.
    """
    if text is None:
        return None
    wide = False

    def number(token: str) -> _Number:
        nonlocal wide
        value = _decimal(plain := plain_number(token))
        wide = wide or not _fits(value)
        return _Number(plain)

    try:
        value = json.loads(text, parse_int=number, parse_float=number, parse_constant=_refuse)
    except (ValueError, RecursionError):
        return text
    return _DONE + _written(value) if wide else _TOKEN.sub(lambda m: m[0] if m[0][0] == '"' else plain_number(m[0]), text)


def _refuse(word: str) -> None:
    raise ValueError(word)


class _Number(str):
    """Digits of a number, told apart from a text."""


def _written(value: object) -> str:
    if isinstance(value, _Number):
        return str(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_written(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_written, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


@F.pandas_udf(T.StringType())
def _plain_numbers(texts: pd.Series) -> pd.Series:
    return texts.map(plain_numbers, na_action="ignore")


@F.pandas_udf(T.StringType())
def _plain_numbers_of_map(texts: pd.Series) -> pd.Series:
    def one(text: str) -> str:
        return json.dumps({k: plain_numbers(v) for k, v in json.loads(text).items()})

    return texts.map(one, na_action="ignore")


def _map_with_plain_numbers(values: Column) -> Column:
    """map<string, JSON text> with plain numbers; only maps that need it cross into Python."""
    has = F.exists(F.map_values(values), lambda v: F.coalesce(v.rlike(_BEYOND), F.lit(False)))
    plain = F.from_json(_plain_numbers_of_map(F.when(has, F.to_json(values, {"ignoreNullFields": "false"}))), "map<string,string>")
    return F.when(has, plain).otherwise(values)


def _canonical_text(text: Column) -> Column:
    """Canonical form of a text with plain numbers; a text that is no JSON stands for itself."""
    done = text.startswith(_DONE)
    return F.when(done, F.substring(text, 2, 2147483647)).otherwise(F.coalesce(F.to_json(F.try_parse_json(F.when(~done, text))), text))


def canonical_json(text: Column) -> Column:
    has = text.rlike(_BEYOND)
    return _canonical_text(F.when(has, _plain_numbers(F.when(has, text))).otherwise(text))


def canonical_map(values: Column) -> Column:
    """map<string, JSON text> with canonical values; SQL null becomes JSON null."""
    return F.transform_values(_map_with_plain_numbers(values), lambda _, v: F.coalesce(_canonical_text(v), F.lit("null")))


def map_text(values: Column) -> Column:
    """One text for a map, the same for equal maps in any order; null and empty are the same."""
    return F.coalesce(F.to_json(F.array_sort(F.map_entries(values))), F.lit("[]"))
