"""Joins of points with the intervals that enclose them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enclosing(children: DataFrame, parents: DataFrame, group: list[str], width: int) -> DataFrame:
    """Every pair of a child and a parent interval that encloses it: group, child_id, parent_id, span, ordinal.

    children: group, child_id, start, end; parents: group, parent_id, start, end, ordinal. A parent encloses
    a child if it starts before and ends after the child's start. Parents are laid out over bins of the given
    width and meet children in the bin of their start, so a group with very many intervals is spread over
    its bins; width should be about the usual length of an interval. Rows with null bounds pair with nothing.
    """
    bin_of = lambda c: F.floor(F.col(c) / width)
    # end is exclusive, so that the last bin is that of end - 1
    laid = parents.filter("end > start").select(*group, "parent_id", F.col("start").alias("_from"), F.col("end").alias("_to"), "ordinal", F.explode(F.sequence(bin_of("start"), F.floor((F.col("end") - 1) / width))).alias("_bin"))
    points = children.select(*group, "child_id", F.col("start").alias("_at"), bin_of("start").alias("_bin"))
    inside = points.join(laid, [*group, "_bin"]).filter("_from < _at AND _to > _at")
    return inside.select(*group, "child_id", "parent_id", (F.col("_to") - F.col("_from")).alias("span"), "ordinal")


def innermost(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, parent_id of the shortest enclosing interval; of equal ones the first in order."""
    return pairs.groupBy(*keys).agg(F.min_by("parent_id", F.struct("span", "ordinal")).alias("parent_id"))


def last_enclosing(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, parent_id of the enclosing interval that comes last in order."""
    return pairs.groupBy(*keys).agg(F.max_by("parent_id", "ordinal").alias("parent_id"))


def span_end(start: Column, length: Column) -> Column:
    return start + F.greatest(length, F.lit(0))
