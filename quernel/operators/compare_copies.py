"""Differences between two copies of a dataset, row by row and member by member."""

from __future__ import annotations

import json
from collections.abc import Callable
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _diff(left: dict, right: dict, path: str, found: list[str], equal: Callable[[object, object, dict, dict, str], bool]) -> None:
    for name in sorted(left.keys() | right.keys()):
        here = f"{path}.{name}" if path else name
        if name not in left or name not in right:
            found.append(here)
        elif isinstance(left[name], dict) and isinstance(right[name], dict):
            _diff(left[name], right[name], here, found, equal)
        elif not equal(left[name], right[name], left, right, name):
            found.append(here)


def _same(a: object, b: object, *_: object) -> bool:
    """Equal values of one kind: True is not 1, and numbers come as tuples of digits."""
    return type(a) is type(b) and a == b


#: Members that say which map a point is on; points compare by distance only on the same one.
FRAMES = ("zone", "zoneId", "map", "mapId", "uiMapId")


def near_points(tolerance: float) -> Callable:
    """An equal for difference_paths: x and y of two points on the same map may differ by so much on either axis."""

    def equal(a: object, b: object, left: dict, right: dict, name: str) -> bool:
        framed = any(f in left and f in right and _same(left[f], right[f]) for f in FRAMES)
        if name in ("x", "y") and framed and isinstance(a, tuple) and isinstance(b, tuple):
            return abs(Decimal(a[0]) - Decimal(b[0])) <= Decimal(str(tolerance))
        return _same(a, b)

    return equal


def _number(digits: str) -> tuple[str]:
    """A number by its canonical digits, so that none is too large or rounded; no string equals it."""
    return (digits,)


def _load(text: str | None) -> object:
    return None if text is None else json.loads(text, parse_float=_number, parse_int=_number)


def difference_paths(left: object, right: object, equal: Callable = _same) -> list[str]:
    """Paths at which two parsed values differ; '' if they differ and are not both objects."""
    if not isinstance(left, dict) or not isinstance(right, dict):
        return [] if _same(left, right) else [""]
    found: list[str] = []
    _diff(left, right, "", found, equal)
    return found


def record_differences(left: str, right: str, equal: Callable = _same) -> list[str]:
    """Paths of two records {"a": attributes, "s": states}: plain for attributes, $fieldStates.<field> for states."""
    return _record_paths(_load(left), _load(right), equal)


def _record_paths(a: dict, b: dict, equal: Callable = _same) -> list[str]:
    return difference_paths(a["a"], b["a"], equal) + [f"$fieldStates.{p}" for p in difference_paths(a["s"], b["s"])]


def _equal(tolerance: float | None) -> Callable:
    return _same if tolerance is None else near_points(tolerance)


def _record_differences(left: Column, right: Column, tolerance: float | None) -> Column:
    equal = _equal(tolerance)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def paths(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([record_differences(a, b, equal) for a, b in zip(left, right, strict=True)])

    return paths(left, right)


def transport(cost: np.ndarray, supply: list[int], demand: list[int]) -> list[tuple[int, int, int]]:
    """(row, column, how many) of least total cost that use up the shorter side: shortest augmenting paths with potentials.

    Equal rows are one row with a supply, so the work grows with the different ones only.
    """
    if not len(supply) or not len(demand):
        return []
    if sum(supply) > sum(demand):
        return sorted((r, c, n) for c, r, n in transport(cost.T, demand, supply))
    cost = np.ascontiguousarray(cost, dtype=np.int64)
    never = np.iinfo(np.int64).max // 4
    u, v, free = np.zeros(len(supply), dtype=np.int64), np.zeros(len(demand), dtype=np.int64), np.array(demand, dtype=np.int64)
    flow: list[dict[int, int]] = [{} for _ in demand]  # of each column, how many of which row
    for source, wanted in enumerate(supply):
        while wanted:
            reached, via = {source: 0}, {source: -1}
            far, back, open_ = np.full(len(demand), never), np.zeros(len(demand), dtype=np.int64), np.ones(len(demand), dtype=bool)
            new, here = [source], 0
            while True:
                for row in new:
                    through = here + cost[row] - u[row] - v
                    less = open_ & (through < far)
                    far[less], back[less] = through[less], row
                at = int(np.where(open_, far, never).argmin())
                here = int(far[at])
                open_[at] = False
                if free[at]:
                    break
                new = [row for row in flow[at] if row not in reached]
                for row in new:
                    reached[row], via[row] = here, at
            for row, distance in reached.items():
                u[row] += here - distance
            v[~open_] -= here - far[~open_]
            path, column = [], at
            while column >= 0:
                row = int(back[column])
                path.append((row, column))
                column = via[row]
            # a row on the way gives up its place in the column before
            much = min(wanted, int(free[at]), *(flow[via[row]][row] for row, _ in path if via[row] >= 0))
            for row, column in path:
                flow[column][row] = flow[column].get(row, 0) + much
                if via[row] >= 0:
                    flow[via[row]][row] -= much
                    if not flow[via[row]][row]:
                        del flow[via[row]][row]
            free[at] -= much
            wanted -= much
    return sorted((row, column, n) for column, of in enumerate(flow) for row, n in of.items())


def least_cost(cost: list[list[int]]) -> list[tuple[int, int]]:
    """Pairs (row, column) of least total cost that use up the shorter side."""
    if not cost or not cost[0]:
        return []
    return [(r, c) for r, c, _ in transport(np.array(cost), [1] * len(cost), [1] * len(cost[0]))]


_PAIRS = T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType()), T.StructField("n", T.LongType())]))


def _assign(lefts: Column, rights: Column, tolerance: float | None) -> Column:
    equal = _equal(tolerance)

    def one(lefts: list[dict], rights: list[dict]) -> list[dict]:
        (a, over), (b, under) = (([r["record"] for r in x], [int(r["n"]) for r in x]) for x in (sorted(side, key=lambda r: r["record"]) for side in (lefts, rights)))
        parsed = [_load(x) for x in a], [_load(y) for y in b]
        pairs = transport(np.array([[len(_record_paths(x, y, equal)) for y in parsed[1]] for x in parsed[0]]), over, under)
        for i, j, n in pairs:
            over[i] -= n
            under[j] -= n
        out = [{"left": a[i], "right": b[j], "n": n} for i, j, n in pairs]
        return out + [{"left": x, "right": None, "n": n} for x, n in zip(a, over, strict=True) if n] + [{"left": None, "right": y, "n": n} for y, n in zip(b, under, strict=True) if n]

    @F.pandas_udf(_PAIRS)
    def pairs_of(lefts: pd.Series, rights: pd.Series) -> pd.Series:
        return pd.Series([one(list(a), list(b)) for a, b in zip(lefts, rights, strict=True)])

    return pairs_of(lefts, rights)


def latest_rows(df: DataFrame, keys: list[str], at: str, tie: Column) -> DataFrame:
    """The row with the latest time of each key; null times are oldest, ties go to the largest tie.

    A row number of at most 1 is cut down in each task before the shuffle, so hot keys do no harm.
    """
    order = Window.partitionBy(*keys).orderBy(F.col(at).desc_nulls_last(), tie.desc())
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def compare_copies(left: DataFrame, right: DataFrame, keys: list[str], tolerance: float | None = None) -> DataFrame:
    """Rows of two copies that do not match: keys, status (leftOnly, rightOnly, changed), left_record, right_record.

    Both sides have the keys (non-null) and record, a canonical JSON text {"a": attributes, "s": states}.
    Identical rows of a key cancel out by their number on either side. What is left over is paired within
    the key: one against one directly, more by the assignment with the fewest differing fields, however many
    there are. Surplus rows are leftOnly or rightOnly. Identical rows combine before the first shuffle and are
    paired by their number, so a task holds the different leftovers of a key and a cost for each two of them.
    With a tolerance, points on the same map that lie within it on either axis do not differ (see near_points).
    """
    sides = left.select(*keys, "record", F.lit(1).alias("_n")).unionByName(right.select(*keys, "record", F.lit(-1).alias("_n")))
    surplus = sides.groupBy(*keys, "record").agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    side = lambda sign: F.collect_list(F.when(sign * F.col("_n") > 0, F.struct("record", F.abs("_n").alias("n"))))
    grouped = surplus.groupBy(*keys).agg(side(1).alias("_l"), side(-1).alias("_r"))
    one, other = F.try_element_at("_l", F.lit(1)), F.try_element_at("_r", F.lit(1))
    few = (F.size("_l") <= 1) & (F.size("_r") <= 1) & (F.coalesce(one["n"], other["n"]) == F.coalesce(other["n"], one["n"]))
    direct = F.array(F.struct(one["record"].alias("left"), other["record"].alias("right"), F.coalesce(one["n"], other["n"]).alias("n")))
    many = [F.when(few, F.array().cast("array<struct<record: string, n: bigint>>")).otherwise(F.col(c)) for c in ("_l", "_r")]
    pairs = grouped.select(*keys, F.explode(F.when(few, direct).otherwise(_assign(*many, tolerance))).alias("_p"))
    pairs = pairs.select(*keys, "_p", F.explode(F.sequence(F.lit(1), F.col("_p.n"))).alias("_copy"))
    status = F.when(F.col("_p.right").isNull(), "leftOnly").when(F.col("_p.left").isNull(), "rightOnly").otherwise("changed")
    return pairs.select(*keys, status.alias("status"), F.col("_p.left").alias("left_record"), F.col("_p.right").alias("right_record"))


def explode_paths(changes: DataFrame, keys: list[str], tolerance: float | None = None) -> DataFrame:
    """keys, status, diff_path: one row per differing path; '' for rows on one side only.

    A pair whose points all lie within the tolerance and that differs in nothing else has no row.
    """
    both = F.col("status") == "changed"
    paths = F.when(both, _record_differences(F.when(both, F.col("left_record")).otherwise(F.lit('{"a":null,"s":{}}')), F.when(both, F.col("right_record")).otherwise(F.lit('{"a":null,"s":{}}')), tolerance)).otherwise(F.array(F.lit("")))
    return changes.select(*keys, "status", F.explode(paths).alias("diff_path"))
