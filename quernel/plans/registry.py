"""All queries of the core, by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quernel.plans import compaction, compare_copies, hierarchy, nested, operations, problem_sql, reconciliation, records, references, snapshots

Query = Callable[[SparkSession, str], DataFrame]

#: Modules with a list QUERIES and, where SQL can express them, a dict SQL.
MODULES = [reconciliation, operations, records]


def queries() -> dict[str, Query]:
    found = [
        nested.p1_found,
        references.p3_found,
        references.p3_report,
        references.p3_intervals,
        compare_copies.p4_found,
        compare_copies.p4_all_rows,
        compare_copies.p4_near,
        compaction.p5_found,
        compaction.p5_spawns,
        snapshots.p6_found,
        snapshots.p6_intervals,
        hierarchy.p7_found,
        hierarchy.p7_paths,
        hierarchy.p7_descendants,
    ]
    return {f.__name__: f for f in [*found, *(q for m in MODULES for q in m.QUERIES)]}


def oracle_sql() -> dict[str, str]:
    return problem_sql.SQL | {name: sql for m in MODULES for name, sql in m.SQL.items()}
