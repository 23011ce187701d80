"""Deeply nested records to related flat tables (shared inlining).

The schema becomes a graph: a node per element, an edge per nesting, marked repeated (array,
map) or singleton. An element gets a table of its own where it is the root, repeated, shared
(reached from several parents) or recursive; every other descendant is inlined into the
columns of the nearest table above it. Child tables carry the key of their parent, so that
children can be joined back.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class SchemaGraph:
    """Elements and their nesting. edges: parent -> [(member, child, repeated)]."""

    root: str
    edges: dict[str, list[tuple[str, str, bool]]] = field(default_factory=lambda: defaultdict(list))
    leaves: dict[str, list[tuple[str, T.DataType]]] = field(default_factory=lambda: defaultdict(list))

    def parents(self) -> dict[str, set[tuple[str, str]]]:
        found: dict[str, set[tuple[str, str]]] = defaultdict(set)
        for parent, members in self.edges.items():
            for member, child, _ in members:
                found[child].add((parent, member))
        return found

    def recursive(self) -> set[str]:
        """Elements that can contain themselves."""
        found = set()
        for start in list(self.edges):
            seen, todo = set(), [c for _, c, _ in self.edges[start]]
            while todo:
                node = todo.pop()
                if node == start:
                    found.add(start)
                if node not in seen:
                    seen.add(node)
                    todo += [c for _, c, _ in self.edges.get(node, [])]
        return found

    def tables(self) -> dict[str, str]:
        """Element -> why it gets a table: root, repeated, shared or recursive."""
        parents, loops = self.parents(), self.recursive()
        found = {self.root: "root"}
        for node, above in parents.items():
            if node in loops:
                found.setdefault(node, "recursive")
            elif any(r for p, _ in above for m, c, r in self.edges[p] if c == node and (p, m) in above):
                found.setdefault(node, "repeated")
            elif len(above) > 1:
                found.setdefault(node, "shared")
        return found


def schema_graph(schema: T.StructType, root: str, shared: dict[str, str] | None = None) -> SchemaGraph:
    """Graph of a Spark schema. Nodes are named by their path; shared maps paths to one common name."""
    graph, names = SchemaGraph(root), shared or {}

    def visit(node: str, path: str, struct: T.StructType) -> None:
        if node in graph.leaves:  # a shared element is described once
            return
        graph.leaves[node] = []
        for f in struct.fields:
            kind, repeated = f.dataType, False
            while isinstance(kind, (T.ArrayType, T.MapType)):
                kind, repeated = kind.elementType if isinstance(kind, T.ArrayType) else kind.valueType, True
            below = f"{path}.{f.name}" if path else f.name
            if isinstance(kind, T.StructType) or repeated:
                child = names.get(below, below)
                graph.edges[node].append((f.name, child, repeated))
                if isinstance(kind, T.StructType):
                    visit(child, below, kind)
            else:
                graph.leaves[node].append((f.name, kind))

    visit(root, "", schema)
    return graph


def _unnest(df: DataFrame, value: Column, kind: T.DataType, keep: list[str]) -> DataFrame:
    """Rows of a repeated member: the columns to keep, child_no from 0, child_key (map key), _v. Null members have no rows."""
    if isinstance(kind, T.MapType):
        entries = F.array_sort(F.map_entries(value), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
        rows = df.select(*keep, F.posexplode(entries).alias("child_no", "_e"))
        return rows.select(*keep, "child_no", F.col("_e.key").cast("string").alias("child_key"), F.col("_e.value").alias("_v"))
    rows = df.select(*keep, F.posexplode(value).alias("child_no", "_v"))
    return rows.select(*keep, "child_no", F.lit(None).cast("string").alias("child_key"), "_v")


def shared_inlining(df: DataFrame, key: str, root: str, shared: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Flat tables of nested records, by element.

    The root table has the key and every inlined singleton descendant, named by its path with
    underscores. A child table has parent_key (the key of the root record), parent_path (one
    string that names the parent row: member names, positions and map keys from the root),
    child_no (position from 0; for maps in key order), child_key (the map key, null for arrays)
    and the inlined columns of its own. Arrays of plain values have a column value.

    Null and empty arrays and maps give no child rows; null elements give a row of nulls, so
    positions stay; records without a key are kept with parent_key null. Columns of df that
    clash with generated names are renamed by their path. Needs no shuffle: every table is a
    projection of df, so unused ones cost nothing.
    """
    graph = schema_graph(T.StructType([f for f in df.schema.fields if f.name != key]), root, shared)
    kinds = graph.tables()
    tables: dict[str, list[DataFrame]] = defaultdict(list)
    meta = ["parent_key", "parent_path", "child_no", "child_key"]

    def emit(rows: DataFrame, keep: list[str], node: str, struct: T.StructType | None, value: str | None, path: str) -> None:
        """rows hold keep and, unless value is None, the struct in column value."""
        columns: list[Column] = [F.col(f"`{k}`") for k in keep]
        nested: list[tuple[Column, T.DataType, str, str]] = []

        def inline(kind: T.StructType, at: Column | None, where: str, prefix: str) -> None:
            for f in kind.fields:
                if at is None and f.name == key:
                    continue
                here = F.col(f"`{f.name}`") if at is None else at[f.name]
                below = f"{where}.{f.name}" if where else f.name
                name = names.get(below, below)
                inner = f.dataType
                repeated = isinstance(inner, (T.ArrayType, T.MapType))
                if not repeated and not isinstance(inner, T.StructType):
                    label = f"{prefix}{f.name}"
                    taken = {c.lower() for c in used}
                    while label.lower() in taken:
                        label += "_"
                    used.append(label)
                    columns.append(here.alias(label))
                elif not repeated and name not in kinds:
                    inline(inner, here, below, f"{prefix}{f.name}_")
                else:
                    # the way from this table's element, also through inlined ones
                    nested.append((here, inner, below, below[len(path) + 1 if path else 0 :].replace(".", "/")))

        names, used = shared or {}, list(keep)
        if struct is not None:
            inline(struct, F.col(value) if value else None, path, "")
        elif value:
            columns.append(F.col(value).alias("value"))
        tables[node].append(rows.select(*columns))
        for at, inner, below, member in nested:
            child = names.get(below, below)
            above = F.col("parent_path") if "parent_path" in keep else F.lit("")
            step = F.concat(above, F.lit("/" + member)) if "parent_path" not in keep else F.concat(above, F.lit("/"), F.coalesce(F.col("child_key"), F.col("child_no").cast("string")), F.lit("/" + member))
            owner = F.col("parent_key") if "parent_key" in keep else F.col(f"`{key}`")
            base = rows.select(owner.alias("_k"), step.alias("_p"), at.alias("_m"))
            if isinstance(inner, T.StructType):
                down = base.filter(F.col("_m").isNotNull()).select("_k", "_p", F.lit(0).alias("child_no"), F.lit(None).cast("string").alias("child_key"), F.col("_m").alias("_v"))
            else:
                down = _unnest(base, F.col("_m"), inner, ["_k", "_p"])
            down = down.select(F.col("_k").alias("parent_key"), F.col("_p").alias("parent_path"), "child_no", "child_key", "_v")
            value_kind = inner if isinstance(inner, T.StructType) else inner.elementType if isinstance(inner, T.ArrayType) else inner.valueType
            emit(down, meta, child, value_kind if isinstance(value_kind, T.StructType) else None, "_v", below)

    emit(df, [key], root, df.schema, None, "")
    out = {}
    for node, parts in tables.items():
        table = parts[0]
        for part in parts[1:]:
            table = table.unionByName(part, allowMissingColumns=True)
        out[node] = table
    return out
