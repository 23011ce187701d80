"""Parent-child links to full hierarchies: root, depth and exact path of every node, and the loops.

Every child has one parent, so links are pointers. A deterministic hash picks one internal node in
eight as a splitter. Every internal node walks to its next splitter (by doubling, never past one),
the pointers between splitters form a graph an eighth the size that is solved in the same way, and
each node adds its own stretch to the answer of its splitter. Nodes that never reach a root or a
splitter lead into a loop without splitters; splitters that never reach a root lie on or below a
loop that has some. Only nodes with children take part in the walks: the children of a very wide
node join its answer at the end, where the answer is one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernel.session import cut

SPLITTER_ONE_IN = 8


def parent_links(rows: DataFrame) -> DataFrame:
    """child, parent (structs of type and id): one row per child, rows without a parent or child left out.

    rows: parent_type, parent_id, child_type, child_id, observed_at. Of several parents the one observed
    last counts (null times are oldest; ties: the largest type and id). Repeats combine before the shuffle.
    """
    named = rows.dropna(subset=["parent_type", "parent_id", "child_type", "child_id"])
    node = lambda side: F.struct(F.col(f"{side}_type").alias("type"), F.col(f"{side}_id").alias("id"))
    return named.groupBy(node("child").alias("child")).agg(F.max(F.struct("observed_at", node("parent").alias("parent"))).alias("_m")).select("child", F.col("_m.parent").alias("parent"))


def _follow(links: DataFrame, paths: bool) -> DataFrame:
    """links (node, to, steps, way, done) with every pointer followed until it is done, or known to loop.

    Pointers double in each round, so the pointers still open after round r are more than 2^r steps from
    their end. A round that finishes none leaves only pointers that run in circles.
    way is the nodes passed, from node up to but without to; empty unless paths.
    """
    links = cut(links)
    left = links.filter("NOT done").count()
    while left:
        ahead = links.select(F.col("node").alias("_node"), F.col("to").alias("_to"), F.col("steps").alias("_steps"), F.col("way").alias("_way"), F.col("done").alias("_done"))
        both = links.join(ahead, ~F.col("done") & (F.col("to") == F.col("_node")), "left")
        on = F.col("_node").isNotNull()
        links = cut(
            both.select(
                "node",
                F.when(on, F.col("_to")).otherwise(F.col("to")).alias("to"),
                F.when(on, F.col("steps") + F.col("_steps")).otherwise(F.col("steps")).alias("steps"),
                (F.when(on, F.concat("way", "_way")).otherwise(F.col("way")) if paths else F.col("way")).alias("way"),
                F.when(on, F.col("_done")).otherwise(F.col("done")).alias("done"),
            )
        )
        before, left = left, links.filter("NOT done").count()
        if left == before:
            break
    return links


def solve_hierarchy(links: DataFrame, paths: bool = False, one_in: int = SPLITTER_ONE_IN) -> DataFrame:
    """node, root, depth, way, cyclic for each child in links; root and way are null and depth -1 where cyclic.

    way lists the nodes from the parent up to the root, empty unless paths is set. An empty input gives no rows.
    """
    links = cut(links)
    inner = links.select(F.col("parent").alias("node")).distinct()
    none = F.array().cast(links.select(F.array("child")).schema[0].dataType)
    way = F.array("node") if paths else none
    up = links.select(F.col("child").alias("node"), F.col("parent").alias("to")).join(inner, "node", "left_semi")
    roots = cut(inner.join(up, "node", "left_anti"))
    splitter = lambda c: F.pmod(F.xxhash64(F.col(f"{c}.type"), F.col(f"{c}.id")), F.lit(one_in)) == 0
    ends = roots.select(F.col("node").alias("_end"), F.lit(True).alias("_root"))
    up = up.join(ends, F.col("to") == F.col("_end"), "left").select("node", "to", F.lit(1).alias("steps"), way.alias("way"), F.col("_root").isNotNull().alias("_at_root"))
    walked = _follow(up.select("node", "to", "steps", "way", (F.col("_at_root") | splitter("to")).alias("done")), paths)
    # the graph between splitters; a pointer is done at a root
    tops = walked.filter(splitter("node") & F.col("done")).join(ends, F.col("to") == F.col("_end"), "left")
    solved = _follow(tops.select("node", "to", "steps", "way", F.col("_root").isNotNull().alias("done")), paths)
    answer = roots.select("node", F.col("node").alias("root"), F.lit(0).alias("depth"), none.alias("way")).unionByName(solved.filter("done").select("node", F.col("to").alias("root"), F.col("steps").alias("depth"), "way"))
    others = walked.filter(~splitter("node") & F.col("done")).select("node", "to", "steps", F.col("way").alias("_w"))
    joined = others.join(answer.select(F.col("node").alias("_end"), "root", "depth", "way"), F.col("to") == F.col("_end"))
    answer = answer.unionByName(joined.select("node", "root", (F.col("steps") + F.col("depth")).alias("depth"), (F.concat("_w", "way") if paths else F.col("way")).alias("way")))
    # for the children: the way from their parent on, with the root at its end
    ready = answer.select(F.col("node").alias("_parent"), "root", "depth", (F.concat("way", F.array("root")) if paths else F.col("way")).alias("way"))
    below = links.join(ready, F.col("parent") == F.col("_parent"), "left")
    return below.select(F.col("child").alias("node"), "root", F.coalesce(F.col("depth") + 1, F.lit(-1)).alias("depth"), "way", F.col("root").isNull().alias("cyclic"))
