"""Paths over edge tables ``(src, dst, ordinal)``.

``ordinal`` gives the place of an edge in the adjacency list of ``src``.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import list_parts
from tessera.session import cut_lineage


def undirected(edges: DataFrame) -> DataFrame:
    """Both directions of each edge, in arrival order per node (G-1)."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "ordinal", F.lit(1).alias("turn"))
    both = edges.select("src", "dst", "ordinal", F.lit(0).alias("turn")).unionByName(back)
    return both.withColumn("ordinal", F.col("ordinal") * 2 + F.col("turn")).drop("turn")


def adjacency(edges: DataFrame, part_rows: int = 10_000, hot_rows: int | None = None) -> DataFrame:
    """Neighbour lists of an undirected graph, in parts of bounded length (G-1)."""
    return list_parts(undirected(edges), ["src"], "dst", ["ordinal", "dst"], part_rows, "neighbours", hot_rows)


def _as_rows(spark, path: Sequence | None, kind: str) -> DataFrame:
    return spark.createDataFrame(list(enumerate(path or [])), f"pos bigint, node {kind}")


def hops_to(edges: DataFrame, end, start=None) -> tuple[DataFrame, int | None]:
    """``(node, hops)`` of every node that reaches ``end``, and the hops of ``start``; the walk ends where it is met.

    One join per hop, against the edge. Tables of hops already walked are merged eight at a time, then eight of
    those, so each row is written again only as often as the logarithm of the hops.
    """
    kind = edges.schema["src"].dataType.simpleString()
    front = edges.sparkSession.createDataFrame([(end, 0)], f"node {kind}, hops bigint")
    seen, met = [(0, front)], None
    for hop in count(1):
        walked = seen[0][1]
        for _, table in seen[1:]:
            walked = walked.unionByName(table)
        steps = front.join(edges, F.col("node") == F.col("dst")).select(F.col("src").alias("node")).distinct()
        front = cut_lineage(steps.join(walked, "node", "left_anti").withColumn("hops", F.lit(hop).cast("bigint")))
        size, found = front.agg(F.count(F.lit(1)), F.count_if(F.col("node") == F.lit(start))).head()
        if not size:
            return walked, met
        seen.append((0, front))
        while len(seen) >= 8 and len({level for level, _ in seen[-8:]}) == 1:
            level, merged = seen[-1]
            for _, table in seen[-8:-1]:
                merged = merged.unionByName(table)
            seen[-8:] = [(level + 1, cut_lineage(merged))]
        if found:
            return walked.unionByName(front), hop


def follow(pointers: DataFrame, start, steps: int) -> DataFrame:
    """``(pos, node)`` of the first ``steps`` steps from ``start`` along ``(node, next)``, one pointer a node.

    Pointers are doubled, so a way of n steps takes 2 log2(n) joins of rows of two columns. It ends where a node has
    no pointer.
    """
    kind = pointers.schema["node"].dataType.simpleString()
    jumps = [cut_lineage(pointers.select("node", "next"))]
    while 2 ** len(jumps) <= steps:
        once = jumps[-1]
        twice = once.join(once.select(F.col("node").alias("next"), F.col("next").alias("far")), "next")
        jumps.append(cut_lineage(twice.select("node", F.col("far").alias("next"))))
    way = pointers.sparkSession.createDataFrame([(0, start)], f"pos bigint, node {kind}")
    for power in range(len(jumps) - 1, -1, -1):
        ahead = way.join(jumps[power], "node").select((F.col("pos") + 2 ** power).alias("pos"), F.col("next").alias("node"))
        way = cut_lineage(way.unionByName(ahead.filter(F.col("pos") <= steps)))
    return way


def shortest_path(edges: DataFrame, start, end) -> DataFrame:
    """Path with the fewest hops, the first found by adjacency order (G-2).

    Hops to the end are walked backwards, one number a node. Among paths of one length a queue meets them in the
    order of their edge ordinals, so each node passes on to its neighbour of least ordinal that is one hop nearer
    (equal ordinals by node), and the path follows these pointers. No row holds a path. The
    result is ``(pos, node)``; no path gives no rows.
    """
    spark, kind = edges.sparkSession, edges.schema["src"].dataType.simpleString()
    if start == end:
        return _as_rows(spark, [start], kind)
    edges = cut_lineage(edges.select("src", "dst", "ordinal"))
    near, hops = hops_to(edges, end, start)
    if hops is None:
        return _as_rows(spark, None, kind)
    near = cut_lineage(near)
    here, there = near.toDF("src", "hops"), near.select(F.col("node").alias("dst"), (F.col("hops") + 1).alias("hops"))
    ways = edges.join(here, "src").join(there, ["dst", "hops"])
    pointers = ways.groupBy(F.col("src").alias("node")).agg(F.min(F.struct("ordinal", "dst"))["dst"].alias("next"))
    return follow(pointers, start, hops)


def here_frame(edges: DataFrame, node) -> DataFrame:
    """One node as a table of the node type."""
    return edges.sparkSession.createDataFrame([(node,)], f"node {edges.schema['src'].dataType.simpleString()}")


def _first_way_on(edges: DataFrame, path: list, end):
    """Neighbour of the last node that depth-first search would leave through."""
    here = path[-1]
    choices = [row[0] for row in edges.filter((F.col("src") == here) & ~F.col("dst").isin(path))
               .groupBy("dst").agg(F.min("ordinal").alias("o")).orderBy("o").select("dst").limit(1).collect()]
    if not choices:
        return None
    if choices[0] == end:
        return end
    inner = edges.filter(~F.col("src").isin(path) & ~F.col("dst").isin(path))
    options = edges.filter((F.col("src") == here) & ~F.col("dst").isin(path))
    reach = front = here_frame(edges, end)
    for hop in count(1):
        step = (inner.join(front.select(F.col("node").alias("dst")), "dst", "left_semi")
                .select(F.col("src").alias("node")).distinct())
        front = cut_lineage(step.join(reach, "node", "left_anti"))
        found = front.agg(F.count(F.lit(1)), F.count_if(F.col("node") == choices[0])).head()
        if found[1]:
            return choices[0]
        if not found[0]:
            break
        reach = reach.unionByName(front)
        if hop % 8 == 0:
            reach = cut_lineage(reach)
    best = (options.join(reach, F.col("dst") == F.col("node"), "left_semi")
            .orderBy("ordinal").select("dst").head())
    return None if best is None else best[0]


def first_path(edges: DataFrame, start, end) -> DataFrame:
    """First simple path of a depth-first search in adjacency order (G-3).

    The search itself may visit exponentially many dead ends. Its outcome is
    found without them: from each node it leaves through the first neighbour
    from which the end is still reachable without the nodes already on the
    path, and that is one reachability walk.
    """
    spark, kind = edges.sparkSession, edges.schema["src"].dataType.simpleString()
    edges = cut_lineage(edges.select("src", "dst", "ordinal"))
    path = [start]
    while path[-1] != end:
        step = _first_way_on(edges, path, end)
        if step is None:
            return _as_rows(spark, None, kind)
        path.append(step)
    return _as_rows(spark, path, kind)


def linked_groups(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, group`` of every node of the links: the least node it is joined to, over links of either direction.

    Each round takes the least group among a node's neighbours and then the group of that group, so the number
    of rounds grows as the logarithm of the longest way in all but odd cases.
    """
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).unionByName(
        links.select(F.col(b).alias("node"), F.col(a).alias("other"))).distinct()
    both = cut_lineage(both)
    groups = cut_lineage(both.groupBy("node").agg(F.min("other").alias("least")).select(
        "node", F.least("node", "least").alias("group")))
    while True:
        seen = both.join(groups.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("group").alias("near"))
        lower = cut_lineage(groups.join(seen, "node").select("node", "group", F.least("group", "near").alias("low")))
        above = lower.select(F.col("node").alias("low"), F.col("low").alias("top"))
        jumped = cut_lineage(lower.join(above, "low").select("node", "group", F.least("low", "top").alias("next")))
        if not jumped.filter(F.col("next") < F.col("group")).take(1):
            return groups
        groups = jumped.select("node", F.col("next").alias("group"))
