"""Arithmetic on frequency tables ``(item, cnt)``, layered lookup and hierarchy walks."""

from __future__ import annotations

from itertools import count

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def frequency(df: DataFrame, item: Column | str, name: str = "item") -> DataFrame:
    """Count of each item (G-A5)."""
    column = F.col(item) if isinstance(item, str) else item
    return df.groupBy(column.alias(name)).agg(F.count(F.lit(1)).alias("cnt"))


def _combine(a: DataFrame, b: DataFrame, how: str, merge) -> DataFrame:
    left = a.select("item", F.col("cnt").alias("__a"))
    right = b.select("item", F.col("cnt").alias("__b"))
    zero = F.lit(0).cast("bigint")
    return (left.join(right, "item", how)
            .select("item", merge(F.coalesce("__a", zero), F.coalesce("__b", zero)).alias("cnt")))


def add_counts(a: DataFrame, b: DataFrame, keep_all: bool = False) -> DataFrame:
    """Sum of two tables; only positive counts remain unless ``keep_all`` (Q-4)."""
    total = a.unionByName(b).groupBy("item").agg(F.sum("cnt").alias("cnt"))
    return total if keep_all else total.filter(F.col("cnt") > 0)


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Positive differences only (Q-5)."""
    return _combine(a, b, "full", lambda x, y: x - y).filter(F.col("cnt") > 0)


def subtract_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Differences with zero and negative counts kept (Q-6)."""
    return _combine(a, b, "full", lambda x, y: x - y)


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """Smaller of both counts (Q-7)."""
    return _combine(a, b, "inner", F.least).filter(F.col("cnt") > 0)


def union_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Larger of both counts (Q-8)."""
    return _combine(a, b, "full", F.greatest).filter(F.col("cnt") > 0)


def expand_counts(a: DataFrame, slice_rows: int = 10_000) -> DataFrame:
    """Each item as often as it is counted (Q-9).

    A large count is first cut into slices that are spread over the tasks, so
    no task writes out a hot item alone.
    """
    slices = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("cnt") - 1) / slice_rows))
    cut = (a.filter(F.col("cnt") > 0).withColumn("__slice", F.explode(slices))
           .withColumn("__n", F.least(F.col("cnt") - F.col("__slice") * slice_rows, F.lit(slice_rows)).cast("int")))
    return (cut.repartition("item", "__slice")
            .select("item", F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("__i")).drop("__i"))


def first_layer(layers: Sequence[DataFrame]) -> DataFrame:
    """Value of the first layer that holds the key, even if it is NULL there (Q-10)."""
    stacked = None
    for i, layer in enumerate(layers):
        rows = layer.select("key", F.struct(F.lit(i).alias("layer"), F.col("value")).alias("__at"))
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return stacked.groupBy("key").agg(F.min("__at").alias("__at")).select("key", "__at.layer", "__at.value")


def descendants(tree: DataFrame, node: str, parent: str, root) -> DataFrame:
    """All rows below one root with their depth (Q-2).

    One join per level; each level is written to the shared folder, and a node
    already met is not walked again, so cycles end too.
    """
    edges = tree.select(F.col(node).alias("node"), F.col(parent).alias("parent"))
    level = cut_lineage(edges.filter(F.col("node") == root).select("node", F.lit(0).alias("depth")))
    found = level
    for depth in count(1):
        step = (edges.join(level.select(F.col("node").alias("parent")), "parent", "left_semi")
                .select("node", F.lit(depth).alias("depth")).dropDuplicates(["node"]))
        level = cut_lineage(step.join(found, "node", "left_anti"))
        if not level.take(1):
            return found
        found = found.unionByName(level)
        if depth % 8 == 0:
            found = cut_lineage(found)
