"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.tables import broadcast_if_small
from tessera.session import cut_lineage


#: Bytes of a table of least neighbours that may be sent to every executor; the links then stay where they are.
LEAST_BYTES = 4 << 20


def components(links: DataFrame, most_links: int | None = None) -> DataFrame:
    """``node, root`` for every node of the links ``a, b`` (long): root is the least node it is linked to.

    Every round points each node's neighbours at the least of them, first the larger ones, then the smaller
    ones, until each node points at its root; the number of rounds grows as the logarithm of the longest
    path. Least neighbours are stored before they are joined, so a node with very many links is split
    between tasks by the join. With them is counted whether a node points at two others, or at one and is
    pointed at; when there is none, they are the result. Links to oneself and null ends are left out.
    There are never more links than at first, so their number (``most_links``, if known) sets the tasks that write.
    """
    edges = cut_lineage(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), most_links)
    count = edges.count()
    while True:
        both = edges.select("a", "b", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("b").alias("a"), F.col("a").alias("b"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        least = cut_lineage(both.groupBy("a").agg(
            F.min(F.least("a", "b")).alias("m"), (F.sum("up") + F.max("down") > 1).alias("open")), 2 * count)
        if not least.agg(F.max("open")).head()[0]:
            return least.select(F.col("a").alias("node"), F.col("m").alias("root"))
        near = broadcast_if_small(least.select("a", "m"), 16, LEAST_BYTES)
        # each link is seen from its smaller end only, so there are no more rows than links
        large = cut_lineage(edges.select(F.col("b").alias("a"), F.col("a").alias("b")).join(near, "a")
                            .select(F.col("b").alias("a"), F.col("m").alias("b")), count)
        lower = cut_lineage(large.groupBy("a").agg(F.min("b").alias("m")), count)
        small = large.join(broadcast_if_small(lower, 16, LEAST_BYTES), "a").filter("b <> m").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut_lineage(small.unionByName(lower.withColumnRenamed("m", "b")).distinct(), count)
