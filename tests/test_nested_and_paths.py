"""Paths by pointers and nested maps in parts, against plain Python."""

import random
from collections import deque

from pyspark.sql import functions as F

from tessera.operators import aggregates as ag
from tessera.operators import graph

EDGE = "src long, dst long, ordinal long"


def queue_path(edges, start, end):
    """The path a queue finds first."""
    near, parent, line = {}, {start: None}, deque([start])
    for a, b, _ in sorted(edges, key=lambda e: e[2]):
        near.setdefault(a, []).append(b)
    while line:
        here = line.popleft()
        if here == end:
            out = []
            while here is not None:
                out.append(here)
                here = parent[here]
            return out[::-1]
        for b in near.get(here, []):
            if b not in parent:
                parent[b] = here
                line.append(b)
    return []


def nodes(df):
    return [r.node for r in df.orderBy("pos").collect()]


def test_path_is_what_a_queue_finds_first(spark):
    rng = random.Random(5)
    for trial in range(3):
        edges = list({(rng.randrange(30), rng.randrange(30)) for _ in range(60)})
        rng.shuffle(edges)
        edges = [(a, b, i) for i, (a, b) in enumerate(edges)]
        table = spark.createDataFrame(edges, EDGE)
        for end in (7, 19):
            assert nodes(graph.shortest_path(table, 0, end)) == queue_path(edges, 0, end)


def test_path_longer_than_a_merge_of_hops(spark):
    edges = [(i, i + 1, 0) for i in range(20)] + [(i, i - 1, 1) for i in range(1, 21)] + [(i, i, 2) for i in range(21)]
    assert nodes(graph.shortest_path(spark.createDataFrame(edges, EDGE), 0, 20)) == list(range(21))


def test_no_path_and_no_edges(spark):
    lone = spark.createDataFrame([(1, 2, 0), (3, 1, 0)], EDGE)
    assert nodes(graph.shortest_path(lone, 1, 3)) == []
    assert nodes(graph.shortest_path(spark.createDataFrame([], EDGE), 1, 3)) == []


def test_pointers_of_a_chain_are_doubled(spark):
    chain = spark.range(2_000).select(F.col("id").alias("node"), (F.col("id") + 1).alias("next"))
    assert nodes(graph.follow(chain, 0, 2_000)) == list(range(2_001))
    assert nodes(graph.follow(chain, 5, 3)) == [5, 6, 7, 8]
    assert nodes(graph.follow(chain, 1_998, 50)) == [1_998, 1_999, 2_000]


def test_nested_maps_in_parts(spark):
    leaves = [(a, b, c, 100 * a + 10 * b + c) for a in (1, 2) for b in range(6) for c in range(b + 1)]
    df = spark.createDataFrame(leaves, "a int, b int, c int, v int")
    for hot_rows in (None, 5):
        tree = ag.nest_levels(df, ["a", "b", "c"], F.col("v"), part_rows=4, hot_rows=hot_rows)
        got = tree.withColumn("order", F.map_keys("tree")).collect()
        back, sizes = [], []
        for r in got:
            inside = [(r.a, b, c, v) for b, below in r.tree.items() for c, v in below.items()]
            assert r.order == sorted(r.order)
            sizes.append(len(inside))
            back += inside
        assert sorted(back) == leaves and max(sizes) <= 4
        assert sorted((r.a, r.part) for r in got) == [(a, p) for a in (1, 2) for p in range(6)]


def test_counts_of_a_hot_key_in_parts(spark):
    df = spark.range(5_000).select(F.lit("hot").alias("page"), (F.col("id") % 1_000).alias("kind")).unionByName(
        spark.createDataFrame([("cold", 3), ("cold", 3), (None, 1)], "page string, kind long"))
    got = ag.nested_counts(df, "page", "kind", part_rows=300, hot_rows=200)
    sizes = sorted((r.page or "", r.part, len(r.hits)) for r in got.collect())
    assert sizes == [("", 0, 1), ("cold", 0, 1), ("hot", 0, 300), ("hot", 1, 300), ("hot", 2, 300), ("hot", 3, 100)]
    assert got.filter("page = 'cold'").head().hits == {3: 2}
    assert got.select(F.explode("hits")).agg(F.sum("value")).head()[0] == 5_003
