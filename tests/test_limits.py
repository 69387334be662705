"""No caps, and answers that do not depend on sizes or partitions."""
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.functions import udfs
from tessera.operators import dml, graph, joins, multisets, ordering, paging, vectors


@pytest.mark.parametrize("limit", [1_000, 1])
def test_equal_and_null_thresholds(spark, limit):
    tiers = spark.createDataFrame([(10.0, 3.0), (10.0, 2.0), (None, 9.0), (20.0, 1.0)], "t double, p double")
    orders = spark.createDataFrame([(1, 15), (2, 5), (3, 25), (4, None)], "id int, volume int")
    got = joins.tier_lookup(orders, "volume", tiers, "t", "p", limit=limit).select("id", "tier_price")
    assert rows(got) == [(1, 3.0), (2, 3.0), (3, 1.0), (4, None)]


def test_empty_partners(spark):
    left, none = spark.range(3), spark.createDataFrame([], "name string")
    assert joins.pair_with_small(left, none).columns == ["id", "name"]
    assert joins.pair_with_small(left, none).count() == 0
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id long, v array<double>")
    asked = spark.createDataFrame([], "query_id long, query array<double>")
    assert vectors.nearest_each(corpus, asked, "id", "v", 1).count() == 0


def test_more_queries_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(vectors, "QUERY_ROWS", 7)
    corpus = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(40)], "id long, v array<double>")
    asked = corpus.select(F.col("id").alias("query_id"), F.col("v").alias("query"))
    got = vectors.nearest_each(corpus, asked, "id", "v", 1, "l2").select("query_id", "id")
    assert rows(got) == sorted([(i, i) for i in range(40)], key=repr)


@pytest.mark.parametrize("parts", [1, 5])
def test_fold_starts_once(spark, parts):
    big = 2 ** 53 + 1
    data = [(big, 1), (big, 2), (None, 3), (None, 4), (big + 1, 5)]
    df = spark.createDataFrame(data, "k long, v long").repartition(parts)
    got = udfs.fold_groups(df, ["k"], "v", lambda a, b: a + b, 100, "bigint")
    assert rows(got) == sorted([(big, 103), (None, 107), (big + 1, 105)], key=repr)


def test_top_of_many(spark):
    df = spark.range(6_000).select((F.col("id") % 2).alias("k"), "id")
    got = ordering.top_per_key(df, ["k"], ["-id"], 1_500)
    assert got.groupBy("k").agg(F.count("*"), F.min("id")).orderBy("k").collect() == [(0, 1500, 3000), (1, 1500, 3001)]


def test_long_paths_and_many_moves(spark):
    edges = spark.createDataFrame([(i, i + 1, 0) for i in range(12)], "src long, dst long, ordinal long")
    assert [r.node for r in graph.shortest_path(edges, 0, 12).orderBy("pos").collect()] == list(range(13))
    tree = spark.createDataFrame([(i, i - 1) for i in range(1, 10)], "node long, parent long")
    assert multisets.descendants(tree, "node", "parent", 1).agg(F.max("depth")).head()[0] == 8
    accounts = spark.createDataFrame([("a", 10), ("b", 0)], "name string, cash long")
    moves = spark.createDataFrame([(i, "a", "b", 3) for i in range(5)], "seq long, src string, dst string, qty long")
    state, decided = dml.transfer(accounts, moves, "name", "cash")
    assert rows(state) == [("a", 1), ("b", 9)] and rows(decided.select("seq", "done"))[3:] == [(3, False), (4, False)]


def test_arg_max(spark):
    df = spark.createDataFrame([("a", 1, 9), ("a", 3, 5), ("a", 3, 4), ("b", None, 1)], "k string, v int, t int")
    assert rows(paging.arg_max(df, ["k"], "v", "t")) == [("a", 3, 4)]
    assert rows(paging.arg_max(df, [], "v", "t")) == [("a", 3, 4)]


def test_normalise_long_vectors(spark):
    df = spark.range(200).select(F.transform(F.sequence(F.lit(1), F.lit(768)), lambda x: (x + F.col("id")).cast("double")).alias("v"))
    lengths = df.select(vectors.magnitude(vectors.normalise(F.col("v"))).alias("n")).agg(F.min("n"), F.max("n")).head()
    assert lengths[0] == pytest.approx(1) and lengths[1] == pytest.approx(1)


def test_rows_without_a_time_or_item():
    from tessera.operators import steps

    nan = float("nan")
    limiter = steps.sliding_limiter(1, 10)
    state, out = limiter(None, 5)
    assert out == (True,) and limiter(state, None) == (state, (None,)) and limiter(state, nan) == (state, (None,))
    assert limiter(state, 6)[1] == (False,)
    assert steps.replay_guard()(None, None, "body") == (None, (None, None, None))
    assert steps.bucket_discrete(2, 1.0)(None, nan) == (None, (None,))
    assert steps.bucket_continuous(2, 1.0)(None, None) == (None, (None,))
    assert steps.ttl_cache(5)(3, None) == (3, (None,))
    state = None
    for item, want in (("b", "b:1"), (None, "b:1"), ("a", "a:1,b:1"), ("a", "a:2")):
        state, out = steps.rolling(3)(state, item)
        assert out == (want,)
