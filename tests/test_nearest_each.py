"""Nearest rows of many queries against the search of one."""
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import vectors as vc

SCHEMA = "id long, v array<double>"


def table(n=300, dims=6):
    draw = random.Random(12)
    rows = [(i, [draw.gauss(0, 1) for _ in range(dims)]) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(60)]  # many equal vectors: ties
    rows += [(1000, [2 * x for x in rows[5][1]]), (1001, None), (1002, [0.0] * dims), (1003, [1.0, None] + [0.0] * (dims - 2))]
    return rows


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("block,shard", [(1000, 20_000), (40, 70)], ids=["in place", "cells"])
def test_each_as_alone(spark, monkeypatch, metric, block, shard):
    monkeypatch.setattr(vc, "QUERY_ROWS", block)
    monkeypatch.setattr(vc, "SHARD_ROWS", shard)
    df = spark.createDataFrame(table(), SCHEMA).repartition(5)
    asked = df.filter("id % 3 = 0 OR id > 999").select(F.col("id").alias("query_id"), F.col("v").alias("query"))
    got = {}
    for r in vc.nearest_each(df, asked, "id", "v", 7, metric).collect():
        got.setdefault(r.query_id, []).append((r.rn, r.id, r.distance))
    assert len(got) == asked.count()
    for i, q in [(r.query_id, r["query"]) for r in asked.collect()]:
        found = sorted(got[i])
        if i in (0, 5, 300, 333, 1000, 1001, 1002, 1003) and q is not None and None not in q:
            alone = vc.nearest(df, q, "id", "v", 7, metric).collect()
            assert [(n, r.id, r.distance) for n, r in enumerate(alone, 1)] == found
        elif q is None or None in q:
            assert [x[1:] for x in found] == [(n, None) for n in range(7)]


def test_more_rows_than_have_a_distance(spark):
    data = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [0.0, 1.0])]
    df = spark.createDataFrame(data, SCHEMA)
    asked = spark.createDataFrame([(9, [1.0, 0.0])], "query_id long, query array<double>")
    got = vc.nearest_each(df, asked, "id", "v", 5).orderBy("rn").collect()
    assert [r.id for r in got] == [1, 5, 4, 2, 3] and got[3].distance is None


def test_other_dimensions_are_an_error(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0])], SCHEMA)
    asked = spark.createDataFrame([(9, [1.0, 0.0, 2.0])], "query_id long, query array<double>")
    with pytest.raises(Exception, match="dimension"):
        vc.nearest_each(df, asked, "id", "v", 1).collect()
    with pytest.raises(ValueError, match="metric"):
        vc.nearest_each(df, asked, "id", "v", 1, "other")


def test_ten_thousand_queries_without_a_row_for_a_pair(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    ten = F.explode(F.sequence(F.lit(0), F.lit(9)))
    asked = e.withColumn("n", ten).select((F.col("vec_id") * 10 + F.col("n")).alias("query_id"), F.col("embedding").alias("query"))
    out = vc.nearest_each(e, asked, "vec_id", "embedding", 1)
    plan = out._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "CartesianProduct" not in plan
    own = out.filter(F.floor(F.col("query_id") / 10) == F.col("vec_id")).count()
    assert out.count() == asked.count() and own >= 0.9 * asked.count()  # but for equal vectors of lower key
