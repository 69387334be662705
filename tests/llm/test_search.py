"""Exact top-k search against brute force."""
import math

import numpy as np
import pytest

from tessera.llm.maxscore import top_products

SCHEMA = "vec_id long, embedding array<float>, label string"


def brute(vectors, asked, k):
    ready = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in ready:
        if asked(q):
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ready if i != q)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard,block", [(8192, 4096), (37, 3)])
def test_top_products(spark, shard, block):
    draw = np.random.default_rng(5)
    rows = [(i, draw.normal(size=12).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 420)]  # many equal vectors: ties
    rows += [(500, None), (550, [1.0, None]), (600, [float("nan")] * 12), (650, [float("inf")] * 12), (700, []),
             (750, [1.0] * 5), (800, [0.0] * 12)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    got = top_products(df, df.filter("vec_id % 50 = 0"), k=5, shard_rows=shard, query_rows=block)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda q: q % 50 == 0, 5)


def test_few_rows(spark):
    rows = [(0, [0.5, -0.5]), (1, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    assert sorted(map(tuple, top_products(df, df, k=5).collect())) == brute(rows, lambda q: True, 5)
    assert top_products(df.limit(0), df, k=5).count() == 0
    assert top_products(df, df.limit(0), k=5).count() == 0
    alone = df.filter("vec_id = 0")
    assert top_products(alone, alone, k=5).count() == 0
