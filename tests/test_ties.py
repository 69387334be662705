"""Order statistics of hot groups most of whose rows share one value."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import aggregates as ag
from tessera.operators import ordering as od

SCHEMA = "id int, k string, v double"


def data(n=3000):
    """Nine tenths of the rows hold one value; a second key has many values; NULL keys and values."""
    draw = random.Random(7)
    out = []
    for i in range(n):
        k = draw.choice(["hot", "hot", "hot", "wide", None])
        v = 5.0 if k == "hot" and draw.random() < 0.9 else None if draw.random() < 0.05 else float(draw.randrange(400))
        out.append((i, k, v))
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(data(), SCHEMA).repartition(6).cache()


@pytest.mark.parametrize("order", [["v"], ["-v"], ["v", "-id"]])
@pytest.mark.parametrize("hot", [10_000, 400, 5, 0])
def test_rank(table, order, hot):
    got = {r.id: r["rank"] for r in od.rank_rows(table, ["k"], order, hot_rows=hot).collect()}
    want = {}
    for key in {k for _, k, _ in data()}:
        mine = [r for r in data() if r[1] == key]

        def place(r):
            v = (r[2] is None, (-r[2] if order[0] == "-v" else r[2]) if r[2] is not None else 0)
            return (*v, -r[0]) if len(order) == 2 else v

        spots = sorted(place(r) for r in mine)
        first = {}
        for i, s in enumerate(spots, 1):
            first.setdefault(s, i)
        want |= {r[0]: first[place(r)] for r in mine}
    assert got == want


@pytest.mark.parametrize("p", [0.0, 0.1, 0.5, 0.95, 1.0])
@pytest.mark.parametrize("hot", [10_000, 100, 0])
def test_percentile(table, p, hot):
    got = {r.k: r.pct for r in ag.percentile_exact(table, ["k"], "v", p, hot_rows=hot).collect()}
    for key in {k for _, k, _ in data()}:
        assert got[key] == pytest.approx(np.percentile([v for _, k, v in data() if k == key and v is not None], p * 100))
    assert len(got) == 3


def test_one_group_of_all_rows(table):
    pct = ag.percentile_exact(table, [], "v", 0.5, hot_rows=10).collect()
    assert pct[0].pct == pytest.approx(np.percentile([v for _, _, v in data() if v is not None], 50))


def test_stats_are_the_same_either_way(table):
    plain, split = (ag.latency_stats(table, ["k"], "v", hot_rows=h) for h in (10_000, 50))
    a, b = ({r.k: r for r in df.collect()} for df in (plain, split))
    assert set(a) == set(b)
    for k in a:
        assert tuple(a[k])[1:] == pytest.approx(tuple(b[k])[1:])
    none = table.withColumn("v", F.lit(None).cast("double"))
    assert rows(ag.latency_stats(none, ["k"], "v", hot_rows=50)) == rows(ag.latency_stats(none, ["k"], "v"))


def test_ties_are_split_between_tasks(spark, table, monkeypatch):
    """Rows equal in the whole order are spread by the range sort, and each has a place of its own."""
    sizes = []

    def spy(df):
        if "__id" in df.columns:
            sizes.append([r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()])
        return df.checkpoint()

    spark.sparkContext.setCheckpointDir(str(od.cut_lineage.__globals__["shared_dir"](spark)))
    monkeypatch.setattr(od, "cut_lineage", spy)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    same = table.withColumn("v", F.lit(1.0))
    got = od.number_rows(same, [], ["v"], "pos", hot_rows=10)
    assert sorted(r.pos for r in got.select("pos").collect()) == list(range(1, 3001))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes[0]) == 8 and max(sizes[0]) < 2 * 3000 / 8
