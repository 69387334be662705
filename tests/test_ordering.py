"""Every ordered operator gives the same result on its hot-group path."""
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import ordering as od


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(7)
    data = []
    for i in range(600):
        k = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        data.append((k, rng.randint(0, 40), i, rng.choice([1.0, 2.0, 0.5])))
    return spark.createDataFrame(data, "k string, v int, id int, x double").repartition(5).cache()


def both(fn):
    return rows(fn(None)), rows(fn(50))


def test_number_rows(table):
    a, b = both(lambda h: od.number_rows(table, ["k"], ["-v", "id"], hot_rows=h))
    assert a == b and len(a) == 600


def test_number_rows_global(table):
    a, b = both(lambda h: od.number_rows(table, [], ["v", "id"], hot_rows=h))
    assert a == b and sorted(r[-1] for r in b) == list(range(1, 601))


def test_rank_rows(table):
    a, b = both(lambda h: od.rank_rows(table, ["k"], ["-v"], hot_rows=h))
    assert a == b


def test_frame_over(table):
    a, b = both(lambda h: od.frame_over(table, ["k"], ["v", "id"], 2, 1,
                                        {"m": F.max("id"), "n": F.count("id")}, hot_rows=h, block_rows=7))
    assert a == b and len(a) == 600


def test_running_over(table):
    folds = {"s": ("sum", "v"), "n": ("count", "id"), "lo": ("min", "v"), "p": ("product", "x")}
    a, b = both(lambda h: od.running_over(table, ["k"], ["id"], folds, hot_rows=h, block_rows=9)
                .withColumn("p", F.round(F.log("p"), 6)))
    assert a == b


def test_list_parts(table):
    a, b = both(lambda h: od.list_parts(table, ["k"], "id", ["v", "id"], part_rows=30, hot_rows=h))
    assert a == b and sum(len(r[-1]) for r in a) == 600
    assert max(len(r[-1]) for r in a) <= 30


def test_fold_rows(table):
    def greedy(state, t):
        """A call is taken when at least 5 have passed since the last one taken."""
        if state is None or t - state >= 5:
            return t, (True,)
        return state, (False,)

    a, b = both(lambda h: od.fold_rows(table, ["k"], ["id"], ["id"],
                                       lambda s, t: greedy(s, int(t)), "taken boolean",
                                       hot_rows=h, block_rows=40))
    assert a == b
    last, want = {}, []
    for k, v, i, x in sorted((tuple(r) for r in table.collect()), key=lambda r: r[2]):
        last[k], (ok,) = greedy(last.get(k), i)
        want.append((k, v, i, x, ok))
    assert a == sorted(want, key=repr)
