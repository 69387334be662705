"""Paired transfers against a plain walk."""
import random
from decimal import Decimal

import pytest

from conftest import rows
from tessera.operators import dml, graph


def walk(accounts, moves):
    held, done = dict(accounts), {}
    for seq, src, dst, qty in sorted(moves):
        if src not in held or dst not in held:
            done[seq] = False
        elif held[src] is None or qty is None:
            done[seq] = None
        else:
            done[seq] = held[src] >= qty
            if done[seq]:
                held[src] -= qty
                held[dst] = None if held[dst] is None else held[dst] + qty
    return held, done


def check(spark, accounts, moves, **options):
    a = spark.createDataFrame(accounts, "name string, cash decimal(18,2)")
    m = spark.createDataFrame(moves, "seq long, src string, dst string, qty decimal(18,2)").repartition(4)
    state, decided = dml.transfer(a, m, "name", "cash", **options)
    held, done = walk(accounts, moves)
    assert {r.name: r.cash for r in state.collect()} == held
    assert {r.seq: r.done for r in decided.collect()} == done


def ring(n, size, seed=4):
    draw = random.Random(seed)
    accounts = [(f"a{i}", Decimal(draw.randrange(200))) for i in range(size)] + [("null", None), ("alone", Decimal(5))]
    names = [a for a, _ in accounts[:-1]] + ["unknown"]
    moves = [(i, draw.choice(names), draw.choice(names), Decimal(draw.randrange(90)) if draw.random() < 0.97 else None)
             for i in range(n)]
    return accounts, moves


@pytest.mark.parametrize("group_rows", [200_000, 5])
def test_dependent_moves(spark, group_rows):
    check(spark, *ring(60 if group_rows == 5 else 600, 40), group_rows=group_rows)


def test_many_groups(spark):
    draw = random.Random(8)
    accounts = [(f"a{i}", Decimal(50)) for i in range(120)]
    moves = [(i, f"a{b * 4 + draw.randrange(4)}", f"a{b * 4 + draw.randrange(4)}", Decimal(draw.randrange(60)))
             for i in range(500) for b in [draw.randrange(30)]]
    check(spark, accounts, moves)
    check(spark, accounts, [])


def test_ten_thousand_moves_from_one_account(spark):
    draw = random.Random(1)
    accounts = [("hub", Decimal(4000))] + [(f"a{i}", Decimal(0)) for i in range(50)]
    moves = [(i, "hub", f"a{i % 50}", Decimal(draw.randrange(1, 900))) for i in range(10_000)]
    context = spark.sparkContext
    context.setJobGroup("hub", "")
    check(spark, accounts, moves)
    jobs = len(context.statusTracker().getJobIdsForGroup("hub"))
    context._jsc.clearJobGroup()
    assert jobs < 80


def test_groups_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (200, 200)], "a int, b int").repartition(3)
    want = [(i, 0) for i in range(61)] + [(100, 100), (101, 100), (200, 200)]
    assert rows(graph.linked_groups(links, "a", "b")) == sorted(want, key=repr)
    assert graph.linked_groups(links.limit(0), "a", "b").count() == 0
