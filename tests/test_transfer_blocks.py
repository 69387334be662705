"""Groups of transfers that are walked in blocks, against a plain walk."""
import random
from decimal import Decimal

import pytest

from tessera.operators import dml
from test_transfers import check, ring, walk


def test_blocks_of_one_group_take_few_jobs(spark):
    draw = random.Random(1)
    accounts = [("hub", Decimal(300))] + [(f"a{i}", Decimal(0)) for i in range(50)]
    moves = [(i, "hub", f"a{i % 50}", Decimal(draw.randrange(1, 60))) for i in range(60)]
    context = spark.sparkContext
    context.setJobGroup("blocks", "")
    check(spark, accounts, moves, group_rows=20)
    jobs = len(context.statusTracker().getJobIdsForGroup("blocks"))
    context._jsc.clearJobGroup()
    assert jobs < 150


def test_a_later_receipt_does_not_pay_an_earlier_move(spark):
    accounts = [("v", Decimal(10)), ("w", Decimal(0)), ("x", Decimal(0)), ("y", Decimal(0)), ("z", Decimal(10))]
    moves = [(1, "v", "w", Decimal(1)), (2, "w", "x", Decimal(1)), (3, "x", "y", Decimal(5)), (5, "z", "x", Decimal(10))]
    check(spark, accounts, moves, group_rows=2)


@pytest.mark.parametrize("kind", ["double", "long"])
def test_blocks_do_as_one_walk_does(spark, kind):
    accounts, moves = ring(150, 12)
    if kind == "double":  # tenths, whose sums depend on their order
        accounts = [(a, None if b is None else float(b) / 10) for a, b in accounts]
        moves = [(s, a, b, None if q is None else float(q) / 10) for s, a, b, q in moves]
    else:  # beyond what a double can tell apart
        accounts = [(a, None if b is None else int(b) + 2 ** 60) for a, b in accounts]
        moves = [(s, a, b, None if q is None else int(q) + 2 ** 58) for s, a, b, q in moves]
    a = spark.createDataFrame(accounts, f"name string, cash {kind}")
    m = spark.createDataFrame(moves, f"seq long, src string, dst string, qty {kind}").repartition(4)
    state, decided = dml.transfer(a, m, "name", "cash", group_rows=50)
    held, done = walk(accounts, moves)
    assert {r.seq: r.done for r in decided.collect()} == done
    assert {r.name: r.cash for r in state.collect()} == (pytest.approx(held) if kind == "double" else held)
