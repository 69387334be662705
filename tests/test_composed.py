"""Hot keys whose blocks compose: machines and editor histories against a plain walk."""
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import sessions as ss
from tessera.operators import steps

#: Parity of the events and a lock: neither ever forgets where it began.
PARITY = {("even", "a"): "odd", ("odd", "a"): "even", ("odd", "lock"): "locked", ("locked", "key"): "odd"}


def walk(step, data):
    """Outcomes by id of (key, id, *values) rows in order."""
    out, states = {}, {}
    for k, i, *values in data:
        states[k], out[i] = step(states.get(k), *values)
    return out


@pytest.fixture()
def events():
    draw = random.Random(5)
    return [(draw.choice(["x", "x", "x", None]), i, draw.choice(["a", "a", "lock", "key", "b", None])) for i in range(900)]


@pytest.mark.parametrize("block", [7, 100, 5000])
def test_machine(spark, events, block):
    df = spark.createDataFrame(events, "k string, id int, event string").repartition(4)
    got = ss.replay_machine(df, ["k"], ["id"], "event", PARITY, "even", hot_rows=100, block_rows=block)
    want = walk(steps.machine(PARITY, "even"), events)
    assert {r.id: (r.ok, r.state) for r in got.collect()} == want


def test_machine_without_keys(spark, events):
    df = spark.createDataFrame(events, "k string, id int, event string").repartition(4)
    got = ss.replay_machine(df, [], ["id"], "event", PARITY, "even", hot_rows=100, block_rows=60)
    want = walk(steps.machine(PARITY, "even"), [(0, i, e) for _, i, e in events])
    assert {r.id: (r.ok, r.state) for r in got.collect()} == want


def edits(weights, n=800, nulls=0.0, keys=("s", "s", "t")):
    draw = random.Random(11)
    return [(draw.choice(keys), i, draw.choices(["execute", "undo", "redo"], weights)[0],
             None if draw.random() < nulls else f"v{i}") for i in range(n)]


@pytest.mark.parametrize("weights,nulls", [((2, 3, 2), 0), ((1, 40, 40), 0), ((0, 1, 1), 0), ((5, 1, 0), 0), ((2, 3, 2), 0.2)],
                         ids=["mixed", "few executes", "none", "mostly executes", "null values"])
@pytest.mark.parametrize("longest", [3, 10])
def test_edits(spark, weights, nulls, longest):
    data = edits(weights, nulls=nulls)
    df = spark.createDataFrame(data, "k string, id int, op string, value string").repartition(4)
    got = ss.replay_edits(df, ["k"], ["id"], "op", "value", longest, hot_rows=100, block_rows=23)
    assert {r.id: (r.current,) for r in got.collect()} == walk(steps.undo_redo(longest), data)


def test_long_history_goes_by_rounds(spark):
    data = edits((3, 2, 2), 300)
    df = spark.createDataFrame(data, "k string, id int, op string, value string")
    assert not hasattr(steps.undo_redo(30), "entries")
    got = ss.replay_edits(df, ["k"], ["id"], "op", "value", 30, hot_rows=50, block_rows=60)
    assert {r.id: (r.current,) for r in got.collect()} == walk(steps.undo_redo(30), data)


def test_number_of_jobs_does_not_grow_with_the_blocks(spark, events):
    df = spark.createDataFrame([("x", i, e) for _, i, e in events], "k string, id int, event string")
    context, count, seen = spark.sparkContext, [], []
    for block in (300, 5):
        context.setJobGroup(f"blocks of {block}", "")
        seen.append(rows(ss.replay_machine(df, ["k"], ["id"], "event", PARITY, "even", hot_rows=100, block_rows=block)))
        count.append(len(context.statusTracker().getJobIdsForGroup(f"blocks of {block}")))
    context._jsc.clearJobGroup()
    assert seen[0] == seen[1] and abs(count[0] - count[1]) <= 2


def test_blocks_merge_to_one_walk():
    """After enough new states every entry of a history block has the same exit."""
    step = steps.undo_redo(10)
    exits = set()
    for _, state in step.entries:
        for i in range(11):
            state, _ = step(state, "execute", f"v{i}")
        exits.add(repr(state))
    assert len(step.entries) == 67 and len(exits) == 1


def test_marks_are_filled_from_the_entered_state():
    step = steps.undo_redo(4)
    for entered in (None, [["a", "b"], ["c"], "d"], [[], ["x", "y"], "z"], [["p"], [], "q"]):
        for ops in (["undo"], ["redo", "execute"], ["undo", "undo", "redo"], ["undo", "execute", "undo", "undo"]):
            want = entered
            found = dict(step.entries)[step.entry_of(entered)]
            for i, op in enumerate(ops):
                want, _ = step(want, op, f"n{i}")
                found, _ = step(found, op, f"n{i}")
            assert step.fill(found, entered) == want
