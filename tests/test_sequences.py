"""Per-key rules against plain Python, hot keys included, and streams against batch."""
import random
from collections import Counter, deque
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import sessions as ss
from tessera.streaming import routing as rt
from tessera.streaming import stateful as sf

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def calls(spark):
    rng = random.Random(3)
    data, clock = [], {"a": 0.0, "b": 0.0, "hot": 0.0}
    for i in range(240):
        k = rng.choice(["a", "b", "hot", "hot"])
        clock[k] += rng.choice([0.0, 0.1, 0.5, 1.0, 2.0, 5.0, 12.0])
        data.append((k, i, START + timedelta(seconds=clock[k]), f"r{i}"))
    return data


@pytest.fixture(scope="module")
def table(spark, calls):
    return spark.createDataFrame(calls, "k string, id int, ts timestamp, body string").repartition(4).cache()


def per_key(calls, decide):
    out, state = {}, {}
    for k, i, ts, body in sorted(calls, key=lambda c: (c[0], c[2], c[1])):
        out[i], state[k] = decide(state.get(k), (ts - START).total_seconds(), body)
    return out


def sliding(state, t, _):
    state = state if state is not None else deque()
    while state and t - state[0] > 10:
        state.popleft()
    if len(state) >= 3:
        return False, state
    state.append(t)
    return True, state


def discrete(state, t, _):
    tokens, last = state or (0, t)
    tokens = min(4, tokens + int(round(t - last, 6) * 0.7))
    return (True, (tokens - 1, t)) if tokens >= 1 else (False, (tokens, t))


def ttl(state, t, _):
    return (True, state) if state is not None and round(t - state, 6) < 6 else (False, t)


CASES = {
    "sliding": (lambda d, h: ss.limit_sliding(d, ["k"], ["ts", "id"], "ts", 3, 10, **h), sliding, "allowed"),
    "discrete": (lambda d, h: ss.limit_bucket(d, ["k"], ["ts", "id"], "ts", 4, 0.7, **h), discrete, "allowed"),
    "ttl": (lambda d, h: ss.cache_hits(d, ["k"], ["ts", "id"], "ts", 6, **h), ttl, "hit"),
}


@pytest.mark.parametrize("hot", [{}, {"hot_rows": 60, "block_rows": 40}], ids=["plain", "split"])
@pytest.mark.parametrize("case", CASES)
def test_rule(table, calls, case, hot):
    run, decide, column = CASES[case]
    got = {r["id"]: r[column] for r in run(table, hot).collect()}
    assert got == per_key(calls, decide)


def test_bucket_boundaries(spark):
    """Calls 0.1 s apart at 5 tokens a second refill ``int(0.5) = 0`` each time; an empty start refuses all."""
    data = [("k", i, START + timedelta(seconds=i / 10)) for i in range(12)]
    df = spark.createDataFrame(data, "k string, id int, ts timestamp")
    assert not any(r["allowed"] for r in ss.limit_bucket(df, ["k"], ["ts"], "ts", 10, 5.0).collect())
    waits = [r["wait"] for r in ss.wait_bucket(df, ["k"], ["ts"], "ts", 3, 5.0).orderBy("id").collect()]
    assert waits[:4] == [0, 0, 0, 0] and waits[-1] > 0


def test_tokens_per_call(spark):
    """Each call asks for tokens of its own; NULL asks for one."""
    data = [("k", i, START + timedelta(seconds=s), n) for i, (s, n) in enumerate([(0, 1), (4, 3), (4, 2), (5, None), (6, 1)])]
    df = spark.createDataFrame(data, "k string, id int, ts timestamp, n int")
    got = ss.limit_bucket(df, ["k"], ["ts", "id"], "ts", 4, 1.0, need="n").orderBy("id").collect()
    assert [r["allowed"] for r in got] == [False, True, False, True, True]
    got = ss.wait_bucket(df, ["k"], ["ts", "id"], "ts", 4, 1.0, need="n").orderBy("id").collect()
    assert [r["wait"] for r in got] == [0, 0, 1, 1, 1]


def test_newest_event_of_an_order(spark, tmp_path):
    users = spark.createDataFrame([(1, "Ann")], "user_id int, user_name string")
    items = spark.createDataFrame([(10, 2.0)], "order_id int, amount double")
    kind = "order_id int, user_id int, status string, at int"
    (spark.createDataFrame([(10, 1, "new", 1), (10, 1, "sent", 3), (10, 1, "paid", 2)], kind)
     .write.parquet(str(tmp_path / "in")))
    stream = spark.readStream.schema(kind).parquet(str(tmp_path / "in"))
    view = rt.project_orders(stream, users, items, newest=["-at"])
    assert rows(view.select("order_id", "status")) == [(10, "sent")]


def test_window_edge(spark):
    data = [("k", i, START + timedelta(seconds=s)) for i, s in enumerate([0, 10, 10.5])]
    df = spark.createDataFrame(data, "k string, id int, ts timestamp")
    got = ss.limit_sliding(df, ["k"], ["ts"], "ts", 1, 10).orderBy("id").collect()
    assert [r["allowed"] for r in got] == [True, False, True]


def test_idempotent_replay(spark):
    t = [0, 5, 6, 7, 86_399, 86_400, 86_401, 90_000]
    data = [("POST", "/a", "x"), ("POST", "/a", "x"), ("POST", "/b", "x"), ("GET", "/a", "x"), ("PATCH", "/a", "x"),
            ("POST", "/a", "x"), ("POST", "/a", None), ("POST", "/a", "x")]
    df = spark.createDataFrame([(i, START + timedelta(seconds=s), *d, f"b{i}") for i, (s, d) in enumerate(zip(t, data))],
                               "id int, ts timestamp, method string, path string, key string, body string")
    got = ss.replay_responses(df, [], ["ts", "id"], "ts", "method", "path", "key", "body").orderBy("id").collect()
    assert [(r["response"], r["replayed"]) for r in got] == [
        ("b0", False), ("b0", True), ("b2", False), ("b3", False), ("b0", True), ("b5", False), ("b6", False), ("b5", True)]


@pytest.fixture()
def stream(spark, calls, tmp_path):
    """The calls in time order as four files, one per micro-batch."""
    ordered = sorted(calls, key=lambda c: (c[2], c[1]))
    import os
    for n in range(4):
        part = ordered[n * 60:(n + 1) * 60]
        out = str(tmp_path / f"in{n}")
        spark.createDataFrame(part, "k string, id int, ts timestamp, body string").coalesce(1).write.parquet(out)
        for f in os.listdir(out):
            if f.endswith(".parquet"):
                os.utime(f"{out}/{f}", (1_700_000_000 + n, 1_700_000_000 + n))
    return (spark.readStream.schema("k string, id int, ts timestamp, body string").option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(str(tmp_path)))


def test_stream_equals_batch(stream, table):
    out = sf.run_to_table(sf.limit_sliding(stream, ["k"], ["ts", "id"], "ts", 3, 10))
    batch = ss.limit_sliding(table, ["k"], ["ts", "id"], "ts", 3, 10)
    assert rows(out.select("id", "allowed")) == rows(batch.select("id", "allowed"))


def test_stream_rolling(stream, calls):
    out = {r["id"]: r["counts"] for r in sf.run_to_table(sf.rolling_counts(stream, ["k"], ["ts", "id"], "k", 3)).collect()}
    last = {}
    for k, i, ts, _ in sorted(calls, key=lambda c: (c[2], c[1])):
        last.setdefault(k, deque(maxlen=3)).append(k)
        assert out[i] == ",".join(f"{x}:{n}" for x, n in sorted(Counter(last[k]).items()))


def test_stream_routing(stream, calls):
    good, dead = rt.route_stream(stream, "k", ["a", "hot"])
    assert good.count() == sum(c[0] != "b" for c in calls) and dead.count() == sum(c[0] == "b" for c in calls)
    assert {r[0] for r in good.select("handler").distinct().collect()} == {"a", "hot"}


def test_strict_routing(table):
    with pytest.raises(Exception, match="no handler"):
        rt.route(table, "k", ["a"], strict=True)[0].collect()


def test_outbox(spark, tmp_path):
    df = spark.range(25).select("id", F.col("id").alias("created_at"), F.when(F.col("id") < 3, "old").alias("published_at"))
    folder = str(tmp_path)

    def send(batch):
        import uuid
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(",".join(str(row["id"]) for row in batch))

    left = rt.drain_outbox(df, "now", send, limit=10)
    sent = [[int(x) for x in p.read_text().split(",")] for p in tmp_path.iterdir()]
    assert sorted(x for s in sent for x in s) == list(range(3, 25))
    assert all(s == sorted(s) and len(s) <= 10 for s in sent)
    assert left.filter("published_at IS NULL").count() == 0 and left.filter("published_at = 'old'").count() == 3


def test_projection_goes_on_after_a_restart(spark, tmp_path):
    users = spark.createDataFrame([(1, "Ann")], "user_id int, user_name string")
    items = spark.createDataFrame([(10, 2.0), (11, 3.0)], "order_id int, amount double")
    for n in (10, 11):
        (spark.createDataFrame([(n, 1, "new")], "order_id int, user_id int, status string").coalesce(1)
         .write.mode("append").parquet(str(tmp_path / "in")))
        stream = spark.readStream.schema("order_id int, user_id int, status string").parquet(str(tmp_path / "in"))
        view = rt.project_orders(stream, users, items, str(tmp_path / "out"))
    assert rows(view.select("order_id", "total_amount")) == [(10, 2.0), (11, 3.0)]
    again = rt.project_orders(stream, users, items, str(tmp_path / "out"))  # nothing new
    assert rows(again) == rows(view)
    assert len(list((tmp_path / "out/view").iterdir())) == 2


def test_a_later_batch_replaces_orders(spark, tmp_path):
    users = spark.createDataFrame([(1, "Ann")], "user_id int, user_name string")
    items = spark.createDataFrame([(10, 2.0)], "order_id int, amount double")
    for n, data in enumerate([[(10, "new"), (11, "new")], [(11, "paid"), (12, "new")], [(10, "sent")], []]):
        (spark.createDataFrame([(i, 1, s) for i, s in data], "order_id int, user_id int, status string").coalesce(1)
         .write.mode("append").parquet(str(tmp_path / "in")))
        stream = spark.readStream.schema("order_id int, user_id int, status string").parquet(str(tmp_path / "in"))
        view = rt.project_orders(stream, users, items, str(tmp_path / "out"))
    assert rows(view.select("order_id", "status")) == [(10, "sent"), (11, "paid"), (12, "new")]


@pytest.fixture()
def shuffled(spark, calls, tmp_path):
    """The calls in no order at all as four files, one per micro-batch, with one call that has no time."""
    import os
    mixed = random.Random(9).sample([*calls, ("a", 999, None, "none")], len(calls) + 1)
    kind = "k string, id int, ts timestamp, body string"
    for n in range(4):
        out = str(tmp_path / f"in{n}")
        spark.createDataFrame(mixed[n * 61:(n + 1) * 61], kind).coalesce(1).write.parquet(out)
        for f in os.listdir(out):
            if f.endswith(".parquet"):
                os.utime(f"{out}/{f}", (1_700_000_000 + n, 1_700_000_000 + n))
    options = {"recursiveFileLookup": True, "pathGlobFilter": "*.parquet"}
    stream = spark.readStream.schema(kind).options(**options, maxFilesPerTrigger=1).parquet(str(tmp_path))
    return stream, spark.read.schema(kind).options(**options).parquet(str(tmp_path))


RULES = {
    "sliding": ("allowed", lambda m, d, **t: m.limit_sliding(d, ["k"], ["ts", "id"], "ts", 3, 10, **t), True),
    "bucket": ("allowed", lambda m, d, **t: m.limit_bucket(d, ["k"], ["ts", "id"], "ts", 4, 0.7, **t), False),
    "wait": ("wait", lambda m, d, **t: m.wait_bucket(d, ["k"], ["ts", "id"], "ts", 4, 0.7, **t), True),
}


@pytest.mark.parametrize("rule", RULES)
def test_rows_in_any_order_equal_the_batch(spark, shuffled, rule, tmp_path_factory):
    stream, table = shuffled
    name, run, ends = RULES[rule]
    delay = sf.disorder(table, "ts")
    path = str(tmp_path_factory.mktemp("run"))
    out = sf.run_in_time(lambda beats: run(sf, stream, delay=delay, beats=beats), spark, path=path)
    assert rows(out.select("id", name)) == rows(run(ss, table).select("id", name))

    def state(variable):
        return (spark.read.format("statestore").option("path", f"{path}/log").option("stateVarName", variable).load()
                .count())

    assert state("held") == 0
    assert state("rule") == (0 if ends else 3)  # an unused bucket of the discrete kind is never like a new one


def test_responses_in_any_order_equal_the_batch(spark, shuffled):
    stream, table = shuffled
    code = (F.col("id") % 3 + 200).alias("code"), F.upper("k").alias("p")
    delay = sf.disorder(table, "ts")
    out = sf.run_in_time(lambda beats: sf.replay_responses(
        stream.select("*", *code), ["ts", "id"], "ts", "p", "k", "body", 20, status="code", delay=delay, beats=beats), spark)
    want = ss.replay_responses(table.select("*", *code, F.lit("POST").alias("m")), [], ["ts", "id"], "ts", "m", "p", "k", "body", 20,
                               status="code")
    names = ["id", "response", "replayed", "response_status"]
    assert rows(out.select(*names)) == rows(want.select(*names))
    assert out.filter("replayed AND response_status IS NULL").count() == 0


def test_late_rows_only_beyond_the_delay(spark, shuffled):
    stream, table = shuffled
    out = sf.run_in_time(lambda beats: sf.limit_sliding(stream, ["k"], ["ts", "id"], "ts", 3, 10, delay="0 seconds",
                                                        beats=beats), spark)
    assert 0 < out.count() < table.count()
