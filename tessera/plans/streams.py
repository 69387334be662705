"""Sources, sinks and streams (survey 2.1 and 2.14)."""

from pyspark.sql import functions as F

from tessera.plans.joins import view_inputs
from tessera.plans.sequences import requests
from tessera.plans.registry import ORACLES, query, r, text
from tessera.session import scratch_path
from tessera.sources import readers as rd
from tessera.sources import sinks as sk
from tessera.streaming import routing as rt
from tessera.streaming import stateful as sf


@query("csv_source", "S-4", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer""")
def _(t):
    path = scratch_path(t.spark, "csv")
    t.customer.select("c_custkey", "c_name", "c_mktsegment").write.option("header", True).csv(path)
    return rd.csv_rows(t.spark, path)


@query("text_line_source", "S-5", """
SELECT trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13)) AS line FROM documents""")
def _(t):
    path = scratch_path(t.spark, "lines")
    lines = t.documents.select(F.explode(F.split("text", "\n")).alias("line"))
    lines.select(F.concat(F.lit("\t "), "line", F.lit(" "))).write.text(path)
    return rd.text_lines(t.spark, path)


@query("whole_file_source", "S-6", """
SELECT CAST(sum(length(text) + 1) AS BIGINT) AS chars FROM documents""")
def _(t):
    path = scratch_path(t.spark, "files")
    t.documents.select("text").write.text(path)
    return rd.whole_files(t.spark, path).agg(F.sum(F.length("content")).alias("chars"))


@query("range_functions", "S-7", """
SELECT p_partkey, p_partkey >= 10 AND p_partkey < 1500 AND (p_partkey - 10) % 7 = 0 AS member, CAST(len(range(p_size, -5, -3)) AS BIGINT) AS n,
 CAST(range(p_size, -5, -3)[2] AS BIGINT) AS second, array_to_string(range(p_size, -5, -3), ',') AS vals FROM part""")
def _(t):
    size, stop = F.col("p_size").cast("bigint"), F.lit(-5).cast("bigint")
    return t.part.select("p_partkey", rd.in_range(F.col("p_partkey"), F.lit(10), F.lit(1500), 7).alias("member"),
                         rd.range_length(size, stop, -3).alias("n"), rd.range_at(size, stop, -3, F.lit(1)).alias("second"),
                         text(rd.range_values(size, stop, -3)).alias("vals"))


@query("concatenated_source", "S-8", """
SELECT c_name AS name, 0 AS source FROM customer UNION ALL SELECT s_name, 1 FROM supplier WHERE false
UNION ALL SELECT p_name, 2 FROM part""")
def _(t):
    return rd.concatenate(t.customer.select(F.col("c_name").alias("name")),
                          t.supplier.filter(F.lit(False)).select(F.col("s_name").alias("name")),
                          t.part.select(F.col("p_name").alias("name")))


@query("generated_series", "S-9", """
WITH RECURSIVE f AS (SELECT 1 AS n, 0::HUGEINT AS a, 1::HUGEINT AS b UNION ALL SELECT n + 1, b, a + b FROM f WHERE n < 60)
SELECT p_partkey, CAST(a AS VARCHAR) AS last, array_to_string(range(p_size, 0, -1), ',') AS down FROM part JOIN f ON n = p_size""")
def _(t):
    return t.part.select("p_partkey", F.get(rd.fibonacci(F.col("p_size")), F.col("p_size") - 1).cast("string").alias("last"),
                         text(rd.countdown(F.col("p_size"))).alias("down"))


@query("message_parse", "S-10", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def _(t):
    sent = sk.keyed_messages(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderkey")
    return sk.parse_messages(sent, "o_orderkey bigint, o_custkey bigint, o_orderstatus string")


@query("keyed_messages", "S-11", """
SELECT CAST(o_orderkey AS VARCHAR) AS key, '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS value FROM orders""")
def _(t):
    return sk.keyed_messages(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey")


@query("batch_numbers", "S-12", """
SELECT batch, count(*) AS n, min(o_orderkey) AS first FROM (SELECT o_orderkey,
 CAST(ceil(row_number() OVER (ORDER BY o_orderkey) / 500) AS BIGINT) AS batch FROM orders) GROUP BY 1""")
def _(t):
    numbered = sk.batch_numbers(t.orders.select("o_orderkey"), ["o_orderkey"])
    return numbered.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first"))


@query("bound_parameters", "S-13", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 200000")
def _(t):
    return rd.bound_query(t.spark, "SELECT o_orderkey FROM {o} WHERE o_orderstatus = :s AND o_totalprice > :p",
                          {"s": "P", "p": 200000.0}, o=t.orders)


@query("insert_documents", "S-16", """
SELECT c_name AS name, c_mktsegment AS hobby, CAST(NULL AS INT) AS size FROM customer UNION ALL SELECT p_name, NULL, p_size FROM part""")
def _(t):
    return rd.insert_documents(t.customer.select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("hobby")),
                               t.part.select(F.col("p_name").alias("name"), F.col("p_size").alias("size")))


def events(t, *columns):
    return sf.table_stream(t.spark, t.folder, "events").select(*columns)


@query("stream_transform", "ST-1", "SELECT event_id, 'processed_' || upper(event_type) AS result FROM events")
def _(t):
    return sf.run_to_table(sf.tagged(events(t, "event_id", "event_type")), "transform")


def ordered(t, make, *columns):
    """A rule over the events in order of time, whatever order their files come in."""
    delay = sf.disorder(t.events, "ts")
    return sf.run_in_time(lambda beats: make(events(t, *columns), delay=delay, beats=beats), t.spark)


@query("stream_rolling_counts", "ST-2", ORACLES["rolling_counts"])
def _(t):
    return ordered(t, lambda rows, **timing: sf.rolling_counts(
        rows, ["user_id"], ["ts", "event_id"], "event_type", 5, "ts", **timing).select("event_id", "counts"),
        "user_id", "event_id", "ts", "event_type")


@query("stream_limit_sliding_window", "ST-3", ORACLES["limit_sliding_window"])
def _(t):
    return ordered(t, lambda rows, **timing: sf.limit_sliding(
        rows, ["user_id"], ["ts", "event_id"], "ts", 2, 86400, **timing).select("event_id", "allowed"),
        "user_id", "event_id", "ts")


@query("stream_limit_token_bucket", "ST-4", ORACLES["limit_token_bucket"])
def _(t):
    return ordered(t, lambda rows, **timing: sf.limit_bucket(
        rows, ["user_id"], ["ts", "event_id"], "ts", 3, 1.0 / 28800, **timing).select("event_id", "allowed"),
        "user_id", "event_id", "ts")


@query("stream_wait_token_bucket", "ST-5", ORACLES["wait_token_bucket"])
def _(t):
    return ordered(t, lambda rows, **timing: sf.wait_bucket(
        rows, ["user_id"], ["ts", "event_id"], "ts", 2, 2e-5, **timing).select("event_id", r("wait", 2).alias("wait")),
        "user_id", "event_id", "ts")


@query("stream_replay_responses", "ST-6", ORACLES["replay_responses"])
def _(t):
    return ordered(t, lambda rows, **timing: sf.replay_responses(
        rows, ["ts", "event_id"], "ts", "path", "key", "body", method="method", status="status", **timing)
        .select("event_id", "response", "replayed", "response_status"), *requests())


@query("stream_routing", "ST-7", """
SELECT event_id, event_type AS handler FROM events WHERE event_type <> 'signup' UNION ALL
SELECT event_id, 'dead' FROM events WHERE event_type = 'signup'""")
def _(t):
    good, dead = rt.route_stream(events(t, "event_id", "event_type"), "event_type", ["click", "view", "purchase", "error"])
    return good.select("event_id", "handler").unionByName(dead.select("event_id", F.lit("dead").alias("handler")))


@query("stream_order_view", "ST-8", ORACLES["order_view"])
def _(t):
    _, users, items = view_inputs(t)
    created = sf.table_stream(t.spark, t.folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("status"))
    return rt.project_orders(created, users, items).withColumn("total_amount", F.col("total_amount").cast("double"))


@query("outbox_round", "ST-9", """
WITH c AS (SELECT event_id FROM events WHERE value >= 20 ORDER BY ts, event_id LIMIT 100)
SELECT event_id AS id, CASE WHEN value < 20 THEN 'earlier' WHEN event_id IN (SELECT event_id FROM c) THEN 'now' END AS published_at FROM events""")
def _(t):
    outbox = t.events.select(F.col("event_id").alias("id"), F.col("ts").alias("created_at"),
                             F.when(F.col("value") < 20, "earlier").alias("published_at"))
    return rt.outbox_round(outbox, "now")[1].select("id", "published_at")


@query("channel_fan_out", "ST-10", """
WITH m AS (SELECT DISTINCT conv_id, role AS member FROM conversations)
SELECT conv_id, turn, member FROM conversations JOIN m USING (conv_id)""")
def _(t):
    members = t.conversations.select("conv_id", F.col("role").alias("member")).distinct()
    return rt.fan_out(t.conversations.select("conv_id", "turn"), members, "conv_id")
