"""Windows, ordered sequences, sorting and pages (survey 2.7 and 2.8)."""

from pyspark.sql import functions as F

from tessera.operators import paging as pg
from tessera.operators import windows as wn
from tessera.operators.ordering import number_rows, rank_rows, running_over
from tessera.plans.registry import query, r, text


@query("rank_per_group", "W-1", """
SELECT o_custkey, o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC) AS rank FROM orders""")
def _(t):
    return rank_rows(t.orders.select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"],
                     ["-o_orderpriority"]).drop("o_orderpriority")


@query("rank_hot_groups", "W-1", """
SELECT c_mktsegment, c_custkey, rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS rank FROM customer""")
def _(t):
    return rank_rows(t.customer.select("c_mktsegment", "c_custkey", "c_acctbal"), ["c_mktsegment"],
                     ["-c_acctbal"], hot_rows=100).drop("c_acctbal")


@query("partition_total", "W-2", """
SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey), 2) AS customer_total FROM orders""")
def _(t):
    rows = wn.with_totals(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_custkey"],
                          {"customer_total": F.sum(F.col("o_totalprice").cast("decimal(18,2)"))})
    return rows.select("o_orderkey", F.col("customer_total").cast("double").alias("customer_total"))


@query("centred_average", "W-3", """
SELECT o_orderkey, round(avg(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 4) AS moving_avg FROM orders""")
def _(t):
    rows = wn.centred_average(t.orders.select("o_orderkey", "o_orderdate", "o_totalprice"), [],
                              ["o_orderdate", "o_orderkey"], "o_totalprice")
    return rows.select("o_orderkey", r("moving_avg", 4).alias("moving_avg"))


@query("centred_average_hot_group", "W-3", """
SELECT o_orderkey, round(avg(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 4) AS moving_avg FROM orders""")
def _(t):
    rows = wn.centred_average(t.orders.select("o_orderkey", "o_orderdate", "o_totalprice"), [],
                              ["o_orderdate", "o_orderkey"], "o_totalprice", hot_rows=1000, block_rows=2000)
    return rows.select("o_orderkey", r("moving_avg", 4).alias("moving_avg"))


@query("moving_average", "W-4", """
SELECT user_id, event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 2 PRECEDING), 6) AS moving_avg FROM events""")
def _(t):
    rows = wn.moving_average(t.events.select("user_id", "event_id", "ts", "value"), ["user_id"],
                             ["ts", "event_id"], "value", 3)
    return rows.select("user_id", "event_id", r("moving_avg").alias("moving_avg"))


@query("sliding_max", "W-5", """
SELECT user_id, event_id, window_max FROM (SELECT user_id, event_id, max(value) OVER w AS window_max, count(*) OVER w AS n
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS 2 PRECEDING)) WHERE n = 3""")
def _(t):
    return (wn.sliding_max(t.events.select("user_id", "event_id", "ts", "value"), ["user_id"], ["ts", "event_id"],
                           "value", 3).select("user_id", "event_id", "window_max"))


@query("running_average", "W-6", """
SELECT user_id, event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 9) AS running_avg FROM events""")
def _(t):
    return (wn.running_average(t.events.select("user_id", "event_id", "ts", "value"), ["user_id"],
                               ["ts", "event_id"], "value")
            .select("user_id", "event_id", r("running_avg", 9).alias("running_avg")))


@query("running_sum_product", "W-7", """
SELECT user_id, event_id, round(sum(value) OVER w, 4) AS running_sum, round(ln(product(1 + value / 100) OVER w), 6) AS running_product
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def _(t):
    rows = t.events.select("user_id", "event_id", "ts", "value").withColumn("f", 1 + F.col("value") / 100)
    out = running_over(rows, ["user_id"], ["ts", "event_id"],
                       {"running_sum": ("sum", "value"), "running_product": ("product", "f")})
    return out.select("user_id", "event_id", r("running_sum", 4).alias("running_sum"),
                      r(F.log("running_product")).alias("running_product"))


@query("running_sum_hot_group", "W-7", """
SELECT event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_sum FROM events""")
def _(t):
    rows = t.events.select("event_id", "ts", F.col("value").cast("decimal(18,2)").alias("value"))
    out = running_over(rows, [], ["ts", "event_id"], {"running_sum": ("sum", "value")}, hot_rows=1000, block_rows=700)
    return out.select("event_id", F.col("running_sum").cast("double").alias("running_sum"))


_ROLLING = """
WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
c AS (SELECT a.event_id, b.event_type, count(*) AS cnt FROM n a JOIN n b
  ON a.user_id = b.user_id AND b.p BETWEEN a.p - 4 AND a.p GROUP BY 1, 2)
SELECT event_id, string_agg(event_type || ':' || cnt, ',' ORDER BY event_type) AS counts FROM c GROUP BY 1"""


@query("rolling_counts", "W-8", _ROLLING)
def _(t):
    rows = wn.rolling_counts(t.events.select("user_id", "event_id", "ts", "event_type"), ["user_id"],
                             ["ts", "event_id"], "event_type", 5)
    return rows.select("event_id", text(F.transform("counts", lambda c: F.concat_ws(
        ":", c["item"], c["cnt"].cast("string")))).alias("counts"))


@query("recent_items", "W-9", """
SELECT user_id, event_type, last_pos, rn FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY last_pos DESC) AS rn
FROM (SELECT user_id, event_type, max(event_id) AS last_pos FROM events GROUP BY 1, 2)) WHERE rn <= 3""")
def _(t):
    return wn.recent_items(t.events, ["user_id"], "event_type", "event_id", 3)


@query("enumerate_rows", "W-10", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS idx FROM orders""")
def _(t):
    return wn.enumerate_rows(t.orders.select("o_orderkey", "o_totalprice"), [],
                             ["-o_totalprice", "o_orderkey"]).drop("o_totalprice")


@query("rotate_rows", "W-11", """
SELECT c_custkey, (row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1 + 2) % count(*) OVER (PARTITION BY c_mktsegment) AS idx FROM customer""")
def _(t):
    return wn.rotate_rows(t.customer.select("c_mktsegment", "c_custkey"), ["c_mktsegment"], ["c_custkey"], 2
                          ).drop("c_mktsegment")


@query("rotate_left", "W-11", """
WITH n AS (SELECT c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1 AS i, count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer)
SELECT c_custkey, (i - 3 + n) % n AS idx FROM n""")
def _(t):
    return wn.rotate_rows(t.customer.select("c_mktsegment", "c_custkey"), ["c_mktsegment"], ["c_custkey"], -3
                          ).drop("c_mktsegment")


@query("round_robin", "W-12", """
SELECT o_orderkey, (['red', 'green', 'blue'])[(row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) % 3 + 1] AS task FROM orders""")
def _(t):
    return wn.round_robin(t.orders.select("o_orderkey", "o_orderdate"), [], ["o_orderdate", "o_orderkey"],
                          ["red", "green", "blue"]).drop("o_orderdate")


@query("bounded_tail", "W-13", """
SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events) WHERE rn <= 5""")
def _(t):
    return wn.bounded_tail(t.events.select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"], 5).drop("ts")


@query("sort_nulls_last", "O-1", """
WITH p AS (SELECT p_partkey, p_size, nullif(p_type, 'SMALL') AS kind FROM part)
SELECT p_partkey, row_number() OVER (ORDER BY p_size DESC NULLS LAST, kind ASC NULLS LAST, p_partkey) AS pos FROM p""")
def _(t):
    rows = t.part.select("p_partkey", "p_size", F.nullif("p_type", F.lit("SMALL")).alias("kind"))
    return number_rows(rows, [], ["-p_size", "kind", "p_partkey"]).select("p_partkey", "pos")


@query("sort_mixed", "O-2", """
SELECT c_custkey, row_number() OVER (ORDER BY c_nationkey, c_acctbal DESC, c_custkey) AS pos FROM customer""")
def _(t):
    rows = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    return number_rows(rows, [], ["c_nationkey", "-c_acctbal", "c_custkey"]).select("c_custkey", "pos")


@query("sort_by_length", "O-3", """
SELECT p_partkey, row_number() OVER (ORDER BY length(p_name), p_partkey) AS pos FROM part""")
def _(t):
    rows = t.part.select("p_partkey", F.length("p_name").alias("n"))
    return number_rows(rows, [], ["n", "p_partkey"]).select("p_partkey", "pos")


@query("limit_offset", "O-4", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 20""")
def _(t):
    return pg.page(t.orders.select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"], 3, 10)


@query("page_envelope", "O-5", """
SELECT count(*) AS total, 2 AS page, 100 AS size, CAST(ceil(count(*) / 100) AS BIGINT) AS pages,
 200 < count(*) AS has_next, true AS has_prev FROM part""")
def _(t):
    return pg.page_envelope(t.part, 2, 500, max_size=100)


@query("page_after_key", "O-5", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 300000 OR (o_totalprice = 300000 AND o_orderkey > 50)
ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def _(t):
    return pg.page_after(t.orders.select("o_orderkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"],
                         [300000.0, 50], 20)


@query("slice_counts", "O-5", """
SELECT count(*) AS total, 30 AS skip, 50 AS "limit", least(50, count(*) - 30) AS returned FROM customer""")
def _(t):
    return pg.slice_envelope(t.customer, ["c_custkey"], 30, 50)[1]


@query("priority_drain", "O-6", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderdate, o_orderkey) AS turn FROM orders""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", F.struct("o_orderdate", "o_orderkey").alias("at"))
    return pg.drain_order(rows, "o_orderpriority", "at").select("o_orderkey", "turn")


@query("arg_max", "O-7", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) rn FROM orders) WHERE rn = 1""")
def _(t):
    return pg.arg_max(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_totalprice",
                      "o_orderkey")


@query("reverse_rows", "O-8", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS pos FROM orders""")
def _(t):
    return pg.reversed_rows(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]
                            ).select("o_orderkey", "pos")


@query("reverse_arrays", "O-8", """
SELECT p_partkey, array_to_string(list_reverse(string_split(p_name, ' ')), ' ') AS name, reverse(p_name) AS letters FROM part""")
def _(t):
    return t.part.select("p_partkey", text(F.reverse(F.split("p_name", " ")), " ").alias("name"),
                         F.reverse("p_name").alias("letters"))
