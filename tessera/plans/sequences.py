"""Graphs, machines, replay and per-key rules on tables (survey 2.12, batch side of 2.14)."""

from pyspark.sql import functions as F

from tessera.operators import graph as gr
from tessera.operators import sessions as ss
from tessera.plans.registry import query, r, text


@query("adjacency_lists", "G-1", """
WITH e AS (SELECT c_nationkey AS a, c_custkey + 1000 AS b, c_custkey AS o FROM customer),
u AS (SELECT a AS src, b AS dst, o * 2 AS o FROM e UNION ALL SELECT b, a, o * 2 + 1 FROM e),
n AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY o, dst) - 1 AS p FROM u)
SELECT src, p // 50 AS part, string_agg(dst, ',' ORDER BY p) AS neighbours FROM n GROUP BY 1, 2""")
def _(t):
    edges = t.customer.select(F.col("c_nationkey").cast("bigint").alias("src"), (F.col("c_custkey") + 1000).alias("dst"),
                              F.col("c_custkey").alias("ordinal"))
    return gr.adjacency(edges, part_rows=50).withColumn("neighbours", text("neighbours"))


def shop_graph(t):
    """Customers, orders and parts as nodes; neighbours in key order, customers first."""
    orders = t.orders.select(F.concat(F.lit("c"), "o_custkey").alias("c"), F.concat(F.lit("o"), "o_orderkey").alias("o"),
                             F.col("o_custkey"), F.col("o_orderkey"))
    items = t.lineitem.select("l_orderkey", "l_partkey").distinct()
    o = F.concat(F.lit("o"), "l_orderkey")
    p = F.concat(F.lit("p"), "l_partkey")
    far = F.lit(10**12)
    return (orders.select(F.col("c").alias("src"), F.col("o").alias("dst"), F.col("o_orderkey").alias("ordinal"))
            .unionByName(orders.select(F.col("o").alias("src"), F.col("c").alias("dst"), F.col("o_custkey").alias("ordinal")))
            .unionByName(items.select(o.alias("src"), p.alias("dst"), (F.col("l_partkey") + far).alias("ordinal")))
            .unionByName(items.select(p.alias("src"), o.alias("dst"), F.col("l_orderkey").alias("ordinal"))))


@query("shortest_path", "G-2", """
WITH RECURSIVE i AS (SELECT DISTINCT l_orderkey AS k, l_partkey AS p FROM lineitem),
e AS (SELECT 'c' || o_custkey AS src, 'o' || o_orderkey AS dst, o_orderkey AS ord FROM orders
 UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey, o_custkey FROM orders
 UNION ALL SELECT 'o' || k, 'p' || p, p + 1000000000000 FROM i UNION ALL SELECT 'p' || p, 'o' || k, k FROM i),
w AS (SELECT 'c1' AS node, ['c1'] AS path, [0::BIGINT] AS rank, 0 AS d UNION ALL
 SELECT dst, list_append(path, dst), list_append(rank, ord), d + 1 FROM w JOIN e ON src = node WHERE d < 4 AND NOT list_contains(path, dst)),
b AS (SELECT path FROM w WHERE node = 'c7' ORDER BY d, rank LIMIT 1)
SELECT unnest(range(len(path))) AS pos, unnest(path) AS node FROM b""")
def _(t):
    return gr.shortest_path(shop_graph(t), "c1", "c7")


@query("first_path_depth_first", "G-3", """
WITH x AS (SELECT 'c1' AS a, 's' || s_suppkey AS b, 's' || s_suppkey AS s, s_nationkey FROM supplier)
SELECT unnest(range(7)) AS pos, unnest(['c1', 'n' || (SELECT c_nationkey FROM customer WHERE c_custkey = 1),
 'r' || (SELECT n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey = 1), 'world',
 'r' || n_regionkey, 'n' || n_nationkey, 's' || s_suppkey]) AS node FROM
 (SELECT * FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey <>
  (SELECT n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey = 1) ORDER BY s_suppkey LIMIT 1)""")
def _(t):
    region, nation = F.concat(F.lit("r"), "n_regionkey"), F.concat(F.lit("n"), "n_nationkey")
    tree = (t.region.select(F.lit("world").alias("src"), F.concat(F.lit("r"), "r_regionkey").alias("dst"),
                            F.col("r_regionkey").cast("bigint").alias("ordinal"))
            .unionByName(t.nation.select(region.alias("src"), nation.alias("dst"), F.col("n_nationkey").cast("bigint").alias("ordinal")))
            .unionByName(t.supplier.select(F.concat(F.lit("n"), "s_nationkey"), F.concat(F.lit("s"), "s_suppkey"),
                                           F.col("s_suppkey") + 1000).toDF("src", "dst", "ordinal"))
            .unionByName(t.customer.select(F.concat(F.lit("n"), "c_nationkey"), F.concat(F.lit("c"), "c_custkey"),
                                           F.col("c_custkey") + 10**9).toDF("src", "dst", "ordinal")))
    home = (t.customer.filter("c_custkey = 1").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("n_regionkey").head()[0])
    goal = (t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).filter(F.col("n_regionkey") != home)
            .orderBy("s_suppkey").select(F.concat(F.lit("s"), "s_suppkey")).head()[0])
    return gr.first_path(gr.undirected(tree), "c1", goal)


# A visit as a machine: the transitions of the worked query below.
VISIT = {("new", "view"): "browsing", ("browsing", "click"): "engaged", ("engaged", "purchase"): "buyer",
         ("engaged", "view"): "browsing", ("buyer", "view"): "browsing", ("browsing", "error"): "new",
         ("new", "signup"): "browsing"}

_N = """WITH RECURSIVE n AS (SELECT *, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events), """


@query("replay_machine", "G-4", _N + """
m AS (SELECT * FROM (VALUES ('new','view','browsing'),('browsing','click','engaged'),('engaged','purchase','buyer'),
 ('engaged','view','browsing'),('buyer','view','browsing'),('browsing','error','new'),('new','signup','browsing')) v(a, e, b)),
s AS (SELECT user_id, event_id, p, b IS NOT NULL AS ok, coalesce(b, 'new') AS state FROM n LEFT JOIN m ON a = 'new' AND e = event_type WHERE p = 1
 UNION ALL SELECT n.user_id, n.event_id, n.p, m.b IS NOT NULL, coalesce(m.b, s.state) FROM s JOIN n ON n.user_id = s.user_id AND n.p = s.p + 1
 LEFT JOIN m ON m.a = s.state AND m.e = n.event_type)
SELECT event_id, ok, state FROM s""")
def _(t):
    return ss.replay_machine(t.events.select("user_id", "event_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"],
                             "event_type", VISIT, "new").select("event_id", "ok", "state")


@query("replay_machine_hot_key", "G-4", _N + """
m AS (SELECT * FROM (VALUES ('new','view','browsing'),('browsing','click','engaged'),('engaged','purchase','buyer'),
 ('engaged','view','browsing'),('buyer','view','browsing'),('browsing','error','new'),('new','signup','browsing')) v(a, e, b)),
g AS (SELECT event_id, event_type, row_number() OVER (ORDER BY ts, event_id) AS p FROM events),
s AS (SELECT event_id, p, b IS NOT NULL AS ok, coalesce(b, 'new') AS state FROM g LEFT JOIN m ON a = 'new' AND e = event_type WHERE p = 1
 UNION ALL SELECT g.event_id, g.p, m.b IS NOT NULL, coalesce(m.b, s.state) FROM s JOIN g ON g.p = s.p + 1
 LEFT JOIN m ON m.a = s.state AND m.e = g.event_type)
SELECT event_id, ok, state FROM s""")
def _(t):
    rows = t.events.select(F.lit("all").alias("k"), "event_id", "ts", "event_type")
    return ss.replay_machine(rows, ["k"], ["ts", "event_id"], "event_type", VISIT, "new", hot_rows=1000,
                             block_rows=1000).select("event_id", "ok", "state")


def edits(t):
    """Events as edits: errors undo, sign-ups redo, the others set a new state."""
    op = F.when(F.col("event_type") == "error", "undo").when(F.col("event_type") == "signup", "redo").otherwise("execute")
    return t.events.select("user_id", "event_id", "ts", op.alias("op"), F.col("event_id").cast("string").alias("state"))


@query("replay_edits", "G-5", _N + """
s AS (SELECT user_id, event_id, p, []::VARCHAR[] AS h, []::VARCHAR[] AS rd, CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(event_id AS VARCHAR) END AS cur FROM n WHERE p = 1
 UNION ALL SELECT n.user_id, n.event_id, n.p,
 CASE WHEN n.event_type NOT IN ('error', 'signup') THEN CASE WHEN s.cur IS NOT NULL THEN list_append(s.h, s.cur)[-10:] ELSE s.h END
      WHEN n.event_type = 'error' AND len(s.h) > 0 THEN s.h[:-2]
      WHEN n.event_type = 'signup' AND len(s.rd) > 0 THEN list_append(s.h, s.cur)[-10:] ELSE s.h END,
 CASE WHEN n.event_type NOT IN ('error', 'signup') THEN [] WHEN n.event_type = 'error' AND len(s.h) > 0 THEN list_append(s.rd, s.cur)
      WHEN n.event_type = 'signup' AND len(s.rd) > 0 THEN s.rd[:-2] ELSE s.rd END,
 CASE WHEN n.event_type NOT IN ('error', 'signup') THEN CAST(n.event_id AS VARCHAR) WHEN n.event_type = 'error' AND len(s.h) > 0 THEN s.h[-1]
      WHEN n.event_type = 'signup' AND len(s.rd) > 0 THEN s.rd[-1] ELSE s.cur END
 FROM s JOIN n ON n.user_id = s.user_id AND n.p = s.p + 1)
SELECT event_id, cur AS current FROM s""")
def _(t):
    return ss.replay_edits(edits(t), ["user_id"], ["ts", "event_id"], "op", "state").select("event_id", "current")


@query("replay_edits_hot_key", "G-5", _N + """
g AS (SELECT event_id, event_type, row_number() OVER (ORDER BY ts, event_id) AS p FROM events),
s AS (SELECT event_id, p, []::VARCHAR[] AS h, []::VARCHAR[] AS rd, CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(event_id AS VARCHAR) END AS cur FROM g WHERE p = 1
 UNION ALL SELECT g.event_id, g.p,
 CASE WHEN g.event_type NOT IN ('error', 'signup') THEN CASE WHEN s.cur IS NOT NULL THEN list_append(s.h, s.cur)[-10:] ELSE s.h END
      WHEN g.event_type = 'error' AND len(s.h) > 0 THEN s.h[:-2]
      WHEN g.event_type = 'signup' AND len(s.rd) > 0 THEN list_append(s.h, s.cur)[-10:] ELSE s.h END,
 CASE WHEN g.event_type NOT IN ('error', 'signup') THEN [] WHEN g.event_type = 'error' AND len(s.h) > 0 THEN list_append(s.rd, s.cur)
      WHEN g.event_type = 'signup' AND len(s.rd) > 0 THEN s.rd[:-2] ELSE s.rd END,
 CASE WHEN g.event_type NOT IN ('error', 'signup') THEN CAST(g.event_id AS VARCHAR) WHEN g.event_type = 'error' AND len(s.h) > 0 THEN s.h[-1]
      WHEN g.event_type = 'signup' AND len(s.rd) > 0 THEN s.rd[-1] ELSE s.cur END
 FROM s JOIN g ON g.p = s.p + 1)
SELECT event_id, cur AS current FROM s""")
def _(t):
    rows = edits(t).withColumn("k", F.lit("all"))
    return ss.replay_edits(rows, ["k"], ["ts", "event_id"], "op", "state", hot_rows=1000, block_rows=500).select("event_id", "current")


@query("cache_with_expiry", "E-13", _N + """
s AS (SELECT user_id, event_id, p, t AS last, false AS hit FROM n WHERE p = 1
 UNION ALL SELECT n.user_id, n.event_id, n.p, CASE WHEN n.t - s.last < 43200000000 THEN s.last ELSE n.t END, n.t - s.last < 43200000000
 FROM s JOIN n ON n.user_id = s.user_id AND n.p = s.p + 1)
SELECT event_id, hit FROM s""")
def _(t):
    return ss.cache_hits(t.events.select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"], "ts",
                         43200).select("event_id", "hit")


@query("limit_sliding_window", "ST-3", _N + """
s AS (SELECT user_id, event_id, p, [t] AS calls, true AS allowed FROM n WHERE p = 1
 UNION ALL SELECT n.user_id, n.event_id, n.p,
 CASE WHEN len(list_filter(s.calls, lambda c: n.t - c <= 86400000000)) >= 2 THEN list_filter(s.calls, lambda c: n.t - c <= 86400000000)
      ELSE list_append(list_filter(s.calls, lambda c: n.t - c <= 86400000000), n.t) END,
 len(list_filter(s.calls, lambda c: n.t - c <= 86400000000)) < 2 FROM s JOIN n ON n.user_id = s.user_id AND n.p = s.p + 1)
SELECT event_id, allowed FROM s""")
def _(t):
    return ss.limit_sliding(t.events.select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"], "ts", 2,
                            86400).select("event_id", "allowed")


@query("limit_token_bucket", "ST-4", _N + """
s AS (SELECT user_id, event_id, p, t, 0 AS tokens, false AS allowed FROM n WHERE p = 1
 UNION ALL SELECT user_id, event_id, p, t, CASE WHEN k >= 1 THEN k - 1 ELSE k END, k >= 1 FROM
 (SELECT n.user_id, n.event_id, n.p, n.t, CAST(least(3, s.tokens + CAST(floor((n.t - s.t) / 1000000 * (1.0::DOUBLE / 28800)) AS INT)) AS INT) AS k
  FROM s JOIN n ON n.user_id = s.user_id AND n.p = s.p + 1))
SELECT event_id, allowed FROM s""")
def _(t):
    return ss.limit_bucket(t.events.select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"], "ts", 3,
                           1.0 / 28800).select("event_id", "allowed")


@query("wait_token_bucket", "ST-5", _N + """
s AS (SELECT user_id, event_id, p, t AS last, 1.0::DOUBLE AS tokens, 0.0::DOUBLE AS wait FROM n WHERE p = 1
 UNION ALL SELECT user_id, event_id, p, now + w, CASE WHEN k < 1 THEN 0.0::DOUBLE ELSE k - 1 END, (now + w - t) / 1000000 FROM
 (SELECT *, CASE WHEN k < 1 THEN CAST(round((1 - k) * 50000 * 1000000) AS BIGINT) ELSE 0 END AS w FROM
 (SELECT n.user_id, n.event_id, n.p, n.t, greatest(n.t, s.last) AS now,
  least(2.0::DOUBLE, s.tokens + (greatest(n.t, s.last) - s.last) / 1000000 * 2e-5::DOUBLE) AS k
  FROM s JOIN n ON n.user_id = s.user_id AND n.p = s.p + 1)))
SELECT event_id, round(wait, 2) AS wait FROM s""")
def _(t):
    return ss.wait_bucket(t.events.select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"], "ts", 2,
                          2e-5).select("event_id", r("wait", 2).alias("wait"))


def requests():
    """Events as requests: three kinds with a key of their user, one without, one that only reads."""
    method = F.when(F.col("event_type") == "purchase", "PATCH").when(F.col("event_type") == "error", "GET").otherwise("POST")
    key = F.when(F.col("event_type") != "signup", F.col("user_id").cast("string"))
    return ["event_id", "ts", method.alias("method"), F.col("event_type").alias("path"), key.alias("key"),
            F.col("value").cast("string").alias("body"), (F.col("event_id") % 4 + 200).cast("int").alias("status")]


@query("replay_responses", "ST-6", _N + """
k AS (SELECT *, CAST(event_id % 4 + 200 AS INT) AS code, event_type IN ('click', 'view', 'purchase') AS kept,
 row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS q FROM n),
s AS (SELECT user_id, event_type, event_id, q, t, CAST(value AS VARCHAR) AS body, code, false AS replayed FROM k WHERE q = 1 AND kept
 UNION ALL SELECT k.user_id, k.event_type, k.event_id, k.q, CASE WHEN k.t - s.t < 86400000000 THEN s.t ELSE k.t END,
 CASE WHEN k.t - s.t < 86400000000 THEN s.body ELSE CAST(k.value AS VARCHAR) END,
 CASE WHEN k.t - s.t < 86400000000 THEN s.code ELSE k.code END, k.t - s.t < 86400000000
 FROM s JOIN k ON k.user_id = s.user_id AND k.event_type = s.event_type AND k.q = s.q + 1)
SELECT event_id, body AS response, replayed, code AS response_status FROM s
UNION ALL SELECT event_id, CAST(value AS VARCHAR), false, code FROM k WHERE NOT kept""")
def _(t):
    return (ss.replay_responses(t.events.select(*requests()), [], ["ts", "event_id"], "ts", "method", "path", "key", "body",
                                status="status")
            .select("event_id", "response", "replayed", "response_status"))
