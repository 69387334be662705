"""Joins (survey 2.4)."""

from pyspark.sql import functions as F

from tessera.operators import joins as jn
from tessera.operators.ordering import list_parts, top_per_key
from tessera.plans.registry import query, r, text


@query("join_inner", "J-1", """
SELECT c_name, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey""")
def _(t):
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey")).select("c_name", "o_orderkey")


_BIG = "(SELECT * FROM orders WHERE o_totalprice > 480000)"


def _big(t):
    return t.orders.filter(F.col("o_totalprice") > 480000)


@query("join_left", "J-2", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey")
def _(t):
    return (t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select("c_custkey", "o_orderkey"))


@query("join_right", "J-2", "SELECT c_custkey, o_orderkey FROM orders RIGHT JOIN customer ON c_custkey = o_custkey")
def _(t):
    return (t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"), "right")
            .select("c_custkey", "o_orderkey"))


@query("join_full", "J-2", """
SELECT c_custkey, event_id FROM customer FULL JOIN events ON c_custkey = user_id * 3""")
def _(t):
    return (t.customer.join(t.events, F.col("c_custkey") == F.col("user_id") * 3, "full")
            .select("c_custkey", "event_id"))


@query("pair_with_small", "J-3", "SELECT c_custkey, r_name FROM customer, region")
def _(t):
    return jn.pair_with_small(t.customer.select("c_custkey"), t.region.select("r_name"))


_NEWEST = """
SELECT c_custkey, o_orderkey, o_orderdate FROM customer {how} JOIN
 (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn
  FROM orders) WHERE rn = 1) ON c_custkey = o_custkey"""


def _newest(t, keep):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return jn.newest_child(t.customer.select("c_custkey"), rows, ("c_custkey", "o_custkey"),
                           ["-o_orderdate", "-o_orderkey"], keep)


@query("newest_order_per_customer", "J-4", _NEWEST.format(how=""))
def _(t):
    return _newest(t, False)


@query("newest_order_or_none", "J-4", _NEWEST.format(how="LEFT"))
def _(t):
    return _newest(t, True)


@query("semi_join_in", "J-5", f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM {_BIG})")
def _(t):
    return (t.customer.join(_big(t), F.col("c_custkey") == F.col("o_custkey"), "left_semi")
            .select("c_custkey", "c_name"))


@query("semi_join_exists", "J-6", """
SELECT c_custkey, c_name FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)""")
def _(t):
    return t.spark.sql("""SELECT c_custkey, c_name FROM {customer} c
        WHERE EXISTS (SELECT 1 FROM {orders} o WHERE o.o_custkey = c.c_custkey)""", customer=t.customer, orders=t.orders)


@query("order_with_customer", "J-7", """
SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey""")
def _(t):
    return (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("o_orderkey", "c_name", "n_name"))


@query("customer_with_orders", "J-8", """
WITH n AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS p
           FROM orders),
l AS (SELECT o_custkey, p // 8 AS part, string_agg(o_orderkey, ',' ORDER BY p) AS orders FROM n GROUP BY 1, 2)
SELECT c_custkey, c_name, coalesce(part, 0) AS part, orders FROM customer LEFT JOIN l ON c_custkey = o_custkey""")
def _(t):
    rows = t.orders.select("o_custkey", "o_orderkey")
    joined = jn.attach_children(t.customer.select("c_custkey", "c_name"), rows, ("c_custkey", "o_custkey"),
                                "o_orderkey", ["o_orderkey"], part_rows=8)
    return joined.select("c_custkey", "c_name", "part", text("values").alias("orders"))


@query("lookup_batch", "J-9", """
SELECT event_id, user_id * 20 AS asked, c_name FROM events LEFT JOIN customer ON user_id * 20 = c_custkey""")
def _(t):
    asked = t.events.select("event_id", (F.col("user_id") * 20).alias("asked"))
    return jn.lookup_batch(asked, t.customer.select("c_custkey", "c_name"), ("asked", "c_custkey"))


@query("customer_dashboard", "J-10", """
WITH recent AS (SELECT o_custkey, string_agg(o_orderkey, ',' ORDER BY rn) AS recent FROM
  (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) rn FROM orders)
  WHERE rn <= 3 GROUP BY 1),
notes AS (SELECT user_id, count(*) AS notifications FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT c_custkey, c_name, n_name, recent, coalesce(notifications, 0) AS notifications
FROM customer JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN recent ON o_custkey = c_custkey LEFT JOIN notes ON user_id = c_custkey""")
def _(t):
    top = top_per_key(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"],
                      ["-o_orderdate", "o_orderkey"], 3)
    recent = top.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("rn", "o_orderkey"))).alias("l"))
    recent = recent.select("o_custkey", text(F.col("l.o_orderkey")).alias("recent"))
    notes = (t.events.filter("event_type = 'error'").groupBy("user_id")
             .agg(F.count(F.lit(1)).alias("notifications")))
    return (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(recent, F.col("c_custkey") == F.col("o_custkey"), "left")
            .join(notes, F.col("c_custkey") == F.col("user_id"), "left")
            .select("c_custkey", "c_name", "n_name", "recent",
                    F.coalesce("notifications", F.lit(0).cast("bigint")).alias("notifications")))


@query("tier_lookup", "J-11", """
WITH tiers AS (SELECT lo, p, lead(lo) OVER (ORDER BY lo) AS hi FROM (VALUES (5.0, 1.0), (10.0, 0.85),
  (25.0, 0.7), (40.0, 0.55)) v(lo, p))
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CAST(p AS DOUBLE) AS tier_price,
       round(l_quantity * CAST(p AS DOUBLE), 6) AS total
FROM lineitem JOIN tiers ON (greatest(l_quantity, 5.0) >= lo AND (hi IS NULL OR greatest(l_quantity, 5.0) < hi))""")
def _(t):
    tiers = t.spark.createDataFrame([(5.0, 1.0), (10.0, 0.85), (25.0, 0.7), (40.0, 0.55)], "lo double, p double")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    priced = jn.tier_lookup(rows, "l_quantity", tiers, "lo", "p")
    return priced.withColumn("total", r(F.col("l_quantity") * F.col("tier_price")))


@query("tier_lookup_large", "J-11", """
WITH tiers AS (SELECT CAST(p_retailprice * 50 AS DOUBLE) AS lo, max(p_partkey) AS p FROM part GROUP BY 1)
SELECT o_orderkey, p AS tier_price FROM (SELECT o_orderkey, greatest(o_totalprice, (SELECT min(lo) FROM tiers)) AS v
FROM orders) ASOF JOIN tiers ON v >= lo""")
def _(t):
    tiers = t.part.groupBy((F.col("p_retailprice") * 50).alias("lo")).agg(F.max("p_partkey").alias("p"))
    return jn.tier_lookup(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", tiers, "lo", "p",
                          limit=0).select("o_orderkey", "tier_price")


@query("positional_join", "J-12", """
SELECT pos, c_custkey, p_partkey FROM
 (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS pos FROM customer)
 JOIN (SELECT p_partkey, row_number() OVER (ORDER BY p_name, p_partkey) AS pos FROM part) USING (pos)""")
def _(t):
    return jn.positional_join(t.customer.select("c_custkey", "c_acctbal"), t.part.select("p_partkey", "p_name"),
                              (["-c_acctbal", "c_custkey"], ["p_name", "p_partkey"])
                              ).select("pos", "c_custkey", "p_partkey")


@query("zip_arrays", "J-12", """
SELECT p_partkey, array_to_string([x[1] || x[2] FOR x IN
  list_zip(string_split(p_name, ' '), string_split(p_type, 'A'), true)], ',') AS zipped FROM part""")
def _(t):
    return t.part.select("p_partkey", text(jn.zip_shortest(F.concat, F.split("p_name", " "),
                                                           F.split("p_type", "A"))).alias("zipped"))


@query("order_view", "J-13", """
SELECT o_orderkey AS order_id, o_custkey AS user_id, c_name AS user_name, o_orderstatus AS status,
       count(l_orderkey) AS item_count, coalesce(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), 0) AS total_amount
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4""")
def _(t):
    orders, users, items = view_inputs(t)
    return jn.order_view(orders, users, items).withColumn("total_amount", F.col("total_amount").cast("double"))


def view_inputs(t):
    orders = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
                             F.col("o_orderstatus").alias("status"))
    users = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name"))
    items = t.lineitem.select(F.col("l_orderkey").alias("order_id"),
                              F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    return orders, users, items
