"""Subqueries, recursion and multiset operations (survey 2.5)."""

from pyspark.sql import functions as F

from tessera.operators import multisets as ms
from tessera.plans.registry import query


@query("cte_recent_groups", "Q-1", """
WITH recent AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT o_orderstatus, count(*) AS n FROM recent GROUP BY o_orderstatus""")
def _(t):
    t.orders.createOrReplaceTempView("tessera_orders")
    return t.spark.sql("""
        WITH recent AS (SELECT * FROM tessera_orders WHERE o_orderdate >= TIMESTAMP_NTZ '1998-01-01')
        SELECT o_orderstatus, count(*) AS n FROM recent GROUP BY o_orderstatus""")


@query("descendants", "Q-2", """
WITH RECURSIVE tree AS (SELECT c_custkey, 0 AS depth FROM customer WHERE c_custkey = 1
  UNION ALL SELECT c.c_custkey, t.depth + 1 FROM customer c JOIN tree t
  ON (c.c_custkey - 1) // 3 = t.c_custkey AND c.c_custkey > 1)
SELECT c_custkey AS node, depth FROM tree""")
def _(t):
    boss = F.when(F.col("c_custkey") > 1, F.floor((F.col("c_custkey") - 1) / 3))
    return ms.descendants(t.customer.select("c_custkey", boss.alias("boss")), "c_custkey", "boss", 1)


@query("distinct_rows", "Q-3", "SELECT DISTINCT p_brand, p_type FROM part")
def _(t):
    return t.part.select("p_brand", "p_type").distinct()


_C = """WITH a AS (SELECT l_partkey AS item, count(*) AS cnt FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
b AS (SELECT l_partkey AS item, count(*) AS cnt FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 20 GROUP BY 1),
f AS (SELECT item, coalesce(a.cnt, 0) AS x, coalesce(b.cnt, 0) AS y FROM a FULL JOIN b USING (item)) """


def _two(t):
    a = ms.frequency(t.lineitem.filter("l_returnflag = 'A'"), "l_partkey")
    b = ms.frequency(t.lineitem.filter("l_returnflag = 'R' AND l_quantity > 20"), "l_partkey")
    return a, b


@query("multiset_sum", "Q-4", _C + "SELECT item, x + y AS cnt FROM f WHERE x + y > 0")
def _(t):
    return ms.add_counts(*_two(t))


@query("multiset_update", "Q-4", _C + "SELECT item, x + y AS cnt FROM f")
def _(t):
    return ms.add_counts(*_two(t), keep_all=True)


@query("multiset_difference", "Q-5", _C + "SELECT item, x - y AS cnt FROM f WHERE x - y > 0")
def _(t):
    return ms.difference(*_two(t))


@query("multiset_subtract", "Q-6", _C + "SELECT item, x - y AS cnt FROM f")
def _(t):
    return ms.subtract_counts(*_two(t))


@query("multiset_intersection", "Q-7", _C + "SELECT item, least(x, y) AS cnt FROM f WHERE least(x, y) > 0")
def _(t):
    return ms.intersection(*_two(t))


@query("multiset_union", "Q-8", _C + "SELECT item, greatest(x, y) AS cnt FROM f")
def _(t):
    return ms.union_counts(*_two(t))


@query("expand_counts", "Q-9", """
WITH c AS (SELECT o_custkey AS item, count(*) - 8 AS cnt FROM orders GROUP BY 1)
SELECT item FROM c, unnest(range(cnt)) WHERE cnt > 0""")
def _(t):
    counts = ms.frequency(t.orders, "o_custkey").withColumn("cnt", F.col("cnt") - 8)
    return ms.expand_counts(counts, slice_rows=4)


@query("layered_lookup", "Q-10", """
WITH d AS (SELECT c_custkey AS key, c_mktsegment AS value FROM customer),
f AS (SELECT o_custkey AS key, CASE WHEN max(o_totalprice) > 490000 THEN 'big' END AS value FROM orders
      WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
e AS (SELECT user_id AS key, max(event_type) AS value FROM events WHERE value > 150 AND user_id IN (SELECT key FROM d) GROUP BY 1)
SELECT key, CAST(layer AS INT) AS layer, value FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY layer) rn FROM
 (SELECT 0 AS layer, * FROM e UNION ALL SELECT 1, * FROM f UNION ALL SELECT 2, * FROM d)) WHERE rn = 1""")
def _(t):
    defaults = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("value"))
    big = F.when(F.max("o_totalprice") > 490000, "big")
    stored = (t.orders.filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("key"))
              .agg(big.alias("value")))
    env = (t.events.filter("value > 150").groupBy(F.col("user_id").alias("key"))
           .agg(F.max("event_type").alias("value")).join(defaults, "key", "left_semi"))
    return ms.first_layer([env, stored, defaults])
