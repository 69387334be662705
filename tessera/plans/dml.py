"""Table definition, integrity and copy-on-write DML (survey 2.2 and 2.9)."""

from pyspark.sql import functions as F

from tessera.operators import dml, integrity as it
from tessera.plans.registry import query, r


@query("add_column_default", "D-2", "SELECT c_custkey, 'active' AS status, CAST(NULL AS DOUBLE) AS score FROM customer")
def _(t):
    return t.customer.select("c_custkey").withColumn("status", F.lit("active")).withColumn(
        "score", F.lit(None).cast("double"))


@query("drop_rename_column", "D-3", "SELECT s_suppkey, s_name AS supplier, s_acctbal FROM supplier")
def _(t):
    return t.supplier.drop("s_nationkey").withColumnRenamed("s_name", "supplier")


@query("identity_key", "D-4", """
SELECT c_custkey, 99 + row_number() OVER (ORDER BY c_name, c_custkey) AS id FROM customer""")
def _(t):
    return it.identity_key(t.customer.select("c_custkey", "c_name"), ["c_name", "c_custkey"], start=100).drop("c_name")


@query("identity_key_hot", "D-4", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS id FROM orders""")
def _(t):
    return it.identity_key(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"],
                           hot_rows=1000).drop("o_totalprice")


@query("audit_not_null", "A-CON1", "SELECT * FROM (SELECT p_partkey, nullif(p_type, 'PROMO') AS p_type FROM part) WHERE p_type IS NULL")
def _(t):
    rows = t.part.select("p_partkey", F.nullif("p_type", F.lit("PROMO")).alias("p_type"))
    return it.null_violations(rows, ["p_partkey", "p_type"])


@query("audit_unique", "A-CON2", "SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(t):
    return it.unique_violations(t.lineitem, {"l_orderkey": F.col("l_orderkey"), "l_linenumber": F.col("l_linenumber")})


@query("audit_unique_expression", "A-CON2", "SELECT lower(p_name) AS name, count(*) AS cnt FROM part GROUP BY 1 HAVING count(*) > 1")
def _(t):
    return it.unique_violations(t.part, {"name": F.lower("p_name")})


@query("audit_foreign_key", "A-CON3", """
SELECT l_orderkey, l_partkey FROM lineitem ANTI JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey""")
def _(t):
    return it.foreign_key_violations(t.lineitem.select("l_orderkey", "l_partkey"),
                                     t.orders.filter("o_orderstatus <> 'P'"), ("l_orderkey", "o_orderkey"))


@query("audit_check", "A-CON4", "SELECT c_custkey, c_acctbal FROM customer WHERE NOT c_acctbal >= 0")
def _(t):
    return it.check_violations(t.customer.select("c_custkey", "c_acctbal"), F.col("c_acctbal") >= 0)


@query("row_policy", "D-5", "SELECT * FROM orders WHERE o_custkey = 37")
def _(t):
    return it.own_rows(t.orders, "o_custkey", 37)


@query("role_gate", "D-6", """
SELECT conv_id, turn, role, CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 WHEN 'system' THEN -1 END >= 1 AS allowed FROM conversations""")
def _(t):
    named = F.when(F.col("role") == "user", "viewer").when(F.col("role") == "assistant", "editor").otherwise(F.col("role"))
    return t.conversations.select("conv_id", "turn", "role", it.has_role(named, "editor").alias("allowed"))


@query("insert_rows", "M-1", """
SELECT c_custkey, c_name, c_acctbal FROM customer UNION ALL
SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey), s_name, s_acctbal FROM supplier""")
def _(t):
    new = t.supplier.select(F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal"), "s_suppkey")
    return dml.insert(t.customer.select("c_custkey", "c_name", "c_acctbal"), new, "c_custkey", ["s_suppkey"])[0]


@query("insert_select", "M-2", """
SELECT * FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'P'""")
def _(t):
    return dml.insert_select(t.orders.filter("o_orderstatus = 'F'"), t.orders, F.col("o_orderstatus") == "P")[0]


@query("upsert", "M-3", """
WITH s AS (SELECT s_suppkey * 30 AS c_custkey, s_name AS c_name, s_acctbal AS c_acctbal FROM supplier)
SELECT coalesce(c.c_custkey, s.c_custkey) AS c_custkey, coalesce(s.c_name, c.c_name) AS c_name,
 CASE WHEN c.c_custkey IS NULL THEN s.c_acctbal ELSE c.c_acctbal END AS c_acctbal FROM customer c FULL JOIN s ON c.c_custkey = s.c_custkey""")
def _(t):
    new = t.supplier.select((F.col("s_suppkey") * 30).alias("c_custkey"), F.col("s_name").alias("c_name"),
                            F.col("s_acctbal").alias("c_acctbal"))
    return dml.upsert(t.customer.select("c_custkey", "c_name", "c_acctbal"), new, "c_custkey", ["c_name"])[0]


@query("merge_amounts", "M-4", """
WITH s AS (SELECT o_custkey + 5 AS k, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT coalesce(c_custkey, k) AS c_custkey, CAST(coalesce(CAST(c_acctbal AS DECIMAL(18,2)), 0) + coalesce(amount, 0) AS DOUBLE) AS c_acctbal
FROM customer FULL JOIN s ON c_custkey = k""")
def _(t):
    source = (t.orders.filter("o_orderstatus = 'P'").groupBy((F.col("o_custkey") + 5).alias("c_custkey"))
              .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount")))
    target = t.customer.select("c_custkey", F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"))
    out = dml.merge_amounts(target, source, "c_custkey", "c_acctbal", "amount")[0]
    return out.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("update_where", "M-5", """
SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def _(t):
    return dml.update(t.orders, F.col("o_totalprice") > 400000, {"o_orderstatus": F.lit("X")})[0].select(
        "o_orderkey", "o_orderstatus")


@query("update_affected", "M-5", "SELECT count(*) AS affected FROM orders WHERE o_totalprice > 400000")
def _(t):
    return dml.update(t.orders, F.col("o_totalprice") > 400000, {"o_orderstatus": F.lit("X")})[1].agg(
        F.count(F.lit(1)).alias("affected"))


@query("update_from_join", "M-6", """
SELECT c_custkey, CASE WHEN n_nationkey IS NOT NULL THEN nullif(n_name, 'NATION_7') ELSE c_mktsegment END AS c_mktsegment
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey""")
def _(t):
    src = t.nation.filter("n_regionkey < 3").withColumn("n_name", F.nullif("n_name", F.lit("NATION_7")))
    return dml.update_from(t.customer, src, ("c_nationkey", "n_nationkey"), {"c_mktsegment": "n_name"})[0].select(
        "c_custkey", "c_mktsegment")


@query("delete_older", "M-7", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS login FROM orders)
SELECT * FROM o WHERE login IS NULL OR login >= TIMESTAMP '2001-01-01' - INTERVAL 1 YEAR""")
def _(t):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("login"))
    now = F.lit("2001-01-01").cast("timestamp_ntz")
    return dml.delete(rows, F.col("login") < now - F.expr("INTERVAL 1 YEAR"))[0]


@query("delete_using", "M-8", """
SELECT o_orderkey FROM orders ANTI JOIN (SELECT * FROM customer WHERE c_acctbal < 0) ON o_custkey = c_custkey""")
def _(t):
    return dml.delete_using(t.orders, t.customer.filter("c_acctbal < 0"), ("o_custkey", "c_custkey"))[0].select("o_orderkey")


@query("update_all_nested", "M-9", """
SELECT p_partkey, p_type AS kind, true AS checked, 'a,b' AS tags FROM part""")
def _(t):
    docs = t.part.select("p_partkey", F.struct(F.col("p_type").alias("kind"), F.lit(False).alias("checked")).alias("card"))
    new, _ = dml.update(docs, F.lit(True), {"card": dml.set_path("card", "checked", F.lit(True))})
    new = new.withColumn("tags", F.array(F.lit("a"), F.lit("b")))
    return new.select("p_partkey", "card.kind", "card.checked", F.array_join("tags", ",").alias("tags"))


@query("update_first_match", "M-9", """
WITH f AS (SELECT p_partkey FROM part WHERE p_type = 'PROMO' ORDER BY p_size, p_partkey LIMIT 1)
SELECT p_partkey, CASE WHEN p_partkey IN (SELECT * FROM f) THEN 'first' ELSE p_type END AS p_type FROM part""")
def _(t):
    return dml.update_first(t.part.select("p_partkey", "p_type", "p_size"), F.col("p_type") == "PROMO",
                            ["p_size", "p_partkey"], {"p_type": F.lit("first")})[0].drop("p_size")


_MOVES = """
WITH m AS (SELECT s_suppkey AS seq, s_suppkey * 2 AS src, s_suppkey * 2 + 1 AS dst, CAST(2500 AS DECIMAL(18,2)) AS qty FROM supplier),
a AS (SELECT c_custkey AS k, CAST(c_acctbal AS DECIMAL(18,2)) AS b FROM customer),
g AS (SELECT m.* FROM m JOIN a ON src = k WHERE b >= qty AND dst IN (SELECT k FROM a)),
d AS (SELECT k, sum(x) AS x FROM (SELECT src AS k, -qty AS x FROM g UNION ALL SELECT dst, qty FROM g) GROUP BY 1) """


def moves(t):
    key = F.col("s_suppkey")
    return (t.supplier.select(key.alias("seq"), (key * 2).alias("src"), (key * 2 + 1).alias("dst"),
                              F.lit(2500).cast("decimal(18,2)").alias("qty")),
            t.customer.select("c_custkey", F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal")))


@query("paired_transfer", "M-10", _MOVES + """
SELECT a.k AS c_custkey, CAST(b + coalesce(x, 0) AS DOUBLE) AS c_acctbal FROM a LEFT JOIN d USING (k)""")
def _(t):
    batch, accounts = moves(t)
    out = dml.transfer(accounts, batch, "c_custkey", "c_acctbal")[0]
    return out.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("paired_transfer_one_source", "M-10", """
WITH RECURSIVE m AS (SELECT c_custkey AS seq, CAST(abs(c_acctbal) / 100 AS DECIMAL(18,2)) AS qty,
 row_number() OVER (ORDER BY c_custkey) AS p FROM customer),
s AS (SELECT 0::BIGINT AS p, 0::BIGINT AS seq, CAST(5000 AS DECIMAL(18,2)) AS b, false AS done UNION ALL
 SELECT m.p, m.seq, CASE WHEN s.b >= m.qty AND m.seq <> 1 THEN CAST(s.b - m.qty AS DECIMAL(18,2)) ELSE s.b END, s.b >= m.qty
 FROM s JOIN m ON m.p = s.p + 1)
SELECT seq, done FROM s WHERE p > 0""")
def _(t):
    """A move from customer 1, who holds 5,000, to every customer."""
    key = F.col("c_custkey")
    accounts = t.customer.select(key, F.when(key == 1, 5000).otherwise(F.col("c_acctbal")).cast("decimal(18,2)").alias("c_acctbal"))
    batch = t.customer.select(key.alias("seq"), F.lit(1).cast("bigint").alias("src"), key.alias("dst"),
                              (F.abs("c_acctbal") / 100).cast("decimal(18,2)").alias("qty"))
    return dml.transfer(accounts, batch, "c_custkey", "c_acctbal")[1].select("seq", "done")


@query("patch_allowed", "M-11", """
SELECT c_custkey, CASE WHEN s_acctbal > 4000 THEN s_name ELSE c_name END AS c_name, c_acctbal
FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""")
def _(t):
    changes = t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"),
                                (F.col("s_acctbal") > 4000).alias("c_name_sent"),
                                F.lit(0.0).alias("c_acctbal"), F.lit(True).alias("c_acctbal_sent"))
    return dml.patch(t.customer.select("c_custkey", "c_name", "c_acctbal"), changes, "c_custkey", ["c_name"])[0]


@query("percentage_raise", "M-12", """
SELECT c_custkey, round(c_acctbal * (1 + 7.5 / 100), 6) AS raised, round(c_acctbal * 12, 6) AS annual FROM customer""")
def _(t):
    rows = t.customer.select("c_custkey", F.col("c_acctbal").alias("raised"), r(F.col("c_acctbal") * 12).alias("annual"))
    new, _ = dml.update(rows, F.lit(True), {"raised": F.col("raised") * (1 + 7.5 / 100)})
    return new.withColumn("raised", r("raised"))
