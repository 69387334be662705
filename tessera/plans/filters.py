"""Projection, filters and predicates (survey 2.3)."""

from pyspark.sql import functions as F

from tessera.operators import filters as fl
from tessera.plans.registry import query, r


@query("project_columns", "P-1", "SELECT c_custkey, c_name FROM customer")
def _(t):
    return t.customer.select("c_custkey", "c_name")


@query("derived_columns", "P-2", """
SELECT c_custkey, upper(c_mktsegment) AS segment_upper,
       CASE WHEN c_acctbal >= 5000 THEN 'A' ELSE 'B' END AS grade FROM customer""")
def _(t):
    return t.customer.select("c_custkey", F.upper("c_mktsegment").alias("segment_upper"),
                             F.when(F.col("c_acctbal") >= 5000, "A").otherwise("B").alias("grade"))


@query("filter_and", "P-3", "SELECT * FROM part WHERE p_size >= 18 AND p_type = 'SMALL'")
def _(t):
    return t.part.filter((F.col("p_size") >= 18) & (F.col("p_type") == "SMALL"))


@query("filter_between", "P-4", "SELECT * FROM part WHERE p_size BETWEEN 10 AND 20")
def _(t):
    return t.part.filter(F.col("p_size").between(10, 20))


@query("filter_text_patterns", "P-5", """
SELECT p_partkey, p_name FROM part
WHERE p_name LIKE '%bolt' OR starts_with(p_name, 'red') OR suffix(p_name, 'gear') OR contains(p_name, 'l r')""")
def _(t):
    name = F.col("p_name")
    return t.part.filter(name.like("%bolt") | name.startswith("red") | name.endswith("gear")
                         | name.contains("l r")).select("p_partkey", "p_name")


@query("filter_regex", "P-6", r"""
SELECT page_id, url FROM pages WHERE regexp_matches(url, '^https://[^/]+\.org/[a-z]+(/.*)?$')""")
def _(t):
    return t.pages.filter(F.col("url").rlike(r"^https://[^/]+\.org/[a-z]+(/.*)?$")).select("page_id", "url")


@query("filter_open_range_first", "P-7", """
SELECT p_partkey, p_size FROM part WHERE p_size > 20 AND p_size < 23 ORDER BY p_partkey LIMIT 3""")
def _(t):
    size = F.col("p_size")
    return t.part.filter((size > 20) & (size < 23)).orderBy("p_partkey").limit(3).select("p_partkey", "p_size")


@query("filter_nested_path", "P-8", """
SELECT p_partkey, p_name FROM part WHERE (CASE WHEN p_size > 25 THEN p_type = 'PROMO' END) = true""")
def _(t):
    card = F.when(F.col("p_size") > 25, F.struct((F.col("p_type") == "PROMO").alias("promo")))
    return (t.part.withColumn("card", card).filter(F.col("card.promo") == F.lit(True))
            .select("p_partkey", "p_name"))


@query("lookup_by_id", "P-9", """
SELECT * FROM orders WHERE o_orderkey = 77 UNION ALL SELECT * FROM orders WHERE o_orderkey IN (5, 9, 123456789)""")
def _(t):
    key = F.col("o_orderkey")
    return t.orders.filter(key == 77).unionByName(t.orders.filter(key.isin(5, 9, 123456789)))


@query("filter_truthy", "P-10", """
SELECT l_orderkey, l_linenumber, l_partkey, l_discount FROM lineitem
WHERE l_discount IS NOT NULL AND l_discount <> 0 AND nullif(l_returnflag, 'N') IS NOT NULL
  AND nullif(l_linestatus, 'O') IS NOT NULL""")
def _(t):
    rows = (t.lineitem.withColumn("flag", F.nullif("l_returnflag", F.lit("N")))
            .withColumn("open", F.regexp_replace("l_linestatus", "O", "")))
    return (rows.filter(fl.truthy(rows, "l_discount") & fl.truthy(rows, "flag") & fl.truthy(rows, "open"))
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_discount"))


@query("parity_and_sign", "P-11", """
SELECT c_custkey, ((CAST(floor(c_acctbal) AS BIGINT) % 2) + 2) % 2 AS parity,
       CASE WHEN c_acctbal > 0 THEN 'Positive' ELSE 'Negative' END AS class,
       CAST(sign(c_acctbal) AS INT) AS sgn, c_acctbal >= 40 AS passed FROM customer""")
def _(t):
    bal = F.col("c_acctbal")
    return t.customer.select("c_custkey", fl.parity(F.floor(bal)).alias("parity"),
                             F.when(bal > 0, "Positive").otherwise("Negative").alias("class"),
                             F.signum(bal).cast("int").alias("sgn"), (bal >= 40).alias("passed"))


@query("filter_primes", "P-12", """
SELECT o_orderkey FROM orders WHERE o_orderkey >= 2 AND NOT list_bool_or(
  list_transform(range(2, CAST(floor(sqrt(o_orderkey)) AS BIGINT) + 1), lambda i: o_orderkey % i = 0)) IS TRUE""")
def _(t):
    return t.orders.filter(fl.is_prime(F.col("o_orderkey"))).select("o_orderkey")


@query("filter_array_member", "P-13", """
SELECT p_partkey FROM part WHERE list_contains(string_split(p_name, ' '), 'red')""")
def _(t):
    return t.part.filter(F.array_contains(F.split("p_name", " "), "red")).select("p_partkey")


@query("unique_keep_first", "P-14", """
SELECT p_brand, p_type, min(p_partkey) AS p_partkey, arg_min(p_name, p_partkey) AS p_name
FROM part GROUP BY p_brand, p_type""")
def _(t):
    rows = t.part.select("p_brand", "p_type", "p_partkey", "p_name")
    return fl.unique_first(rows, ["p_brand", "p_type"], "p_partkey")


@query("validate_ranges", "P-15", """
SELECT c_custkey, c_acctbal > 0 AND c_acctbal < 1000000 AS salary_ok, c_acctbal >= 0 AS number_ok,
       c_mktsegment IN ('BUILDING', 'MACHINERY') AS value_ok FROM customer""")
def _(t):
    bal = F.col("c_acctbal")
    return t.customer.select("c_custkey", ((bal > 0) & (bal < 1000000)).alias("salary_ok"),
                             (bal >= 0).alias("number_ok"),
                             F.col("c_mktsegment").isin("BUILDING", "MACHINERY").alias("value_ok"))


_FIRST_FAIL = """
WITH e AS (SELECT user_id, event_id, value FROM events),
f AS (SELECT user_id, min(event_id) AS bad FROM e WHERE NOT value < 60 GROUP BY user_id)
SELECT e.user_id, e.event_id, e.value FROM e LEFT JOIN f USING (user_id) """


@query("take_while", "P-16", _FIRST_FAIL + "WHERE bad IS NULL OR event_id < bad")
def _(t):
    return fl.take_while(t.events.select("user_id", "event_id", "value"), ["user_id"], ["event_id"],
                         F.col("value") < 60)


@query("drop_while", "P-16", _FIRST_FAIL + "WHERE event_id >= bad")
def _(t):
    return fl.drop_while(t.events.select("user_id", "event_id", "value"), ["user_id"], ["event_id"],
                         F.col("value") < 60)


@query("drop_while_whole_table", "P-16", """
SELECT o_orderkey FROM orders WHERE o_orderkey >=
  (SELECT min(o_orderkey) FROM orders WHERE NOT o_totalprice < 490000)""")
def _(t):
    return fl.drop_while(t.orders.select("o_orderkey", "o_totalprice"), [], ["o_orderkey"],
                         F.col("o_totalprice") < 490000).select("o_orderkey")


@query("gate_batches", "P-17", """
WITH l AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM conversations),
bad AS (SELECT DISTINCT conv_id, turn FROM l WHERE NOT contains(line, ','))
SELECT conv_id, turn, count(*) AS saved, CAST(sum(length(upper(replace(line, 'ß', 'ss')))) AS BIGINT) AS chars
FROM l ANTI JOIN bad USING (conv_id, turn) GROUP BY conv_id, turn""")
def _(t):
    lines = t.conversations.select("conv_id", "turn", F.explode(F.split("text", "\n")).alias("line"))
    kept, _ = fl.process_lines(lines, ["conv_id", "turn"], "line", fl.CSV_RULE)
    return kept.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("saved"),
                                               F.sum(F.length("line")).alias("chars"))


@query("gate_json_batches", "P-17", """
SELECT event_type, event_id, replace(props, '{', '{' || chr(10) || '  ') AS props FROM events""")
def _(t):
    rows = t.events.select("event_type", "event_id", "props")
    kept, _ = fl.process_lines(rows, ["event_type"], "props", fl.JSON_RULE)
    return kept


@query("url_policy", "P-18", r"""
SELECT page_id, CASE WHEN lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) <> 'https' THEN 'scheme'
  WHEN regexp_extract(url, '^https://([^/?#:]*)', 1) IN ('169.254.169.254', 'metadata.google.internal') THEN 'host'
  WHEN regexp_matches(url, '^https://(10|127|192\.168|169\.254)\.') THEN 'private' ELSE 'ok' END AS verdict FROM pages""")
def _(t):
    return fl.url_verdict(t.pages.select("page_id", "url"), "url").select("page_id", "verdict")
