"""Aggregation (survey 2.6)."""

from pyspark.sql import functions as F

from tessera.operators import aggregates as ag
from tessera.operators import multisets as ms
from tessera.operators.ordering import list_parts
from tessera.plans.registry import query, r, text


@query("group_count_having", "G-A1", """
SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12""")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).filter("n > 12")


@query("basic_aggregates", "G-A2", """
SELECT round(avg(c_acctbal), 6) AS avg_bal, count(*) AS n, round(sum(c_acctbal), 4) AS sum_bal,
       max(c_acctbal) AS max_bal, min(c_acctbal) AS min_bal FROM customer""")
def _(t):
    return t.customer.agg(r(F.avg("c_acctbal")).alias("avg_bal"), F.count(F.lit(1)).alias("n"),
                          r(F.sum("c_acctbal"), 4).alias("sum_bal"), F.max("c_acctbal").alias("max_bal"),
                          F.min("c_acctbal").alias("min_bal"))


@query("percentile_whole_table", "G-A3", """
SELECT round(percentile_cont(0.5) WITHIN GROUP (ORDER BY o_totalprice), 6) AS median FROM orders""")
def _(t):
    return ag.percentile_exact(t.orders, [], "o_totalprice", 0.5).select(r("pct").alias("median"))


@query("percentile_per_key", "G-A3", """
SELECT l_returnflag, round(percentile_cont(0.9) WITHIN GROUP (ORDER BY l_extendedprice), 6) AS p90
FROM lineitem GROUP BY 1""")
def _(t):
    return (ag.percentile_exact(t.lineitem, ["l_returnflag"], "l_extendedprice", 0.9)
            .select("l_returnflag", r("pct").alias("p90")))


@query("describe_columns", "G-A4", """
WITH s AS (SELECT count(l_quantity) AS c, avg(l_quantity) AS a, stddev_samp(l_quantity) AS s, min(l_quantity) AS lo,
 max(l_quantity) AS hi FROM lineitem)
SELECT 'count' AS summary, CAST(c AS DOUBLE) AS l_quantity FROM s UNION ALL SELECT 'mean', round(a, 6) FROM s
UNION ALL SELECT 'stddev', round(s, 6) FROM s UNION ALL SELECT 'min', lo FROM s UNION ALL SELECT 'max', hi FROM s""")
def _(t):
    return t.lineitem.select("l_quantity").describe().select(
        "summary", r(F.col("l_quantity").cast("double")).alias("l_quantity"))


@query("frequency_count", "G-A5", "SELECT event_type AS item, count(*) AS cnt FROM events GROUP BY 1")
def _(t):
    return ms.frequency(t.events, "event_type")


@query("character_count", "G-A5", """
SELECT ch AS item, count(*) AS cnt FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> '' GROUP BY 1""")
def _(t):
    chars = t.wide("documents", "text").select(F.explode(F.split("text", "")).alias("ch")).filter("ch <> ''")
    return ms.frequency(chars, "ch")


@query("most_common", "G-A6", """
SELECT user_id, count(*) AS cnt, min(event_id) AS first_pos FROM events GROUP BY 1
ORDER BY cnt DESC, first_pos LIMIT 10""")
def _(t):
    return ag.most_common(t.events, "user_id", "event_id", 10)


@query("least_common", "G-A7", """
SELECT user_id, count(*) AS cnt, min(event_id) AS first_pos FROM events GROUP BY 1
ORDER BY cnt, first_pos DESC LIMIT 3""")
def _(t):
    return ag.most_common(t.events, "user_id", "event_id", 3, least=True)


@query("log_level_histogram", "G-A8", """
SELECT upper(event_type) AS item, count(*) AS cnt FROM events GROUP BY 1""")
def _(t):
    line = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss"),
                       F.upper("event_type"), F.col("props"))
    return ms.frequency(t.events.select(line.alias("line")), F.split("line", r"\s+")[2])


_WORDS = r"""WITH w AS (SELECT {key}, unnest(list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}_]+'),
  lambda x: regexp_full_match(x, '[a-z]+'))) AS word FROM documents) """


@query("text_profile", "G-A9", _WORDS.format(key="lang") + """
SELECT lang, count(*) AS total_words, count(DISTINCT word) AS unique_words,
       round(count(DISTINCT word) / count(*), 6) AS richness FROM w GROUP BY lang""")
def _(t):
    stats, _ = ag.text_profile(t.wide("documents", "lang", "text"), ["lang"], "text")
    return stats.withColumn("richness", r("richness"))


@query("top_content_words", "G-A9", _WORDS.format(key="lang") + """
SELECT lang, word, cnt, rn FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY cnt DESC, word) AS rn FROM
 (SELECT lang, word, count(*) AS cnt FROM w WHERE word NOT IN ('the','is','and','with','are','a','an','in','on','at')
  GROUP BY 1, 2)) WHERE rn <= 5""")
def _(t):
    return ag.text_profile(t.wide("documents", "lang", "text"), ["lang"], "text")[1]


_QUALITY = """WITH s AS (SELECT nullif(event_type, 'error') AS kind, CASE WHEN value < 1 THEN '' ELSE 'v' END AS size FROM events),
p AS (SELECT 'kind' AS field, kind AS value FROM s UNION ALL SELECT 'size', size FROM s) """


def _quality(t):
    rows = t.events.select(F.nullif("event_type", F.lit("error")).alias("kind"),
                           F.when(F.col("value") < 1, "").otherwise("v").alias("size"))
    return ag.quality_profile(rows, ["kind", "size"])


@query("column_values", "G-A10", _QUALITY + "SELECT field, coalesce(value, 'NULL') AS value, count(*) AS cnt FROM p GROUP BY 1, 2")
def _(t):
    return _quality(t)[0]


@query("column_missing", "G-A10", _QUALITY + """
SELECT field, count(*) FILTER (value IS NULL OR value = '') AS missing FROM p GROUP BY 1""")
def _(t):
    return _quality(t)[1]


@query("top_items_per_category", "G-A11", """
WITH c AS (SELECT event_type, user_id, count(*) AS cnt FROM events GROUP BY 1, 2)
SELECT event_type, user_id, cnt, rn, CAST(total AS BIGINT) AS total FROM
 (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY cnt DESC, user_id) AS rn,
         sum(cnt) OVER (PARTITION BY event_type) AS total FROM c) WHERE rn <= 3""")
def _(t):
    return ag.top_items(t.events, "event_type", "user_id", 3)


@query("nested_category_counts", "G-A12", """
WITH c AS (SELECT p_brand, p_type, count(*) AS cnt FROM part GROUP BY 1, 2),
n AS (SELECT *, (row_number() OVER (PARTITION BY p_brand ORDER BY p_type) - 1) // 4 AS part FROM c)
SELECT p_brand, part, string_agg(p_type || '=' || cnt, ',' ORDER BY p_type) AS hits FROM n GROUP BY 1, 2""")
def _(t):
    nested = ag.nested_counts(t.part, "p_brand", "p_type", part_rows=4)
    pairs = F.transform(F.map_entries("hits"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return nested.select("p_brand", "part", text(pairs).alias("hits"))


@query("top_words_per_document", "G-A13", r"""
WITH w AS (SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) - 1 AS loc FROM (SELECT doc_id,
  list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}_]+'), lambda x: regexp_full_match(x, '[a-z]+')) AS l FROM documents))
SELECT doc_id, word, cnt, CAST(first_at AS INT) AS first_at, rn FROM (SELECT *,
  row_number() OVER (PARTITION BY doc_id ORDER BY cnt DESC, first_at) AS rn FROM
 (SELECT doc_id, word, count(*) AS cnt, min(loc) AS first_at FROM w GROUP BY 1, 2)) WHERE rn <= 3""")
def _(t):
    return ag.top_words(t.wide("documents", "doc_id", "text"), "doc_id", "text")


@query("group_into_lists", "G-A14", """
WITH n AS (SELECT c_mktsegment, c_name, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1 AS p FROM customer)
SELECT c_mktsegment, p // 100 AS part, string_agg(c_name, ',' ORDER BY p) AS names FROM n GROUP BY 1, 2""")
def _(t):
    return (list_parts(t.customer, ["c_mktsegment"], "c_name", ["c_custkey"], part_rows=100)
            .select("c_mktsegment", "part", text("values").alias("names")))


@query("group_by_two_keys", "G-A15", """
WITH n AS (SELECT p_brand, p_type, p_partkey, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) - 1 AS p FROM part)
SELECT p_brand, p_type, p // 10 AS part, string_agg(p_partkey, ',' ORDER BY p) AS parts FROM n GROUP BY 1, 2, 3""")
def _(t):
    return (list_parts(t.part, ["p_brand", "p_type"], "p_partkey", ["p_partkey"], part_rows=10)
            .select("p_brand", "p_type", "part", text("values").alias("parts")))


@query("group_into_sets", "G-A16", """
SELECT p_brand, CAST(0 AS BIGINT) AS part, string_agg(p_name, ',' ORDER BY p_name) AS names FROM
 (SELECT DISTINCT p_brand, p_name FROM part) GROUP BY 1""")
def _(t):
    return ag.group_sets(t.part, ["p_brand"], "p_name").select("p_brand", "part", text("values").alias("names"))


@query("nested_hierarchy", "G-A17", """
WITH s AS (SELECT r_name, n_name, c_mktsegment, count(*) AS n, max(c_custkey) AS top FROM customer
 JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3),
b AS (SELECT r_name, n_name, '{' || string_agg('"' || c_mktsegment || '":{"n":' || n || ',"top":' || top || '}', ','
 ORDER BY c_mktsegment) || '}' AS j FROM s GROUP BY 1, 2)
SELECT r_name, '{' || string_agg('"' || n_name || '":' || j, ',' ORDER BY n_name) || '}' AS tree FROM b GROUP BY 1""")
def _(t):
    leaves = (t.customer.groupBy("c_nationkey", "c_mktsegment")
              .agg(F.count(F.lit(1)).alias("n"), F.max("c_custkey").alias("top"))
              .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
              .groupBy("r_name", "n_name", "c_mktsegment").agg(F.sum("n").alias("n"), F.max("top").alias("top")))
    return ag.nest_levels(leaves, ["r_name", "n_name", "c_mktsegment"],
                          F.struct("n", "top"), part_rows=None).withColumn("tree", F.to_json("tree"))


@query("access_log_summary", "G-A18", """
SELECT count(DISTINCT user_id) AS total_unique, count(*) AS total_requests FROM events""")
def _(t):
    return t.events.agg(F.countDistinct("user_id").alias("total_unique"), F.count(F.lit(1)).alias("total_requests"))


@query("latency_stats", "G-A19", """
SELECT event_type, count(value) AS calls, round(sum(value), 4) AS total_time, round(avg(value), 6) AS avg_time,
 min(value) AS min_time, max(value) AS max_time, round(median(value), 6) AS median_time FROM events GROUP BY 1""")
def _(t):
    return (ag.latency_stats(t.events, ["event_type"], "value")
            .withColumn("total_time", r("total_time", 4)).withColumn("avg_time", r("avg_time"))
            .withColumn("median_time", r("median_time")))


@query("folds", "G-A20", """
SELECT l_orderkey, sum(l_quantity) AS total, round(ln(product(l_quantity)), 6) AS product, max(l_quantity) AS largest
FROM lineitem GROUP BY 1""")
def _(t):
    return (ag.folds(t.lineitem, ["l_orderkey"], "l_quantity")
            .withColumn("product", r(F.log("product"))))


@query("fold_text", "G-A20", """
WITH n AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) - 1 AS p FROM lineitem)
SELECT l_orderkey, p // 4 AS part, string_agg(l_partkey, '-' ORDER BY p) AS joined FROM n GROUP BY 1, 2""")
def _(t):
    return (list_parts(t.lineitem, ["l_orderkey"], "l_partkey", ["l_partkey"], part_rows=4)
            .select("l_orderkey", "part", text("values", "-").alias("joined")))


@query("fold_flatten", "G-A20", """
WITH w AS (SELECT p_brand, p_partkey, unnest(string_split(p_name, ' ')) AS word, generate_subscripts(string_split(p_name, ' '), 1) AS loc FROM part),
n AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey, loc) - 1 AS p FROM w)
SELECT p_brand, p // 50 AS part, string_agg(word, ' ' ORDER BY p) AS words FROM n GROUP BY 1, 2""")
def _(t):
    flat = t.part.select("p_brand", "p_partkey", F.posexplode(F.split("p_name", " ")).alias("at", "word"))
    return (list_parts(flat, ["p_brand"], "word", ["p_partkey", "at"], part_rows=50)
            .select("p_brand", "part", text("values", " ").alias("words")))


@query("nested_array_max", "G-A21", """
SELECT doc_id, CAST(list_max(list_transform(string_split(text, ' '), lambda w: length(w))) AS INT) AS longest FROM documents""")
def _(t):
    words = F.transform(F.split("text", " "), lambda w: F.struct(w.alias("name"), F.length(w).alias("score")))
    scores = t.wide("documents", "doc_id", "text").select("doc_id", words.alias("users"))
    return scores.select("doc_id", F.array_max(F.transform("users", lambda u: u["score"])).alias("longest"))


@query("health_rollup", "G-A22", """
WITH s AS (SELECT s_nationkey, CASE WHEN s_acctbal > 4000 THEN 'healthy' WHEN s_acctbal < 0 THEN 'unhealthy'
  ELSE 'degraded' END AS status FROM supplier)
SELECT s_nationkey, CASE WHEN bool_and(status = 'healthy') THEN 'healthy' WHEN bool_or(status = 'unhealthy')
  THEN 'unhealthy' ELSE 'degraded' END AS overall FROM s GROUP BY 1""")
def _(t):
    status = (F.when(F.col("s_acctbal") > 4000, "healthy").when(F.col("s_acctbal") < 0, "unhealthy")
              .otherwise("degraded"))
    return ag.health(t.supplier.withColumn("status", status), ["s_nationkey"], "status")


@query("parity_split", "G-A23", """
WITH n AS (SELECT o_orderkey % 2 AS parity, o_orderkey, row_number() OVER (PARTITION BY o_orderkey % 2 ORDER BY o_orderkey) - 1 AS p FROM orders)
SELECT parity, p // 500 AS part, string_agg(o_orderkey, ',' ORDER BY p) AS keys FROM n GROUP BY 1, 2""")
def _(t):
    rows = t.orders.select("o_orderkey", F.pmod("o_orderkey", F.lit(2)).alias("parity"))
    return (list_parts(rows, ["parity"], "o_orderkey", ["o_orderkey"], part_rows=500)
            .select("parity", "part", text("values").alias("keys")))


@query("sum_of_squares", "G-A24", """
SELECT CAST(sum(CAST(l_orderkey AS HUGEINT) * l_orderkey) AS VARCHAR) AS total FROM lineitem""")
def _(t):
    return ag.sum_of_squares(t.lineitem, "l_orderkey").select(F.col("total").cast("string").alias("total"))


@query("hit_rate", "G-A25", """
SELECT user_id, count(*) FILTER (value < 20) AS hits, count(*) FILTER (value >= 20) AS misses,
 round(count(*) FILTER (value < 20) / count(*), 6) AS hit_rate FROM events GROUP BY 1""")
def _(t):
    return ag.hit_rate(t.events, ["user_id"], F.col("value") < 20).withColumn("hit_rate", r("hit_rate"))
