"""Scalar functions (survey 2.10)."""

from pyspark.sql import functions as F

from tessera.functions import arrays as ar
from tessera.functions import dates as dt
from tessera.functions import documents as dc
from tessera.functions import numbers as nm
from tessera.functions import strings as st
from tessera.plans.registry import query, r, text


@query("string_functions", "F-1", """
SELECT p_partkey, p_name || '-' || p_brand AS joined, length(p_name) AS n, lower(p_brand) AS low,
 substring(p_name, 2, 4) AS part, replace(p_name, ' ', '_') AS snake FROM part""")
def _(t):
    return t.part.select("p_partkey", F.concat_ws("-", "p_name", "p_brand").alias("joined"),
                         F.length("p_name").alias("n"), F.lower("p_brand").alias("low"),
                         F.substring("p_name", 2, 4).alias("part"),
                         F.replace("p_name", F.lit(" "), F.lit("_")).alias("snake"))


@query("text_methods", "F-2", """
SELECT p_partkey, upper(p_name) AS up, trim('  ' || p_name || ' ') AS stripped,
 upper(left(p_brand, 1)) || lower(substring(p_brand, 2)) AS cap, nullif(left(replace(p_name, 'red bolt', ''), 1), '') AS first,
 reverse(p_name) AS back, p_name || p_type AS pair FROM part""")
def _(t):
    name = F.col("p_name")
    return t.part.select("p_partkey", F.upper(name).alias("up"),
                         st.strip(F.concat(F.lit(" \t"), name, F.lit(" \r\n"))).alias("stripped"),
                         st.capitalize(F.col("p_brand")).alias("cap"),
                         st.first_char(F.replace(name, F.lit("red bolt"), F.lit(""))).alias("first"),
                         F.reverse(name).alias("back"), F.concat(name, "p_type").alias("pair"))


@query("palindromes", "F-3", r"""
SELECT o_orderkey, regexp_replace(lower(o_orderkey || ' ' || o_orderstatus), '[^\p{L}\p{N}]', '', 'g') =
 reverse(regexp_replace(lower(o_orderkey || ' ' || o_orderstatus), '[^\p{L}\p{N}]', '', 'g')) AS mixed,
 CAST(o_orderkey AS VARCHAR) = reverse(CAST(o_orderkey AS VARCHAR)) AS plain FROM orders""")
def _(t):
    key = F.col("o_orderkey").cast("string")
    return t.orders.select("o_orderkey", st.is_palindrome(F.concat_ws(" ", key, "o_orderstatus")).alias("mixed"),
                           st.is_palindrome(F.concat(F.lit("- "), key, F.lit("!"))).alias("plain"))


@query("vowels", "F-4", """
SELECT doc_id, length(regexp_replace(lower(text), '[^aeiou]', '', 'g')) AS vowels FROM documents""")
def _(t):
    return t.documents.select("doc_id", F.length(st.keep_chars(F.lower("text"), "aeiou")).alias("vowels"))


@query("formatted_text", "F-5", """
SELECT p_partkey, p_name || ' (' || p_size || ') - Grade ' || p_brand || ' - ' || p_type AS line FROM part""")
def _(t):
    return t.part.select("p_partkey", st.person_line(F.col("p_name"), F.col("p_size"), F.col("p_brand"),
                                                     F.col("p_type")).alias("line"))


@query("date_functions", "F-6", """
WITH a AS (SELECT *, age(TIMESTAMP '2003-05-15', CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) AS a FROM orders)
SELECT o_orderkey, date_trunc('month', o_orderdate) AS month, CAST(extract(dow FROM o_orderdate) AS INT) AS dow,
 CAST(extract(year FROM a) AS INT) AS years, CAST(extract(month FROM a) AS INT) AS months, CAST(extract(day FROM a) AS INT) AS days FROM a""")
def _(t):
    span = dt.age(F.lit("2003-05-15"), F.col("o_orderdate"))
    return (t.orders.select("o_orderkey", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month"),
                            (F.dayofweek("o_orderdate") - 1).alias("dow"), span.alias("a"))
            .select("o_orderkey", "month", "dow", "a.years", "a.months", "a.days"))


@query("conditionals", "F-7", """
SELECT p_partkey, coalesce(nullif(p_type, 'PROMO'), 'none') AS kind, CASE WHEN p_size > 30 THEN 'large'
 WHEN p_size > 10 THEN 'medium' ELSE 'small' END AS size FROM part""")
def _(t):
    size = F.col("p_size")
    return t.part.select("p_partkey", F.coalesce(F.nullif("p_type", F.lit("PROMO")), F.lit("none")).alias("kind"),
                         F.when(size > 30, "large").when(size > 10, "medium").otherwise("small").alias("size"))


@query("grade_bands", "F-8", """
SELECT l_orderkey, l_partkey, CASE WHEN l_quantity * 2 >= 90 THEN 'A' WHEN l_quantity * 2 >= 80 THEN 'B' ELSE 'C' END AS grade FROM lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_partkey", nm.grade(F.col("l_quantity") * 2).alias("grade"))


@query("casts", "F-9", """
SELECT p_partkey, CAST(substring(p_brand, 7) AS INT) AS brand_no, TRY_CAST(p_name AS INT) AS bad, CAST(p_size AS VARCHAR) AS size,
 CAST(p_size AS BOOLEAN) AS truth FROM part""")
def _(t):
    return t.part.select("p_partkey", F.substr("p_brand", F.lit(7)).cast("int").alias("brand_no"),
                         F.col("p_name").try_cast("int").alias("bad"), F.col("p_size").cast("string").alias("size"),
                         F.col("p_size").cast("boolean").alias("truth"))


@query("math_functions", "F-10", """
SELECT p_partkey, p_size * p_size AS square, CAST(pow(p_size, 3) AS DOUBLE) AS cube, round_even(p_retailprice, 0) AS rounded,
 round(p_retailprice * 9 / 5 + 32, 6) AS fahrenheit, CAST(factorial(p_size % 21) AS VARCHAR) AS fact, p_size * 3 + 1 AS line,
 CAST(pow(p_size, 2) + pow(2, p_size) AS DOUBLE) AS mixed FROM part""")
def _(t):
    size = F.col("p_size")
    return t.part.select("p_partkey", (size * size).alias("square"), F.pow(size, F.lit(3)).alias("cube"),
                         F.bround("p_retailprice", 0).alias("rounded"),
                         r(nm.fahrenheit(F.col("p_retailprice"))).alias("fahrenheit"),
                         nm.factorial(size % 21).cast("string").alias("fact"), (size * 3 + 1).alias("line"),
                         (F.pow(size, F.lit(2)) + F.pow(F.lit(2), size)).alias("mixed"))


_DOC = """WITH docs AS (SELECT p_partkey, json_object('brand', p_brand, 'category', json_object('main', p_type, 'sub', split_part(p_name, ' ', 2)),
 'price', p_retailprice, 'stock', p_size, 'attributes', json_object('color', split_part(p_name, ' ', 1), 'small', p_size < 10),
 'tags', to_json(string_split(p_name, ' '))) AS doc FROM part) """


def docs(t):
    name = F.split("p_name", " ")
    return t.part.select("p_partkey", F.to_json(F.struct(
        F.col("p_brand").alias("brand"), F.struct(F.col("p_type").alias("main"), name[1].alias("sub")).alias("category"),
        F.col("p_retailprice").alias("price"), F.col("p_size").alias("stock"),
        F.struct(name[0].alias("color"), (F.col("p_size") < 10).alias("small")).alias("attributes"),
        name.alias("tags"))).alias("doc"))


@query("json_get", "F-11", _DOC + """
SELECT p_partkey, CAST(doc->'$.brand' AS VARCHAR) AS brand_json, doc->>'$.brand' AS brand, doc->>'$.category.sub' AS sub,
 doc->>'$.attributes.size' AS missing FROM docs""")
def _(t):
    doc = F.col("doc")
    return docs(t).select("p_partkey", dc.get_json(doc, "$.brand").alias("brand_json"),
                          dc.get_text(doc, "$.brand").alias("brand"), dc.get_text(doc, "$.category.sub").alias("sub"),
                          dc.get_text(doc, "$.attributes.size").alias("missing"))


@query("json_elements", "F-12", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tag FROM part")
def _(t):
    rows = docs(t).select("p_partkey", F.explode(dc.elements(F.col("doc"), "$.tags")).alias("v"))
    return rows.select("p_partkey", F.col("v").cast("string").alias("tag"))


@query("json_contains", "F-13", _DOC + """
SELECT p_partkey FROM docs WHERE json_contains(doc, '{"tags": ["red"], "category": {"main": "PROMO"}}')
UNION ALL SELECT p_partkey FROM docs WHERE json_contains(doc, '{"attributes": {"small": true}}')""")
def _(t):
    doc = F.col("doc")
    rows = docs(t)
    return (rows.filter(dc.contains(doc, '{"tags": ["red"], "category": {"main": "PROMO"}}')).select("p_partkey")
            .unionByName(rows.filter(dc.contains(doc, {"attributes": {"small": True}})).select("p_partkey")))


@query("json_exists", "F-14", """
SELECT p_partkey, list_contains(string_split(p_name, ' '), 'gear') AS tagged, true AS has_brand, false AS has_colour FROM part""")
def _(t):
    doc = F.col("doc")
    return docs(t).select("p_partkey", dc.has_key(doc, "gear", "$.tags").alias("tagged"),
                          dc.has_key(doc, "brand").alias("has_brand"), dc.has_key(doc, "colour").alias("has_colour"))


@query("json_path_test", "F-15", _DOC + """
SELECT p_partkey, coalesce(doc->>'$.attributes.color' = 'blue', false) AS blue, CAST(doc->>'$.price' AS DOUBLE) < 950 AS cheap,
 CAST(doc->>'$.stock' AS INT) >= 25 AS stocked, false AS typed FROM docs""")
def _(t):
    doc = F.col("doc")
    return docs(t).select("p_partkey", dc.path_is(doc, '$.attributes.color == "blue"').alias("blue"),
                          dc.path_is(doc, "$.price < 950").alias("cheap"), dc.path_is(doc, "$.stock >= 25").alias("stocked"),
                          dc.path_is(doc, '$.stock == "25"').alias("typed"))


@query("json_number_filter", "F-16", "SELECT event_id FROM events WHERE CAST(props->>'$.k' AS INT) < 40")
def _(t):
    return t.events.filter(dc.get_text(F.col("props"), "$.k").cast("int") < 40).select("event_id")


@query("array_functions", "F-17", """
SELECT p_partkey, list_has_all(string_split(p_name, ' '), ['red']) AS has_red, unnest([p_size, p_size + 1]) AS n FROM part""")
def _(t):
    return t.part.select("p_partkey", ar.contains_all(F.split("p_name", " "), F.array(F.lit("red"))).alias("has_red"),
                         F.explode(F.array(F.col("p_size"), F.col("p_size") + 1)).alias("n"))


@query("nested_comprehension", "F-18", """
SELECT p_partkey, array_to_string([CASE WHEN x % 2 = 0 THEN 'even' ELSE 'odd' END FOR x IN flatten([[p_size, p_partkey], [p_size + 1]])], ',') AS labels FROM part""")
def _(t):
    size = F.col("p_size").cast("bigint")
    flat = F.flatten(F.array(F.array(size, F.col("p_partkey")), F.array(size + 1)))
    return t.part.select("p_partkey", text(F.transform(flat, lambda x: F.when(x % 2 == 0, "even").otherwise("odd"))).alias("labels"))


@query("map_filter_compose", "F-19", """
SELECT p_partkey, array_to_string([x * x FOR x IN range(CAST(p_size AS BIGINT)) IF x % 2 = 0], ',') AS squares,
 CAST(((p_size + 1) * 2) * ((p_size + 1) * 2) AS BIGINT) AS composed FROM part""")
def _(t):
    size = F.col("p_size").cast("bigint")
    upto = F.when(size > 0, F.sequence(F.lit(0).cast("bigint"), F.greatest(size - 1, F.lit(0)))).otherwise(F.array())
    evens = ar.map_where(upto, lambda x: x % 2 == 0, lambda x: x * x)
    squared = ar.compose(lambda x: x * x, lambda x: x * 2, lambda x: x + 1)
    return t.part.select("p_partkey", text(evens).alias("squares"), squared(size).alias("composed"))


@query("type_dispatch", "F-20", """
SELECT p_partkey, CASE WHEN p_size < 15 THEN CAST(CAST(p_size AS BIGINT) * p_size AS VARCHAR) WHEN p_size < 30 THEN upper(p_name)
 WHEN p_size < 40 THEN array_to_string(list_sort(string_split(p_name, ' ')), ',') ELSE 'generic: ' || (p_size > 45) END AS result,
 CASE WHEN p_size < 15 THEN 'number' WHEN p_size < 30 THEN 'text' WHEN p_size < 40 THEN 'collection' ELSE 'other' END AS class FROM part""")
def _(t):
    size = F.col("p_size")
    value = (F.when(size < 15, size.cast("string")).when(size < 30, F.concat(F.lit('"'), "p_name", F.lit('"')))
             .when(size < 40, F.to_json(F.split("p_name", " "))).otherwise((size > 45).cast("string")))
    v = F.parse_json(value)
    return t.part.select("p_partkey", dc.dispatch(v).alias("result"), dc.type_class(v).alias("class"))


@query("strategy_pricing", "F-21", """
SELECT c_custkey, round(CASE c_mktsegment WHEN 'BUILDING' THEN 100 * 0.85 WHEN 'MACHINERY' THEN 100 * (1 - least(0.30, coalesce(v, 1) * 0.001))
 ELSE 100 END, 6) AS price FROM (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal > 0 THEN c_acctbal / 20 END AS v FROM customer)""")
def _(t):
    tier = F.when(F.col("c_mktsegment") == "BUILDING", "premium").when(F.col("c_mktsegment") == "MACHINERY", "b2b").otherwise("other")
    volume = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 20)
    return t.customer.select("c_custkey", r(nm.tier_price(tier, F.lit(100.0), volume)).alias("price"))


@query("money_values", "F-22", """
SELECT p_partkey, CASE WHEN p_size < 20 THEN p_partkey * 7 WHEN p_size < 40 THEN CAST(trunc((p_size + 0.5) * 100) AS BIGINT) END AS amount,
 CASE WHEN p_size < 20 THEN 'EUR' WHEN p_size < 40 THEN 'USD' END AS currency FROM part""")
def _(t):
    size = F.col("p_size")
    raw = (F.when(size < 20, F.to_json(F.struct((F.col("p_partkey") * 7).alias("amount"), F.lit("EUR").alias("currency"))))
           .when(size < 40, (size + F.lit(0.5)).cast("string")).otherwise(F.lit('"abc"')))
    return t.part.select("p_partkey", nm.money(raw).alias("m")).select("p_partkey", "m.amount", "m.currency")
