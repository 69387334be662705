"""Row-level work and user functions (survey 2.13 and 2.15)."""

import pandas as pd
from pyspark.sql import functions as F

from tessera.functions import arrays as ar
from tessera.functions import udfs as ud
from tessera.operators import etl
from tessera.plans.builder import Repository, Selection
from tessera.plans.registry import query, r, text

_MAIL = "'  ' || upper(replace(p_name, ' ', '.')) || CASE WHEN p_size < 40 THEN '@' ELSE '#' END || 'Shop.COM '"


def mailed(t):
    address = F.concat(F.lit("  "), F.upper(F.replace("p_name", F.lit(" "), F.lit("."))),
                       F.when(F.col("p_size") < 40, "@").otherwise("#"), F.lit("Shop.COM "))
    named = F.when(F.col("p_size") > 5, F.concat(F.lit("o'"), "p_name", F.lit("-"), F.col("p_size").cast("string"), "p_type"))
    return t.part.select("p_partkey", address.alias("email"), named.alias("name"))


@query("upload_rows", "E-1", f"""
SELECT trim(lower({_MAIL})) AS email, coalesce(CASE WHEN p_size > 5 THEN list_aggregate([upper(x[1]) || lower(x[2:]) FOR x IN
 regexp_extract_all('o''' || p_name || '-' || p_size || p_type, '([A-Za-z]+|[^A-Za-z]+)')], 'string_agg', '') END, '') AS name
FROM part WHERE contains({_MAIL}, '@')""")
def _(t):
    return etl.upload_rows(mailed(t))


_PEOPLE = """WITH p AS (SELECT c_custkey, CASE WHEN c_nationkey = 7 THEN 'x' ELSE c_name END AS name,
 CASE WHEN c_mktsegment = 'BUILDING' THEN 'bad' ELSE 'user' || c_custkey || '@mail.org' END AS email, CAST(floor(c_acctbal / 70) AS BIGINT) AS age FROM customer) """


def people(t):
    key = F.col("c_custkey")
    return t.customer.select(
        "c_custkey", F.when(F.col("c_nationkey") == 7, "x").otherwise(F.col("c_name")).alias("name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "bad").otherwise(F.concat(F.lit("user"), key, F.lit("@mail.org"))).alias("email"),
        F.floor(F.col("c_acctbal") / 70).alias("age"), F.lit("secret").alias("password"))


_VALID = "length(name) BETWEEN 2 AND 50", "regexp_full_match(email, '[a-zA-Z0-9_.+-]+@[a-zA-Z0-9_-]+\\.[a-z]{2,}')", "age BETWEEN 0 AND 120"


@query("validate_accepted", "E-2", _PEOPLE + f"""
SELECT c_custkey, name, email, age FROM p WHERE {' AND '.join(_VALID)} AND age >= 18""")
def _(t):
    return etl.signup(people(t))[0].drop("password")


@query("validate_rejected", "E-2", _PEOPLE + f"""
SELECT c_custkey, concat_ws(',', CASE WHEN NOT {_VALID[0]} THEN 'name' END, CASE WHEN NOT {_VALID[1]} THEN 'email' END,
 CASE WHEN NOT {_VALID[2]} THEN 'age' END, CASE WHEN {' AND '.join(_VALID)} THEN 'age' END) AS fields
FROM p WHERE NOT ({' AND '.join(_VALID)} AND age >= 18)""")
def _(t):
    return etl.signup(people(t))[1].select("c_custkey", text(F.col("errors.field")).alias("fields"))


@query("graded_people", "E-3", """
WITH g AS (SELECT c_name AS name, CAST(floor(c_acctbal / 90) AS BIGINT) AS age, c_acctbal / 100 AS score, c_mktsegment AS city,
 CASE WHEN c_acctbal / 100 >= 90 THEN 'A' WHEN c_acctbal / 100 >= 80 THEN 'B' ELSE 'C' END AS grade FROM customer WHERE floor(c_acctbal / 90) >= 25)
SELECT row_number() OVER (ORDER BY score DESC, name) AS pos, name || ' (' || age || ') - Grade ' || grade || ' - ' || city AS line FROM g""")
def _(t):
    rows = t.customer.select(F.col("c_name").alias("name"), F.floor(F.col("c_acctbal") / 90).alias("age"),
                             (F.col("c_acctbal") / 100).alias("score"), F.col("c_mktsegment").alias("city"))
    return etl.graded_people(rows).select("pos", "line")


@query("guard_chain", "E-4", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 401 WHEN value > 100 THEN 429 WHEN event_type = 'signup' THEN 403 ELSE 200 END AS code FROM events""")
def _(t):
    return etl.guard_chain(t.events, [(401, F.col("event_type") != "error"), (429, F.col("value") <= 100),
                                      (403, F.col("event_type") != "signup")]).select("event_id", "code")


@query("error_envelope", "E-5", """
SELECT event_id, CASE event_type WHEN 'view' THEN 'not_found' WHEN 'click' THEN 'validation_error'
  WHEN 'purchase' THEN 'external_service_error' ELSE 'internal_error' END AS code,
 CASE event_type WHEN 'view' THEN 404 WHEN 'click' THEN 422 WHEN 'purchase' THEN 502 ELSE 500 END AS http, props AS message,
 CASE WHEN event_type = 'purchase' THEN 'shop' END AS service FROM events""")
def _(t):
    bought = F.col("event_type") == "purchase"
    kind = (F.when(F.col("event_type") == "view", "not_found").when(F.col("event_type") == "click", "validation_error")
            .when(bought, "external_service_error").otherwise(F.col("event_type")))
    details = F.when(bought, F.create_map(F.lit("service"), F.lit("shop")))
    return (t.events.select("event_id", etl.error_envelope(kind, F.col("props"), details).alias("e"))
            .select("event_id", "e.code", "e.http", "e.message", F.try_element_at("e.details", F.lit("service")).alias("service")))


@query("filter_batches", "E-6", "SELECT event_id, value FROM events WHERE value < 4")
def _(t):
    return etl.filter_batches(t.events.select("event_id", "value"), lambda f: f["value"] < 4)


@query("ordered_map", "E-7", """
SELECT row_number() OVER (ORDER BY event_id) AS pos, event_id * event_id AS result FROM events""")
def _(t):
    from tessera.operators.ordering import number_rows
    done = etl.map_rows(t.events.select("event_id"), ["event_id"], lambda n: int(n) * int(n), "bigint")
    return number_rows(done, [], ["event_id"]).select("pos", "result")


@query("unordered_map", "E-8", "SELECT doc_id, length(text) AS result FROM documents")
def _(t):
    return etl.map_rows(t.documents.select("doc_id", "text"), ["text"], len, "int").select("doc_id", "result")


@query("map_captured_errors", "E-9", """
SELECT event_id, CASE WHEN user_id <> 5 THEN user_id * 2 END AS result, CASE WHEN user_id = 5 THEN 'Error in task 5' END AS error FROM events""")
def _(t):
    def task(n):
        if n == 5:
            raise ValueError(f"Error in task {n}")
        return int(n) * 2

    out = etl.map_captured(t.events.select("event_id", "user_id"), ["user_id"], task, "bigint")
    return out.select("event_id", "outcome.result", "outcome.error")


@query("map_with_retry", "E-10", "SELECT event_id, user_id + 1 AS result, CAST(NULL AS VARCHAR) AS error FROM events")
def _(t):
    def flaky():
        seen = set()

        def call(n):
            if n not in seen:
                seen.add(n)
                raise IOError("try again")
            return int(n) + 1

        return call

    out = etl.map_captured(t.events.select("event_id", "user_id"), ["user_id"], flaky(), "bigint", attempts=3)
    return out.select("event_id", "outcome.result", "outcome.error")


@query("star_map", "E-11", "SELECT l_orderkey, l_partkey, l_linenumber, l_partkey * l_linenumber AS result FROM lineitem")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
    return etl.map_rows(rows, ["l_partkey", "l_linenumber"], lambda a, b: int(a) * int(b), "bigint")


@query("memoised_function", "E-12", "SELECT o_orderkey, o_custkey * o_custkey + 1 AS result FROM orders")
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", F.lit(False).alias("debug"))
    done = etl.memoised(rows, ["o_custkey", "debug"], lambda d: etl.map_rows(
        d, ["o_custkey"], lambda n: int(n) * int(n) + 1, "bigint"), ignore=["debug"])
    return done.select("o_orderkey", "result")


@query("scalar_function", "U-1", "SELECT event_id, round(value * 2 + 1, 6) AS result FROM events")
def _(t):
    double = ud.vectorised(lambda v: v * 2 + 1, "double")
    return t.events.select("event_id", r(double(F.col("value"))).alias("result"))


@query("bound_functions", "U-2", """
SELECT p_partkey, p_size * 2 AS twice, p_size * 3 AS thrice, p_size * 10 + 1 AS line FROM part""")
def _(t):
    table = {name: ar.multiplier(k) for name, k in (("twice", 2), ("thrice", 3))}
    line = ar.curried(lambda k, c, x: k * x + c, 10, 1)
    size = F.col("p_size")
    return t.part.select("p_partkey", *ar.strategies(table, ["twice", "thrice"], size), line(size).alias("line"))


@query("table_function", "U-3", """
SELECT p_partkey, CAST(unnest(range(p_size % 5, 0, -1)) AS BIGINT) AS n FROM part""")
def _(t):
    def countdown(size):
        for n in range(int(size) % 5, 0, -1):
            yield (n,)

    return ud.expand(t.part.select("p_partkey", "p_size"), ["p_size"], countdown, "n bigint").select("p_partkey", "n")


@query("aggregate_function", "U-4", """
SELECT o_custkey, CAST(bit_xor(o_orderkey) AS BIGINT) AS folded FROM orders GROUP BY 1""")
def _(t):
    return ud.fold_groups(t.orders, ["o_custkey"], "o_orderkey", lambda a, b: int(a) ^ int(b), 0, "bigint")


@query("aggregate_from_start", "U-4", """
SELECT key, 100 + sum(l_quantity)::BIGINT AS folded
FROM (SELECT CASE WHEN l_linenumber < 7 THEN 9007199254740993 + l_linenumber END AS key, l_quantity FROM lineitem) GROUP BY 1""")
def _(t):
    key = F.when(F.col("l_linenumber") < 7, F.lit(9007199254740993) + F.col("l_linenumber")).alias("key")
    return ud.fold_groups(t.lineitem.select(key, F.col("l_quantity").cast("bigint").alias("n")), ["key"], "n",
                          lambda a, b: a + b, 100, "bigint")


@query("aggregate_array_function", "U-4", """
SELECT p_partkey, CAST(list_sum([length(w) FOR w IN string_split(p_name, ' ')]) AS BIGINT) AS letters FROM part""")
def _(t):
    return t.part.select("p_partkey", ar.fold(F.split("p_name", " "), F.lit(0).cast("bigint"),
                                              lambda s, w: s + F.length(w)).alias("letters"))


@query("partition_function", "U-5", "SELECT l_returnflag, l_quantity * 2 AS twice FROM lineitem WHERE l_quantity > 45")
def _(t):
    def run(frames):
        for frame in frames:
            big = frame[frame["l_quantity"] > 45]
            yield pd.DataFrame({"l_returnflag": big["l_returnflag"], "twice": big["l_quantity"] * 2})

    return t.lineitem.select("l_returnflag", "l_quantity").mapInPandas(run, "l_returnflag string, twice double")


@query("query_builder", "U-6", """
SELECT o_orderkey, c_name, o_orderdate FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus = 'P' AND c_mktsegment = 'BUILDING' ORDER BY o_orderdate DESC, o_orderkey LIMIT 25 OFFSET 25""")
def _(t):
    return (Selection(t.orders).join(t.customer, "o_custkey = c_custkey").where("o_orderstatus = :s", s="P")
            .where(F.col("c_mktsegment") == "BUILDING").order("o_orderdate", "DESC").order("o_orderkey")
            .paginate(page=2, size=25).build().select("o_orderkey", "c_name", "o_orderdate"))


@query("repository", "U-7", """
SELECT c_custkey, CASE WHEN s_suppkey IS NOT NULL THEN s_name ELSE c_name END AS c_name FROM customer
LEFT JOIN supplier ON c_custkey = s_suppkey WHERE c_custkey NOT IN (3, 4)""")
def _(t):
    rows = t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"))
    return Repository(t.customer.select("c_custkey", "c_name"), "c_custkey").save(rows).delete(3, 4).table


@query("repository_page", "U-7", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 50 OFFSET 100")
def _(t):
    return Repository(t.customer.select("c_custkey", "c_name"), "c_custkey").list(offset=100)
