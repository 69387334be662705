"""Vectors, keyword and hybrid search (survey 2.11)."""

from pyspark.sql import functions as F

from tessera.operators import search as se
from tessera.operators import vectors as vc
from tessera.operators.filters import matches
from tessera.operators.ordering import top_per_key
from tessera.operators.postings import KeywordIndex
from tessera.plans.registry import query, r

_Q = "(SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)"
_E = "CAST(embedding AS DOUBLE[])"


def q0(t):
    return vc.vector_of(t.embeddings, "vec_id", "embedding", 0)


@query("vector_arithmetic", "V-1", f"""
SELECT vec_id, round(list_sum(list_transform(list_zip({_E}, {_Q}), lambda p: p[1] + p[2])), 5) AS added,
 round(list_sum(list_transform(list_zip({_E}, {_Q}), lambda p: abs(p[1] - p[2]))), 5) AS gap,
 round(list_sum(list_transform({_E}, lambda x: abs(x + 1.5))), 5) AS shifted,
 round(list_sum(list_transform({_E}, lambda x: abs(x * 3))), 5) AS scaled,
 round(list_sum(list_transform({_E}, lambda x: abs(x / 4))), 5) AS divided FROM embeddings""")
def _(t):
    e, q = F.col("embedding"), vc.literal_vector(q0(t))

    def total(v, absolute=True):
        return r(F.aggregate(v, F.lit(0.0), lambda s, x: s + (F.abs(x) if absolute else x)), 5)

    return t.embeddings.select("vec_id", total(vc.add(e, q), False).alias("added"), total(vc.subtract(e, q)).alias("gap"),
                               total(vc.shift(e, 1.5)).alias("shifted"), total(vc.scale(e, 3.0)).alias("scaled"),
                               total(vc.divide(e, 4.0)).alias("divided"))


@query("vector_dot_norm", "V-2", f"""
SELECT vec_id, round(list_dot_product({_E}, {_Q}), 6) AS dot, round(sqrt(list_dot_product({_E}, {_E})), 6) AS magnitude,
 1.0::DOUBLE AS unit FROM embeddings""")
def _(t):
    e = F.col("embedding")
    return t.embeddings.select("vec_id", r(vc.dot(e, vc.literal_vector(q0(t)))).alias("dot"),
                               r(vc.magnitude(e)).alias("magnitude"), r(vc.magnitude(vc.normalise(e))).alias("unit"))


@query("vector_compare", "V-3", f"""
SELECT vec_id, {_E} = {_Q} AS same, sqrt(list_dot_product({_E}, {_E})) < 1.0 - 1e-9 AS shorter, true AS truth,
 round(list_sum([x * x FOR x IN {_E}]), 6) AS squares FROM embeddings""")
def _(t):
    e = F.col("embedding")
    unit = vc.literal_vector([1.0 - 1e-9] + [0.0] * 63)
    squares = F.aggregate(vc.apply(e, lambda x: x * x), F.lit(0.0), lambda s, x: s + x)
    return t.embeddings.select("vec_id", (vc.as_double(e) == vc.literal_vector(q0(t))).alias("same"),
                               vc.shorter(e, unit).alias("shorter"), vc.any_nonzero(e).alias("truth"),
                               r(squares).alias("squares"))


@query("cosine_distance", "V-4", f"SELECT vec_id, round(1 - list_cosine_similarity({_E}, {_Q}), 6) AS distance FROM embeddings")
def _(t):
    return t.embeddings.select("vec_id", r(vc.cosine_distance(F.col("embedding"), vc.literal_vector(q0(t)))).alias("distance"))


@query("l2_distance", "V-5", f"SELECT vec_id, round(list_distance({_E}, {_Q}), 6) AS distance FROM embeddings")
def _(t):
    return t.embeddings.select("vec_id", r(vc.l2_distance(F.col("embedding"), vc.literal_vector(q0(t)))).alias("distance"))


_KNN = f"""SELECT vec_id, label, round(d, 6) AS distance FROM (SELECT vec_id, label, 1 - list_cosine_similarity({_E}, {_Q}) AS d
FROM embeddings) WHERE {{where}} ORDER BY d, vec_id LIMIT {{k}}"""


@query("nearest_vectors", "V-6", _KNN.format(where="true", k=10))
def _(t):
    return vc.nearest(t.embeddings, q0(t), "vec_id", "embedding", 10).withColumn("distance", r("distance"))


@query("nearest_per_query", "V-6", """
WITH q AS (SELECT label AS query_id, arg_min(CAST(embedding AS DOUBLE[]), vec_id) AS q FROM embeddings GROUP BY 1)
SELECT query_id, vec_id, round(d, 6) AS distance, rn FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS rn
 FROM (SELECT query_id, vec_id, 1 - list_cosine_similarity(CAST(embedding AS DOUBLE[]), q) AS d FROM q, embeddings)) WHERE rn <= 5""")
def _(t):
    queries = t.embeddings.groupBy(F.col("label").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("query"))
    return (vc.nearest_each(t.wide("embeddings", "vec_id", "embedding"), queries, "vec_id", "embedding", 5).withColumn("distance", r("distance")))


@query("filtered_nearest", "V-7", _KNN.format(where="label = 3", k=10))
def _(t):
    return (vc.nearest(t.embeddings, q0(t), "vec_id", "embedding", 10, where=F.col("label") == 3)
            .withColumn("distance", r("distance")))


@query("intent_nearest", "V-8", f"""
SELECT vec_id, label, lang, n_chars, round(d, 6) AS distance FROM (SELECT vec_id, label, lang, n_chars,
 1 - list_cosine_similarity({_E}, {_Q}) AS d FROM embeddings JOIN documents ON doc_id = vec_id)
WHERE label IN (1, 2, 3, 4) AND lang = 'en' AND n_chars <= 5000 ORDER BY d, vec_id LIMIT 20""")
def _(t):
    intent = matches({"label": [1, 2, 3, 4], "lang": "en", "n_chars": ("<=", 5000)})
    meta = t.documents.select(F.col("doc_id").alias("vec_id"), "lang", "n_chars")
    return (vc.nearest(t.embeddings.join(meta, "vec_id"), q0(t), "vec_id", "embedding", 20, where=intent)
            .withColumn("distance", r("distance")))


def lists_of(t, lists=16):
    return vc.ClusteredLists.build(t.embeddings, "vec_id", "embedding", lists=lists)


@query("clustered_nearest", "V-9", _KNN.format(where="true", k=10))
def _(t):
    return lists_of(t).search_exact(q0(t), 10).withColumn("distance", r("distance"))


@query("clustered_nearest_all_lists", "V-9", _KNN.format(where="true", k=10))
def _(t):
    return lists_of(t).search(q0(t), 10, nprobe=16).withColumn("distance", r("distance"))


_TOK = r"""WITH d AS (SELECT *, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}_]+'),
 lambda x: regexp_full_match(x, '[a-z]+')) AS tok FROM documents) """
_BM25 = _TOK + """,
c AS (SELECT *, len(tok) AS dl, len(list_filter(tok, lambda w: w = 'the')) AS f0, len(list_filter(tok, lambda w: w = 'with')) AS f1 FROM d),
g AS (SELECT count(*) AS n, avg(dl) AS av, count(*) FILTER (f0 > 0) AS d0, count(*) FILTER (f1 > 0) AS d1 FROM c),
s AS (SELECT c.*, ln(1 + (n - d0 + 0.5::DOUBLE) / (d0 + 0.5::DOUBLE)) * f0 * 2.2::DOUBLE / (f0 + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / av)) +
 ln(1 + (n - d1 + 0.5::DOUBLE) / (d1 + 0.5::DOUBLE)) * f1 * 2.2::DOUBLE / (f1 + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / av)) AS s
 FROM c, g WHERE f0 > 0 AND f1 > 0) """


@query("keyword_match", "V-10", _TOK + "SELECT doc_id FROM d WHERE list_has_all(tok, ['the', 'with'])")
def _(t):
    return se.keyword_match(t.wide("documents", "doc_id", "text"), "text", "The, with!").select("doc_id")


#: Indexes of this session by table; a table written anew has another time stamp and is indexed again.
_INDEXES: dict[tuple, KeywordIndex] = {}


def index_of(t):
    """The stored index of the documents, built when it is first asked for."""
    context = t.spark.sparkContext
    conf, place = context._jsc.hadoopConfiguration(), context._jvm.org.apache.hadoop.fs.Path

    def files(path):
        return place(path).getFileSystem(conf)

    table = f"{t.folder}/documents.parquet"
    status = files(table).getFileStatus(place(table))
    ident = (context.applicationId, table, status.getModificationTime(), status.getLen())
    known = _INDEXES.get(ident)
    if known is None or not files(known.path).exists(place(known.path)):
        known = _INDEXES[ident] = KeywordIndex.build(t.wide("documents", "doc_id", "text", "lang"), "doc_id", "text")
    return known


@query("keyword_score", "V-11", _BM25 + "SELECT doc_id, round(s / (1 + s), 6) AS score FROM s")
def _(t):
    return index_of(t).score("the with").select("doc_id", r("score").alias("score"))


_EACH = _TOK + """,
c AS (SELECT doc_id, lang, dl, term, count(*) AS f FROM (SELECT doc_id, lang, len(tok) AS dl, unnest(tok) AS term FROM d) GROUP BY ALL),
g AS (SELECT count(*) AS n, avg(len(tok)) AS av FROM d), df AS (SELECT term, count(*) AS df FROM c GROUP BY term),
q AS (SELECT lang AS query_id, term FROM (SELECT lang, term, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, term) AS k
 FROM c GROUP BY lang, term) WHERE k <= 2),
s AS (SELECT query_id, doc_id, sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * f * 2.2::DOUBLE /
 (f + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / av))) AS s FROM q JOIN c USING (term) JOIN df USING (term), g GROUP BY 1, 2 HAVING count(*) = 2)
SELECT query_id, doc_id, round(s / (1 + s), 6) AS score FROM s"""


@query("keyword_score_each", "V-11", _EACH)
def _(t):
    """The two most frequent words of each language as a query over all documents."""
    index = index_of(t)
    rows = index.documents.select("lang", F.explode("__counts").alias("c")).groupBy("lang", F.col("c.value").alias("term"))
    best = top_per_key(rows.agg(F.count(F.lit(1)).alias("many")), ["lang"], ["-many", "term"], 2)
    asked = best.groupBy(F.col("lang").alias("query_id")).agg(F.concat_ws(" ", F.collect_list("term")).alias("query"))
    return index.score_each(asked).select("query_id", "doc_id", r("score").alias("score"))


@query("hybrid_rank", "V-12", _BM25 + f""",
h AS (SELECT doc_id, s / (1 + s) AS k, list_cosine_similarity({_E}, {_Q}) AS v FROM s JOIN embeddings ON doc_id = vec_id WHERE lang = 'en')
SELECT doc_id, round(k, 6) AS keyword_score, round(v, 6) AS closeness, round(0.3::DOUBLE * k + 0.7::DOUBLE * v, 6) AS hybrid FROM h
ORDER BY 0.3::DOUBLE * k + 0.7::DOUBLE * v DESC, doc_id LIMIT 20""")
def _(t):
    vectors = t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding")
    ranked = se.hybrid_rank(index_of(t), vectors, "the with", q0(t), where=F.col("lang") == "en")
    return ranked.select("doc_id", *[r(c).alias(c) for c in ("keyword_score", "closeness", "hybrid")])


@query("staged_search", "V-13", f"""
SELECT vec_id, label, label = 2 AS featured, round(1 - d, 6) AS rank_score FROM (SELECT vec_id, label, d FROM
 (SELECT vec_id, label, 1 - list_cosine_similarity({_E}, {_Q}) AS d FROM embeddings WHERE label IN (0, 1, 2, 3, 4) ORDER BY d, vec_id LIMIT 50)
 WHERE d < 0.9 ORDER BY d, vec_id LIMIT 10)""")
def _(t):
    out = se.staged_search(lists_of(t), q0(t), F.col("label").isin(0, 1, 2, 3, 4), 50, 10,
                           rerank=lambda rows: 1.0 - rows["distance"],
                           rules={"featured": F.col("label") == 2, "keep": F.col("distance") < 0.9})
    return out.select("vec_id", "label", "featured", r("rank_score").alias("rank_score"))
