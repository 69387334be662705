"""The stored inverted index against plain Python."""
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.functions.arrays import run_lengths
from tessera.operators import search as se
from tessera.operators.postings import KeywordIndex, query_terms

SCHEMA = "id long, text string, lang string"
TEXTS = [(1, "Red fish, blue fish.", "en"), (2, "the red red RED house", "en"), (2, "the blue house", "de"), (None, "red the", "en"),
         (4, None, "en"), (5, "", "de"), (6, "x1 red_y 9 the", "en"), (7, "The fish " * 40 + "red", None), (8, "blué red the", "de")]


def words(text):
    return re.findall(r"\b[a-zA-Z]+\b", text.lower())


def brute(rows, query):
    """(id, lang, score) of the rows that hold all words."""
    bags = [(i, lang, None if t is None else words(t)) for i, t, lang in rows]
    read = [b for _, _, b in bags if b is not None]
    avg = sum(map(len, read)) / len(read)
    out = []
    for i, lang, bag in bags:
        count = Counter(bag or [])
        asked = query_terms(query)
        if all(count[w] for w in asked):
            s = 0.0
            for w in asked:
                df = sum(w in b for b in read)
                s += math.log(1 + (len(bags) - df + 0.5) / (df + 0.5)) * count[w] * 2.2 / (
                    count[w] + 1.2 * (0.25 + 0.75 * len(bag) / avg))
            out.append((i, lang, round(s / (1 + s), 9)))
    return sorted(out, key=repr)


def scores(df):
    return sorted(((r.id, r.lang, round(r.score, 9)) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "stored")
    df = spark.createDataFrame(TEXTS, SCHEMA).repartition(3)
    return KeywordIndex.build(df, "id", "text", path, buckets=8)


@pytest.mark.parametrize("query", ["red", "The RED", "fish blue", "red the house", "nothing", "x1", "", "red red"])
def test_scores(index, query):
    assert scores(index.score(query)) == brute(TEXTS, query)


def test_where_keeps_the_corpus_figures(index):
    assert scores(index.score("red the", where=F.col("lang") == "en")) == [
        r for r in brute(TEXTS, "red the") if r[1] == "en"]


def test_many_queries(spark, index):
    asked = spark.createDataFrame([(1, "the red"), (2, "FISH"), (3, "none here"), (4, ""), (5, None), (6, "red, Red")],
                                  "query_id int, query string")
    got = sorted(((r.query_id, r.id, round(r.score, 9)) for r in index.score_each(asked).collect()), key=repr)
    assert got == sorted(((q, i, s) for q, said in [(1, "the red"), (2, "fish"), (6, "red")]
                          for i, _, s in brute(TEXTS, said)), key=repr)


def test_only_the_folders_of_the_terms_are_read(index):
    plan = index.matches(["red", "the"])._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket", plan) and re.search(r"PushedFilters: \[[^]]*In\(term, \[red,the\]\)", plan)
    read = {r[0] for r in index.matches(["red"]).select(F.regexp_extract(F.input_file_name(), "bucket=([0-9]+)", 1)).collect()}
    assert len(read) == 1


def test_added_texts(spark, tmp_path):
    df = spark.createDataFrame(TEXTS, SCHEMA)
    first = KeywordIndex.build(df.filter("lang = 'en'"), "id", "text", str(tmp_path / "i"))
    rest = df.filter("lang <> 'en' OR lang IS NULL")
    both = first.add(rest, "text")
    assert scores(both.score("red the")) == brute(TEXTS, "red the")
    assert scores(KeywordIndex(spark, str(tmp_path / "i")).score("fish")) == brute(TEXTS, "fish")
    rest.sparkSession.read.parquet(str(tmp_path / "i/postings")).withColumn("batch", F.lit(5).cast("bigint")).drop("bucket").withColumn(
        "bucket", F.lit(3)).write.mode("append").partitionBy("bucket").parquet(str(tmp_path / "i/postings"))  # an add that broke
    assert scores(KeywordIndex(spark, str(tmp_path / "i")).score("fish")) == brute(TEXTS, "fish")


def test_no_texts(spark, tmp_path):
    empty = KeywordIndex.build(spark.createDataFrame([], SCHEMA), "id", "text", str(tmp_path / "e"))
    assert empty.score("red").count() == 0 and empty.score("").count() == 0


def test_hybrid_without_vectors(spark, index):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id long, embedding array<double>")
    got = se.hybrid_rank(index, vectors, "red", [1.0, 0.0], limit=2).collect()
    assert [r.id for r in got] == [1, 2] and got[0].closeness == 1.0


def test_run_lengths(spark):
    df = spark.createDataFrame([(["a", "a", "b"],), ([],), (None,), (["x"],)], "v array<string>")
    got = [r[0] and [tuple(x) for x in r[0]] for r in df.select(run_lengths(F.col("v"))).collect()]
    assert got[0] == [("a", 2), ("b", 1)] and not got[1] and not got[2] and got[3] == [("x", 1)]
