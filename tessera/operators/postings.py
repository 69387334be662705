"""A stored inverted index: built once, added to, read by term."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.arrays import run_lengths
from tessera.operators.aggregates import tokens
from tessera.operators.ordering import join_on_keys
from tessera.session import scratch_path

K1 = 1.2
B = 0.75
BUCKETS = 64


def query_terms(query: str) -> list[str]:
    """Distinct lower-case words of a query in order."""
    words = "".join(c if c.isalnum() or c == "_" else " " for c in query.lower()).split()
    return list(dict.fromkeys(words))


class KeywordIndex:
    """Postings by term with counts and lengths, documents with their other columns, corpus figures (V-11).

    Three tables under one path. ``postings`` holds ``term, key, count, length`` of every word of every text in
    folders by a hash of the term, sorted by term, so a query reads the folders of its terms and in them the row
    groups that hold them. ``documents`` holds the key, the length and the other columns of every row.
    ``figures`` has a row per batch; rows of a batch count once its figures are written, so a broken
    :meth:`add` changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        figures = spark.read.parquet(f"{path}/figures")
        self.buckets, self.key = figures.select("buckets", "key").head()
        batches = [row[0] for row in figures.select("batch").collect()]  # one row for each call of add
        self.figures = figures.agg(F.sum("texts").alias("__n"), (F.sum("words") / F.sum("read")).alias("__avg"))
        own = F.col("batch").isin(batches)
        self.documents = spark.read.parquet(f"{path}/documents").filter(own)
        kind = self.documents.schema[self.key].dataType.simpleString()
        self.postings = spark.read.schema(f"batch long, row long, key {kind}, length int, term string, count int, "
                                          "bucket long").parquet(f"{path}/postings").filter(own)

    @classmethod
    def build(cls, df: DataFrame, key: str, text: str, path: str | None = None, buckets: int = BUCKETS) -> KeywordIndex:
        """Index the texts of a table; its other columns are kept with the documents."""
        path = path or scratch_path(df.sparkSession, "postings")
        cls._append(df, key, text, path, buckets)
        return cls(df.sparkSession, path)

    def add(self, df: DataFrame, text: str) -> KeywordIndex:
        """The index with more texts; what is stored stays as it is."""
        self._append(df, self.key, text, self.path, self.buckets)
        return KeywordIndex(self.spark, self.path)

    @staticmethod
    def _append(df: DataFrame, key: str, text: str, path: str, buckets: int) -> None:
        """Each text is read once; its words are counted inside the row, so each distinct one travels once.

        The rebalancing hint splits the folder of a frequent term between tasks and joins small ones.
        """
        batch = uuid.uuid4().int >> 65
        kept = [c for c in df.columns if c != text]
        folder = f"{path}/documents/batch={batch}"
        (df.select(*kept, tokens(F.col(text)).alias("__words"))
         .select(*kept, F.monotonically_increasing_id().alias("__row"), F.size("__words").alias("__len"),
                 run_lengths(F.array_sort("__words")).alias("__counts")).write.parquet(folder))
        rows = df.sparkSession.read.parquet(folder)
        found = (rows.select(F.lit(batch).alias("batch"), F.col("__row").alias("row"), F.col(key).alias("key"),
                             F.col("__len").alias("length"), F.explode("__counts").alias("c"))
                 .select("batch", "row", "key", "length", F.col("c.value").alias("term"), F.col("c.many").alias("count"))
                 .withColumn("bucket", F.crc32(F.col("term").cast("binary")) % buckets))
        (found.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "term", "row")
         .write.mode("append").partitionBy("bucket").parquet(f"{path}/postings"))
        (rows.agg(F.count(F.lit(1)).alias("texts"), F.count("__len").alias("read"),
                  F.coalesce(F.sum("__len"), F.lit(0)).cast("bigint").alias("words"))
         .select(F.lit(batch).alias("batch"), F.lit(buckets).alias("buckets"), F.lit(key).alias("key"), "*")
         .coalesce(1).write.mode("append").parquet(f"{path}/figures"))

    def matches(self, terms: Sequence[str]) -> DataFrame:
        """Postings of the terms; only their folders are read."""
        folders = sorted({zlib.crc32(t.encode()) % self.buckets for t in terms})
        return self.postings.filter(F.col("bucket").isin(folders) & F.col("term").isin(list(terms)))

    @staticmethod
    def _weight(seen: Column) -> Column:
        idf = F.log(1 + (F.col("__n") - seen + 0.5) / (seen + 0.5))
        return idf * F.col("count") * (K1 + 1) / (
            F.col("count") + K1 * (1 - B + B * F.col("length") / F.col("__avg")))

    def score(self, query: str, name: str = "score", where: Column | None = None) -> DataFrame:
        """BM25 of each document that holds every query word, squashed to ``s / (1 + s)``, with its other columns.

        ``where`` narrows the documents; the corpus figures stay those of all. A query without words scores 0
        everywhere. Rows that share a key are documents of their own.
        """
        documents = self.documents if where is None else self.documents.filter(where)
        kept = [c for c in documents.columns if c not in ("batch", "__row", "__len", "__counts")]
        terms = query_terms(query)
        if not terms:
            return documents.select(*kept, F.lit(0.0).alias(name))
        hits = self.matches(terms)
        seen = hits.groupBy("term").agg(F.count(F.lit(1)).alias("__df"))  # a row for each query word at most
        scored = (join_on_keys(hits.join(F.broadcast(seen), "term"), self.figures, [])
                  .groupBy("batch", "row").agg(F.count(F.lit(1)).alias("__found"), F.sum(self._weight(F.col("__df")))
                                               .alias("__s"))
                  .filter(F.col("__found") == len(terms))
                  .select("batch", F.col("row").alias("__row"), (F.col("__s") / (1 + F.col("__s"))).alias(name)))
        return documents.join(scored, ["batch", "__row"]).select(*kept, name)

    def score_each(self, queries: DataFrame, name: str = "score") -> DataFrame:
        """``query_id``, the key and the score of all matches of each row of a table ``query_id, query``.

        Query words meet the postings by folder and term, so folders without any are left out while the plan
        runs; a frequent term asked by many is split between tasks by adaptive execution. Queries without words
        match nothing.
        """
        words = F.array_distinct(F.filter(F.split(F.lower("query"), r"[^\p{L}\p{N}_]+"), lambda w: w != ""))
        asked = (queries.select("query_id", words.alias("words"))
                 .select("query_id", F.size("words").alias("__need"), F.explode("words").alias("term"))
                 .withColumn("bucket", F.crc32(F.col("term").cast("binary")) % self.buckets))
        wanted = asked.select("bucket", "term").distinct()
        hits = self.postings.join(wanted, ["bucket", "term"], "left_semi")
        seen = hits.groupBy("term").agg(F.count(F.lit(1)).alias("__df"))
        scored = (join_on_keys(self.postings.join(asked.join(seen, "term"), ["bucket", "term"]), self.figures, [])
                  .groupBy("query_id", "__need", "batch", "row", "key")
                  .agg(F.count(F.lit(1)).alias("__found"), F.sum(self._weight(F.col("__df"))).alias("__s"))
                  .filter(F.col("__found") == F.col("__need")))
        return scored.select("query_id", F.col("key").alias(self.key), (F.col("__s") / (1 + F.col("__s"))).alias(name))
