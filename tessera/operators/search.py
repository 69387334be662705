"""Keyword match, BM25 and hybrid rank; staged retrieval."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.aggregates import tokens
from tessera.operators.ordering import join_on_keys
from tessera.operators.postings import B, K1, KeywordIndex, query_terms
from tessera.operators.vectors import ClusteredLists, cosine_distance, literal_vector
from tessera.session import cut_lineage

def keyword_match(df: DataFrame, text: str, query: str) -> DataFrame:
    """Documents that hold every query word (V-10), decided inside the row."""
    have = tokens(F.col(text))
    return df.filter(F.forall(F.lit(query_terms(query)), lambda t: F.array_contains(have, t)))


def bm25(df: DataFrame, key: str, text: str, query: str, name: str = "score") -> DataFrame:
    """BM25 of each document that holds every query word (V-11), squashed to ``s / (1 + s)``, for one query only.

    Several queries of one corpus take a :class:`KeywordIndex`. Each text is read once: a narrow table of lengths and term counts is
    written, the corpus figures are one combined aggregate of a fixed width over
    it, and the score is computed from it. The text is not carried along.
    """
    terms = query_terms(query)
    kept = [c for c in df.columns if c != text]
    counted = cut_lineage(df.select(*kept, tokens(F.col(text)).alias("__tok")).select(
        *kept, F.size("__tok").alias("__len"),
        *[F.size(_only("__tok", t)).alias(f"__tf{i}") for i, t in enumerate(terms)]))
    figures = counted.agg(F.count(F.lit(1)).alias("__n"), F.avg("__len").alias("__avg"),
                          *[F.count_if(F.col(f"__tf{i}") > 0).alias(f"__df{i}") for i in range(len(terms))])
    matched = counted
    for i in range(len(terms)):
        matched = matched.filter(F.col(f"__tf{i}") > 0)
    rows = join_on_keys(matched, figures, [])
    raw = F.lit(0.0)
    for i in range(len(terms)):
        tf, seen = F.col(f"__tf{i}"), F.col(f"__df{i}")
        idf = F.log(1 + (F.col("__n") - seen + 0.5) / (seen + 0.5))
        raw = raw + idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("__len") / F.col("__avg")))
    return rows.withColumn("__s", raw).select(*kept, (F.col("__s") / (1 + F.col("__s"))).alias(name))


def _only(column: str, term: str) -> Column:
    return F.filter(column, lambda w: w == term)


def hybrid_rank(index: KeywordIndex, vectors: DataFrame, query: str, query_vector: Sequence[float],
                where: Column | None = None, weights: tuple[float, float] = (0.3, 0.7), limit: int = 20
                ) -> DataFrame:
    """Weighted keyword score and vector closeness of documents matching text and metadata (V-12).

    ``vectors`` is ``(key, embedding)`` with the index's key. The keyword figures are those of the
    whole corpus; the metadata filter narrows the candidates.
    """
    key = index.key
    scored = index.score(query, "keyword_score", where)
    near = vectors.select(key, (F.lit(1.0) - cosine_distance(F.col("embedding"), literal_vector(query_vector)))
                          .alias("closeness"))
    a, b = weights
    ranked = scored.join(near, key).withColumn(
        "hybrid", F.lit(a) * F.col("keyword_score") + F.lit(b) * F.col("closeness"))
    return ranked.orderBy(F.desc_nulls_last("hybrid"), key).limit(limit)


def staged_search(index: ClusteredLists, query_vector: Sequence[float], where: Column, candidates: int, k: int,
                  rerank: Callable[[pd.DataFrame], pd.Series] | None = None, rules: dict[str, Column] | None = None,
                  nprobe: int | None = None) -> DataFrame:
    """Filter, search of the index, exact re-rank, optional model score, business rules (V-13).

    With ``nprobe`` the search reads so many lists and is approximate; without it is exact. ``rerank`` gets a frame
    with the key and the exact distance of each candidate and returns a score, higher is better; ``rules`` add
    columns, and a boolean rule named ``keep`` drops rows.
    """
    found = (index.search_exact(query_vector, candidates, where) if nprobe is None
             else index.search(query_vector, candidates, nprobe, where))
    if rerank is not None:
        @F.pandas_udf("double")
        def score(rows: pd.DataFrame) -> pd.Series:
            return rerank(rows)

        found = found.withColumn("rank_score", score(F.struct(index.key, "distance")))
    else:
        found = found.withColumn("rank_score", -F.col("distance"))
    for name, rule in (rules or {}).items():
        found = found.withColumn(name, rule)
    if rules and "keep" in rules:
        found = found.filter("keep").drop("keep")
    return found.orderBy(F.desc_nulls_last("rank_score"), index.key).limit(k)
