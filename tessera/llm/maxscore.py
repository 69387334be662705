"""Exact top-k inner products by MaxScore over shards of integer vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHARD_ROWS = 8_192
QUERY_ROWS = 4_096
PROBE = 8


class Shard:
    """Postings of a shard: one row of values for each dimension, with its range."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.postings = ids[order], np.ascontiguousarray(vectors[order].T)
        self.low, self.high = self.postings.min(1), self.postings.max(1)

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows but ``own``; ties go to smaller ids.

        A dimension adds between 0 and its bound to the least possible score. Dimensions whose bounds
        together cannot lift a row over the k-th best score are non-essential: rows are scored on the
        others first and probed on these while they can still compete.
        """
        base = np.where(query >= 0, query * self.low, query * self.high)
        bound = np.where(query >= 0, query * self.high, query * self.low) - base
        terms = np.argsort(-bound, kind="stable")
        left = np.concatenate([np.cumsum(bound[terms][::-1])[::-1], [0]])  # bound of the terms from here on
        others = self.ids != own
        size = int(others.sum())
        if not size:
            return self.ids[:0], np.zeros(0)
        done = min(PROBE, len(terms))
        partial = query[terms[:done]] @ self.postings[terms[:done]]
        floor = -np.inf
        rest = np.concatenate([[base.sum()], base.sum() - np.cumsum(base[terms])])  # least of the terms from here on
        if size > k:
            tried = np.argpartition(-np.where(others, partial, -np.inf), min(size, 4 * k) - 1)[:min(size, 4 * k)]
            floor = np.sort(query @ self.postings[:, tried])[::-1][k - 1]
        # essential terms: rows that have none of the bounds of these cannot reach the floor
        essential = max(done, int(np.searchsorted(-(base.sum() + left), -floor, side="right")))
        essential = min(essential, len(terms))
        partial = partial + query[terms[done:essential]] @ self.postings[terms[done:essential]]
        rows = np.flatnonzero(others & (partial + rest[essential] + left[essential] >= floor))
        partial = partial[rows]
        while essential < len(terms) and len(rows):
            step = terms[essential:essential + PROBE]
            partial = partial + query[step] @ self.postings[np.ix_(step, rows)]
            essential = min(len(terms), essential + PROBE)
            if len(rows) > k:
                floor = max(floor, np.partition(partial + rest[essential], len(rows) - k)[len(rows) - k])
            fit = partial + rest[essential] + left[essential] >= floor
            rows, partial = rows[fit], partial[fit]
        best = np.lexsort((self.ids[rows], -partial))[:k]
        return self.ids[rows[best]], partial[best]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of one matrix, shorter ones filled with zeros."""
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _search(k: int):
    def run(table: pa.Table) -> pa.Table:
        ids = table["vec_id"].to_numpy()
        asks = table["asks"].to_numpy(zero_copy_only=False).astype(bool)
        width = int(max(1, np.diff(table["v"].combine_chunks().offsets.to_numpy()).max()))
        vectors = _matrix(table["v"], width)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if (~asks).any():
            shard = Shard(vectors[~asks], ids[~asks])
            for i in np.flatnonzero(asks):
                found, scores = shard.top(vectors[i], ids[i], k)
                out.append((np.full(len(found), ids[i]), found, scores))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0)] * 3
        return pa.table({n: pa.array(c.astype(np.int64)) for n, c in zip(("query_id", "vec_id", "score"), columns)})

    return run


def top_products(vectors: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                 k: int = 5, scale: float = 256.0, shard_rows: int = SHARD_ROWS,
                 query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``k`` rows with the greatest inner product.

    Components become ``floor(scale * x)``, x as double; scores are exact integers; ties go to the smaller
    id; a query never meets rows of its own id. Queries and rows are dealt to a grid of bounded cells, each
    cell is searched by MaxScore and gives ``k`` rows a query, and these are merged.

    Vectors that are null, or hold a null or non-finite component, take no part. Vectors of different length
    meet on their common components. Repeated query rows count once, repeated rows of the corpus are rows of
    their own. Empty tables give an empty table. Other columns are not read.
    """
    def ready(df: DataFrame) -> DataFrame:
        x = F.col("__v")
        sound = F.forall(x, lambda e: e.isNotNull() & (F.abs(e) < F.lit(float("inf"))))
        return (df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("__v"))
                .filter(F.col("vec_id").isNotNull() & x.isNotNull() & sound)
                .select("vec_id", F.transform(x, lambda e: F.floor(e * F.lit(scale)).cast("double")).alias("v")))

    corpus, asked = ready(vectors), ready(queries).dropDuplicates(["vec_id", "v"])
    cells = max(1, -(-corpus.count() // shard_rows))
    groups = max(1, -(-asked.count() // query_rows))

    def dealt(df: DataFrame, asks: bool, own: int, copies: int) -> DataFrame:
        mine, other = F.pmod(F.xxhash64("vec_id"), F.lit(own)), F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        return df.select("*", F.lit(asks).alias("asks"), mine.cast("int").alias("g" if asks else "c"),
                         other.alias("c" if asks else "g"))

    cell = dealt(corpus, False, cells, groups).unionByName(dealt(asked, True, groups, cells))
    found = cell.groupBy("c", "g").applyInArrow(_search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row whose id 50 divides, against all rows."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_products(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


OP9_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL
             AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5"""
