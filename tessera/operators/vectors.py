"""Vector arithmetic and nearest neighbours over array columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.ordering import top_per_key
from tessera.session import scratch_path

QUERY_ROWS = 1_000
SHARD_ROWS = 20_000


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def _same_size(a: Column, b: Column, value: Column) -> Column:
    return F.when(F.size(a) == F.size(b), value).when(a.isNull() | b.isNull(), None).otherwise(
        F.raise_error(F.lit("vectors differ in dimension")))


def add(a: Column, b: Column) -> Column:
    """Sum of two vectors; sizes must match (V-1)."""
    return _same_size(a, b, F.zip_with(as_double(a), as_double(b), lambda x, y: x + y))


def subtract(a: Column, b: Column) -> Column:
    return _same_size(a, b, F.zip_with(as_double(a), as_double(b), lambda x, y: x - y))


def shift(v: Column, scalar: Column | float) -> Column:
    """Vector plus a number (V-1)."""
    return F.transform(as_double(v), lambda x: x + scalar)


def scale(v: Column, factor: Column | float) -> Column:
    """Vector times a number (V-1)."""
    return F.transform(as_double(v), lambda x: x * factor)


def divide(v: Column, divisor: Column | float) -> Column:
    """Vector by a number; zero raises (V-1)."""
    d = divisor if isinstance(divisor, Column) else F.lit(float(divisor))
    return F.when(d == 0, F.raise_error(F.lit("division of a vector by zero"))).otherwise(
        F.transform(as_double(v), lambda x: x / d))


def dot(a: Column, b: Column) -> Column:
    """Inner product in double (V-2)."""
    products = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return _same_size(a, b, F.aggregate(products, F.lit(0.0), lambda s, x: s + x))


def magnitude(v: Column) -> Column:
    return F.sqrt(F.aggregate(as_double(v), F.lit(0.0), lambda s, x: s + x * x))


def normalise(v: Column) -> Column:
    """Vector of length one; a zero vector raises (V-2)."""
    lengths = F.array_repeat(magnitude(v), F.size(v))  # outside the lambda, so it is computed once a row
    return F.when(magnitude(v) == 0, F.raise_error(F.lit("a zero vector has no direction"))).otherwise(
        F.zip_with(as_double(v), lengths, lambda x, n: x / n))


def shorter(a: Column, b: Column) -> Column:
    """Order by magnitude (V-3)."""
    return magnitude(a) < magnitude(b)


def any_nonzero(v: Column) -> Column:
    """Truth value of a vector (V-3)."""
    return F.exists(v, lambda x: x != 0)


def apply(v: Column, fn: Callable[[Column], Column]) -> Column:
    return F.transform(as_double(v), fn)


def cosine_distance(a: Column, b: Column) -> Column:
    """``<=>``: one minus the cosine, NULL for a zero vector (V-4)."""
    norms = magnitude(a) * magnitude(b)
    return F.when(norms != 0, F.lit(1.0) - dot(a, b) / norms)


def l2_distance(a: Column, b: Column) -> Column:
    """``<->`` (V-5)."""
    squares = F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y))
    return _same_size(a, b, F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x)))


DISTANCES = {"cosine": cosine_distance, "l2": l2_distance}


def literal_vector(values: Sequence[float]) -> Column:
    return F.lit([float(x) for x in values])


def vector_of(df: DataFrame, key: str, vector: str, value) -> list[float]:
    """One vector of a table, to be used as a query."""
    row = df.filter(F.col(key) == value).select(vector).head()
    if row is None:
        raise KeyError(f"no row with {key} = {value}")
    return [float(x) for x in row[0]]


def nearest(df: DataFrame, query: Sequence[float], key: str, vector: str, k: int, metric: str = "cosine",
            where: Column | None = None) -> DataFrame:
    """Exact k nearest rows, ties by key (V-6); ``where`` is applied before any distance (V-7, V-8).

    The query travels as a literal, the corpus stays in place, and each task
    keeps ``k`` rows.
    """
    rows = df if where is None else df.filter(where)
    distance = DISTANCES[metric](F.col(vector), literal_vector(query))
    return (rows.withColumn("distance", distance).drop(vector)
            .orderBy(F.asc_nulls_last("distance"), key).limit(k))


class _Best:
    """The k nearest rows of each query among the rows shown so far.

    A matrix product gives distances but for rounding; pairs that may be among the best get the distance that
    :func:`nearest` computes, term by term. Only these are kept.
    """

    def __init__(self, ids: list, queries: np.ndarray, k: int, metric: str):
        self.ids, self.queries, self.k, self.cosine = ids, queries, k, metric == "cosine"
        self.norms = np.sqrt(_in_turn(queries * queries))
        self.kept = pd.DataFrame({"q": np.zeros(0, np.int64), "distance": np.zeros(0), "key": np.zeros(0, object)})
        self.bound = np.full(len(queries), np.inf)

    def _rough(self, rows: np.ndarray, norms: np.ndarray) -> np.ndarray:
        products = self.queries @ rows.T
        if self.cosine:
            return 1 - products / np.outer(self.norms, norms)
        return np.sqrt(np.maximum(0, (self.norms ** 2)[:, None] + (norms ** 2)[None, :] - 2 * products))

    def show(self, keys: Sequence, vectors: np.ndarray, step: int = 2_000) -> None:
        if vectors.shape[1:] != self.queries.shape[1:]:
            raise ValueError("vectors differ in dimension")
        keys = np.array([*keys, None], object)[:-1]
        for i in range(0, len(keys), step):
            rows = vectors[i:i + step]
            norms = np.sqrt(_in_turn(rows * rows))
            rough = self._rough(rows, norms)
            bound = self.bound
            if len(rows) > self.k:
                bound = np.minimum(bound, np.partition(rough, self.k - 1, axis=1)[:, self.k - 1])
            size = np.maximum(1, self.norms + norms.max(initial=0))
            q, at = np.nonzero(rough <= (bound + (1e-9 if self.cosine else 1e-6 * size))[:, None])
            if not len(q):
                continue
            if self.cosine:
                exact = 1 - _in_turn(rows[at] * self.queries[q]) / (norms[at] * self.norms[q])
            else:
                gap = rows[at] - self.queries[q]
                exact = np.sqrt(_in_turn(gap * gap))
            both = pd.concat([self.kept, pd.DataFrame({"q": q, "distance": exact, "key": keys[i + at]})])
            both = both.sort_values(["q", "distance", "key"], ignore_index=True)
            self.kept = both[both.groupby("q").cumcount() < self.k]
            full = self.kept.groupby("q")["distance"].agg(["size", "last"])
            full = full[full["size"] == self.k]
            self.bound[full.index.to_numpy()] = full["last"].to_numpy()

    def frame(self, key: str) -> pd.DataFrame:
        return pd.DataFrame({"query_id": [self.ids[i] for i in self.kept["q"]], key: self.kept["key"].to_list(),
                             "distance": self.kept["distance"].to_numpy()})


def _in_turn(products: np.ndarray) -> np.ndarray:
    """Sum of each row, term by term from the left."""
    return np.cumsum(products, axis=1)[:, -1] if products.shape[1] else np.zeros(len(products))


def nearest_each(df: DataFrame, queries: DataFrame, key: str, vector: str, k: int, metric: str = "cosine"
                 ) -> DataFrame:
    """k nearest rows for each row ``(query_id, query)`` of a table of any size (V-6); ties by key.

    Up to ``QUERY_ROWS`` queries travel with the function, and the rows stay where they are: every task keeps
    ``k`` rows a query. More queries are cut into blocks and the rows into shards; each pair of a block and a
    shard is a cell of bounded size that meets in one task, gives matrix products and sends ``k`` rows a query
    on. No row is made for a pair. Rows without a distance (NULL vectors, under cosine also zero ones) come last
    with a NULL distance, before them rows with a component that is not finite. No queries give no rows.
    """
    if metric not in DISTANCES:
        raise ValueError(f"unknown metric {metric}")

    def usable(v: str) -> Column:
        length = magnitude(F.col(v))
        return F.coalesce(length > 0 if metric == "cosine" else length >= 0, F.lit(False))

    def finite(v: str) -> Column:
        return F.forall(v, lambda x: (x > float("-inf")) & (x < float("inf")))

    ready = queries.select("query_id", as_double(F.col("query")).alias("query"))
    rows = df.select(key, as_double(F.col(vector)).alias("__v"))
    kinds = T.StructType([ready.schema["query_id"], rows.schema[key], T.StructField("distance", T.DoubleType())])
    asked = ready.filter(usable("query") & finite("query"))
    given = rows.filter(usable("__v") & finite("__v"))
    count = asked.count()
    if count <= QUERY_ROWS:
        listed = asked.collect()
        ids, matrix = [r[0] for r in listed], np.array([r[1] for r in listed])

        def near(batches):
            best = None
            for pdf in batches:
                if len(pdf) and ids:
                    best = best or _Best(ids, matrix, k, metric)
                    best.show(pdf[key], np.array(pdf["__v"].to_list()))
            if best is not None:
                yield best.frame(key)

        scored = given.mapInPandas(near, kinds)
    else:
        blocks, shards = -(-count // QUERY_ROWS), max(1, -(-given.count() // SHARD_ROWS))

        def dealt(frame, by, own, others, name):
            every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
            return frame.withColumn(own[0], F.pmod(F.xxhash64(*by), F.lit(own[1])).cast("int")).withColumn(name, every)

        left = dealt(given.withColumn("__row", F.monotonically_increasing_id()), ["__row"], ("__shard", shards), blocks, "__block")
        right = dealt(asked, ["query_id"], ("__block", blocks), shards, "__shard")

        def cell(shard, block):
            if not len(shard) or not len(block):
                return pd.DataFrame({n: [] for n in kinds.names})
            best = _Best(block["query_id"].to_list(), np.array(block["query"].to_list()), k, metric)
            best.show(shard[key], np.array(shard["__v"].to_list()))
            return best.frame(key)

        scored = (left.groupBy("__shard", "__block").cogroup(right.groupBy("__shard", "__block"))
                  .applyInPandas(cell, kinds))
    odd = F.when(usable("__v"), F.lit(float("nan")))
    last = rows.filter(~(usable("__v") & finite("__v"))).select(key, odd.alias("distance"))
    last = last.orderBy(F.asc_nulls_last("distance"), key).limit(k)  # k rows, whatever the table's size
    first = rows.orderBy(key).limit(k).select(key, F.lit(None).cast("double").alias("distance"))
    rest = asked.select("query_id").join(F.broadcast(last), F.lit(True)).unionByName(
        ready.filter(~(usable("query") & finite("query"))).select("query_id").join(F.broadcast(first), F.lit(True)))
    return top_per_key(scored.unionByName(rest), ["query_id"], ["distance", key], k)


class ClusteredLists:
    """Vectors stored by nearest centre, with their distance to it, searched a few lists at a time (V-9)."""

    def __init__(self, table: DataFrame, centres: list[list[float]], key: str, vector: str):
        self.table, self.centres, self.key, self.vector = table, centres, key, vector
        self._spans: dict[int, tuple[float, float, int]] | None = None

    @classmethod
    def build(cls, df: DataFrame, key: str, vector: str, lists: int = 100, seed: int = 7,
              sample_rows: int | None = None, path: str | None = None) -> ClusteredLists:
        """Learn centres on a sample of ``sample_rows`` (256 a list by default), assign all rows, write one folder per list.

        Rows of a list are sorted by their distance to its centre, so a search reads the row groups between two
        distances. Vectors without a direction (NULL or zero) are kept in list -1, which every search reads.
        """
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        spark = df.sparkSession
        points = F.coalesce(magnitude(F.col(vector)) > 0, F.lit(False))
        usable = df.filter(points).withColumn("__unit", normalise(F.col(vector)))
        featured = usable.withColumn("__f", array_to_vector("__unit"))
        total, wanted = usable.count(), sample_rows or 256 * lists
        sample = featured.select("__f")
        if total > wanted:
            sample = sample.sample(fraction=min(1.0, wanted / total), seed=seed)
        model = KMeans(k=lists, seed=seed, featuresCol="__f", predictionCol="list_id", maxIter=10).fit(sample)
        path = path or scratch_path(spark, "lists")
        centres = [[float(x) for x in c] for c in model.clusterCenters()]
        centre = F.get(F.lit(centres), F.col("list_id"))
        # Rebalancing splits a list that holds much of the data and merges small ones.
        listed = (model.transform(featured).withColumn("centre_gap", l2_distance(F.col("__unit"), centre))
                  .drop("__f", "__unit").unionByName(df.filter(~points).withColumns(
                      {"list_id": F.lit(-1), "centre_gap": F.lit(None).cast("double")})))
        (listed.hint("rebalance", F.col("list_id")).sortWithinPartitions("list_id", "centre_gap")
         .write.partitionBy("list_id").parquet(path))
        return cls(spark.read.parquet(path), centres, key, vector)

    def _from_centres(self, query: Sequence[float]) -> list[float] | None:
        """Distance of the query's direction to each centre; None if it has no direction."""
        length = sum(x * x for x in query) ** 0.5
        if not length:
            return None
        unit = [x / length for x in query]
        return [sum((a - b) ** 2 for a, b in zip(unit, c)) ** 0.5 for c in self.centres]

    def probe(self, query: Sequence[float], nprobe: int) -> DataFrame:
        """Rows of the lists nearest to the query; other lists are not read. A zero query has no nearest list: all rows."""
        gap = self._from_centres(query)
        if gap is None:
            return self.table
        chosen = sorted(range(len(gap)), key=gap.__getitem__)[:nprobe]
        return self.table.filter(F.col("list_id").isin(-1, *chosen))

    def search(self, query: Sequence[float], k: int, nprobe: int = 10, where: Column | None = None) -> DataFrame:
        """Approximate: the k nearest rows of ``nprobe`` lists."""
        return self._best(self.probe(query, nprobe), query, k, where)

    def _best(self, rows: DataFrame, query, k, where) -> DataFrame:
        return nearest(rows, query, self.key, self.vector, k, where=where).drop("list_id", "centre_gap")

    def spans(self) -> dict[int, tuple[float, float, int]]:
        """Least and greatest distance to the centre and number of rows of each list; one row a list, read once."""
        if self._spans is None:
            found = (self.table.filter("list_id >= 0").groupBy("list_id")
                     .agg(F.min("centre_gap"), F.max("centre_gap"), F.count(F.lit(1))).collect())
            self._spans = {row[0]: (row[1], row[2], row[3]) for row in found}
        return self._spans

    def candidates(self, query: Sequence[float], k: int, where: Column | None = None) -> tuple[DataFrame, list[int]]:
        """Rows that hold the k nearest, and the lists they are read from.

        The nearest lists that hold ``k`` rows together give a k-th distance. On the unit sphere a cosine distance
        ``d`` is a straight one of ``t = sqrt(2 d)``, and by the triangle inequality a row whose distance to its
        centre differs by more than ``t`` from the query's cannot be nearer. So only lists whose span of distances
        comes that close are read, and of each only the rows in between, which lie together in its files. With
        fewer than ``k`` rows found all rows are read.
        """
        gap = self._from_centres(query)
        spans = self.spans()
        if gap is None:
            return self.table, [-1, *spans]
        first, held = [], 0
        for i in sorted(spans, key=lambda i: gap[i]):
            first.append(i)
            held += spans[i][2]
            if held >= k:
                break
        near = self._best(self.table.filter(F.col("list_id").isin(first)), query, k, where).select("distance").collect()
        if len(near) < k:
            return self.table, [-1, *spans]
        t = (2 * max(0.0, max(row[0] for row in near))) ** 0.5 + 1e-6  # above the rounding of both distances
        chosen = [i for i, (low, high, _) in spans.items() if low - t <= gap[i] <= high + t]
        inside = F.lit(False)
        for i in chosen:
            inside = inside | ((F.col("list_id") == i) & F.col("centre_gap").between(gap[i] - t, gap[i] + t))
        return self.table.filter(inside), chosen

    def search_exact(self, query: Sequence[float], k: int, where: Column | None = None) -> DataFrame:
        """The k nearest rows of all, as :func:`nearest` gives them, from the lists and rows that can hold them."""
        return self._best(self.candidates(query, k, where)[0], query, k, where)
