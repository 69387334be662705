"""Rows from literals, frames, CSV, text, databases; documents of differing fields."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.strings import strip


def typed_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """Lists of values under a DDL schema (S-2)."""
    return spark.createDataFrame(rows, schema)


def from_pandas(spark: SparkSession, frame: pd.DataFrame, schema: str | None = None) -> DataFrame:
    """A pandas frame, types inferred or declared (S-3)."""
    return spark.createDataFrame(frame, schema) if schema else spark.createDataFrame(frame)


def spread(scan: DataFrame) -> DataFrame:
    """Give each core work when a scan has fewer partitions than cores.

    For small tables with much work per row, such as texts. A large table has
    more splits than cores and is left as it is. Takes a scan, not a joined or
    grouped frame.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row, all values text (S-4). Partitions take the place of chunks."""
    return spark.read.option("header", True).option("multiLine", False).csv(path)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a file, white space cut at both ends (S-5)."""
    return spark.read.text(path).select(strip(F.col("value")).alias("line"))


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with its whole content (S-6)."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"),
                                                        F.col("value").alias("content"))


def jdbc_rows(spark: SparkSession, url: str, query: str, split: tuple[str, int, int, int] | None = None,
              **options) -> DataFrame:
    """Rows of a database query (S-13), read in parallel when ``split`` is
    ``(column, low, high, parts)``."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if split is None:
        return reader.option("query", query).load()
    column, low, high, parts = split
    return (reader.option("dbtable", f"({query}) q").option("partitionColumn", column).option("lowerBound", low)
            .option("upperBound", high).option("numPartitions", parts).load())


def bound_query(spark: SparkSession, query: str, args: dict, **frames: DataFrame) -> DataFrame:
    """SQL over named frames with bound parameters (S-13)."""
    return spark.sql(query, args=args, **frames)


def insert_documents(target: DataFrame, documents: DataFrame) -> DataFrame:
    """Append documents whose fields may differ; a missing field is NULL (S-16)."""
    return target.unionByName(documents, allowMissingColumns=True)


def concatenate(*frames: DataFrame, name: str = "source") -> DataFrame:
    """All of the first, then of the second and so on, with the source's number (S-8)."""
    out = None
    for i, frame in enumerate(frames):
        marked = frame.withColumn(name, F.lit(i))
        out = marked if out is None else out.unionByName(marked)
    return out


def range_rows(spark: SparkSession, start: int, stop: int, step: int = 1) -> DataFrame:
    """Half-open range, up or down (S-7)."""
    if step < 0:
        n = max(0, (start - stop - step - 1) // -step)
        return spark.range(n).select((F.lit(start) + F.col("id") * step).alias("id"))
    return spark.range(start, stop, step)


def range_length(start: Column, stop: Column, step: int) -> Column:
    """Number of values in the range (S-7)."""
    return F.greatest(F.ceil((stop - start) / step), F.lit(0).cast("bigint"))


def in_range(value: Column, start: Column, stop: Column, step: int) -> Column:
    """Membership without making the values (S-7)."""
    inside = (value >= start) & (value < stop) if step > 0 else (value <= start) & (value > stop)
    return inside & ((value - start) % step == 0)


def range_at(start: Column, stop: Column, step: int, index: Column) -> Column:
    """Value at an index, negative from the end, NULL outside (S-7)."""
    n = range_length(start, stop, step)
    at = F.when(index < 0, index + n).otherwise(index)
    return F.when((at >= 0) & (at < n), start + at * step)


def range_values(start: Column, stop: Column, step: int) -> Column:
    """The range as an array, empty when it holds nothing (S-7)."""
    n = range_length(start, stop, step)
    empty = F.array().cast("array<bigint>")
    last = start + (n - 1) * step
    return F.when(n > 0, F.sequence(start.cast("bigint"), last.cast("bigint"), F.lit(step).cast("bigint"))).otherwise(empty)


def fibonacci(n: Column) -> Column:
    """First ``n`` Fibonacci numbers, exact to 38 digits (S-9)."""
    kind = "decimal(38,0)"
    zero, one = F.lit(0).cast(kind), F.lit(1).cast(kind)
    start = F.struct(zero.alias("a"), one.alias("b"), F.array().cast(f"array<{kind}>").alias("out"))
    steps = F.sequence(F.lit(1), F.greatest(n.cast("int"), F.lit(1)))
    made = F.aggregate(steps, start, lambda s, _: F.struct(
        s["b"].alias("a"), (s["a"] + s["b"]).cast(kind).alias("b"), F.array_append(s["out"], s["a"]).alias("out")))
    return F.when(n > 0, made["out"]).otherwise(F.array().cast(f"array<{kind}>"))


def countdown(n: Column) -> Column:
    """``n`` down to 1 (S-9)."""
    return range_values(n.cast("bigint"), F.lit(0).cast("bigint"), -1)


class ResultCache:
    """Results kept under a name until a write clears them (S-14)."""

    def __init__(self):
        self._kept: dict[str, DataFrame] = {}

    def get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._kept:
            self._kept[name] = build().persist()
        return self._kept[name]

    def clear(self) -> None:
        for df in self._kept.values():
            df.unpersist()
        self._kept.clear()

    def write(self, action: Callable[[], object]):
        """Run a write, then forget all kept results."""
        out = action()
        self.clear()
        return out


def inspect(df: DataFrame) -> dict:
    """Schema text, first row and partition count (S-15)."""
    return {"schema": df.schema.simpleString(), "first": df.take(1), "partitions": df.rdd.getNumPartitions()}
