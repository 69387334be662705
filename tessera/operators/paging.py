"""Sorting, pages, priority order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import number_rows, sort_columns, top_per_key


def page(df: DataFrame, order: Sequence[str], number: int, size: int, max_size: int | None = None) -> DataFrame:
    """One page by offset (O-4, O-5). Spark keeps ``offset + size`` rows per task at most."""
    size = min(size, max_size) if max_size else size
    return df.orderBy(*sort_columns(order)).offset((number - 1) * size).limit(size)


def page_after(df: DataFrame, order: Sequence[str], last: Sequence | None, size: int) -> DataFrame:
    """The page after the row with sort values ``last``.

    Deep pages cost no more than the first one: the filter reaches the scan.
    The order columns must hold no NULLs.
    """
    if last is not None:
        steps, equal = [], F.lit(True)
        for name, value in zip(order, last):
            col = F.col(name.lstrip("-"))
            steps.append(equal & ((col < F.lit(value)) if name.startswith("-") else (col > F.lit(value))))
            equal = equal & (col == F.lit(value))
        df = df.filter(reduce(lambda a, b: a | b, steps))
    return df.orderBy(*sort_columns(order)).limit(size)


def page_envelope(df: DataFrame, number: int, size: int, max_size: int | None = None) -> DataFrame:
    """Total, page, size, pages, has_next and has_prev of a paged list (O-5)."""
    size = min(size, max_size) if max_size else size
    return (df.agg(F.count(F.lit(1)).alias("total"))
            .select("total", F.lit(number).alias("page"), F.lit(size).alias("size"),
                    F.ceil(F.col("total") / size).alias("pages"),
                    (F.lit(number * size) < F.col("total")).alias("has_next"),
                    F.lit(number > 1).alias("has_prev")))


def slice_envelope(df: DataFrame, order: Sequence[str], skip: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Rows and counts of the skip/limit variant (O-5)."""
    data = df.orderBy(*sort_columns(order)).offset(skip).limit(limit)
    counts = df.agg(F.count(F.lit(1)).alias("total")).select(
        "total", F.lit(skip).alias("skip"), F.lit(limit).alias("limit"),
        F.greatest(F.lit(0).cast("bigint"), F.least(F.lit(limit).cast("bigint"), F.col("total") - skip))
        .alias("returned"))
    return data, counts


def drain_order(df: DataFrame, priority: str, tie: str, name: str = "turn", hot_rows: int | None = None) -> DataFrame:
    """Turn of each job when the queue is drained: lowest priority number first (O-6)."""
    return number_rows(df, [], [priority, tie], name, hot_rows)


def reversed_rows(df: DataFrame, order: Sequence[str], name: str = "pos", hot_rows: int | None = None) -> DataFrame:
    """Position counted from the end (O-8)."""
    return number_rows(df, [], [o[1:] if o.startswith("-") else "-" + o for o in order], name, hot_rows)


def arg_max(df: DataFrame, keys: Sequence[str], by: str, tie: str) -> DataFrame:
    """Row with the largest ``by`` per key, the smallest ``tie`` among equals (O-7)."""
    known = df.filter(F.col(by).isNotNull())
    return top_per_key(known, list(keys), ["-" + by, tie], 1, "__rn").drop("__rn").select(
        *keys, *[c for c in df.columns if c not in keys])
