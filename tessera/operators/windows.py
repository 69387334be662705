"""Ranks, rolling frames and positions over ordered rows of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import (frame_over, join_on_keys, number_rows, running_over, top_per_key)


def with_totals(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """Group aggregates next to each row (W-2).

    Aggregate then join: the aggregate is combined before its shuffle, and the
    join back is broadcast or skew-split by Spark at run time.
    """
    return join_on_keys(df, df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()]), keys, "inner")


def centred_average(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, reach: int = 1,
                    name: str = "moving_avg", **sizes) -> DataFrame:
    """Average of the rows up to ``reach`` before and after (W-3)."""
    return frame_over(df, keys, order, reach, reach, {name: F.avg(value)}, **sizes)


def moving_average(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, k: int,
                   name: str = "moving_avg", **sizes) -> DataFrame:
    """Average of the last ``k`` values, of fewer at the start (W-4)."""
    return frame_over(df, keys, order, k - 1, 0, {name: F.avg(value)}, **sizes)


def sliding_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, k: int,
                name: str = "window_max", **sizes) -> DataFrame:
    """Maximum of each full window of ``k`` rows, placed at its last row (W-5)."""
    if k <= 0:
        return df.withColumn(name, F.col(value)).filter(F.lit(False))
    rows = frame_over(df, keys, order, k - 1, 0, {name: F.max(value), "__n": F.count(F.lit(1))}, **sizes)
    return rows.filter(F.col("__n") == k).drop("__n")


def running_average(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                    name: str = "running_avg", **sizes) -> DataFrame:
    """Mean of all values so far, 0 before the first (W-6)."""
    rows = running_over(df, keys, order, {"__s": ("sum", value), "__c": ("count", value)}, **sizes)
    return rows.withColumn(name, F.coalesce(F.try_divide("__s", "__c"), F.lit(0.0))).drop("__s", "__c")


def rolling_counts(df: DataFrame, keys: Sequence[str], order: Sequence[str], item: str, n: int,
                   name: str = "counts", **sizes) -> DataFrame:
    """Counts of the items among the last ``n`` arrivals (W-8).

    The frame holds ``n`` items at most; they are counted inside the row, as
    an array of ``(item, cnt)`` in item order, without zero entries.
    """
    rows = frame_over(df, keys, order, n - 1, 0, {"__last": F.collect_list(item)}, **sizes)
    last = F.col("__last")
    counted = F.transform(F.array_sort(F.array_distinct(last)), lambda x: F.struct(
        x.alias("item"), F.size(F.filter(last, lambda y: y == x)).alias("cnt")))
    return rows.withColumn(name, counted).drop("__last")


def recent_items(df: DataFrame, keys: Sequence[str], item: str, position: str, n: int) -> DataFrame:
    """Last ``n`` distinct items, most recent first (W-9).

    Re-adding moves an item to the front, so its last position decides.
    """
    last = df.groupBy(*keys, item).agg(F.max(position).alias("last_pos"))
    return top_per_key(last, keys, ["-last_pos"], n)


def enumerate_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "idx",
                   hot_rows: int | None = None) -> DataFrame:
    """0-based position (W-10)."""
    return number_rows(df, keys, order, name, hot_rows).withColumn(name, F.col(name) - 1)


def rotate_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, name: str = "idx",
                hot_rows: int | None = None) -> DataFrame:
    """Position after a cyclic shift to the right by ``k`` (left when negative) (W-11)."""
    rows = enumerate_rows(df, keys, order, name, hot_rows)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return (join_on_keys(rows, sizes, keys)
            .withColumn(name, F.pmod(F.col(name) + k, F.col("__n"))).drop("__n"))


def round_robin(df: DataFrame, keys: Sequence[str], order: Sequence[str], tasks: Sequence[str],
                name: str = "task", hot_rows: int | None = None) -> DataFrame:
    """The i-th row gets task ``i mod n`` (W-12)."""
    names = F.array(*[F.lit(x) for x in tasks])
    rows = enumerate_rows(df, keys, order, "__i", hot_rows)
    return rows.withColumn(name, F.get(names, F.pmod("__i", F.lit(len(tasks))).cast("int"))).drop("__i")


def bounded_tail(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    """Last ``k`` rows of each key in ``order`` (W-13)."""
    flipped = [o[1:] if o.startswith("-") else "-" + o for o in order]
    return top_per_key(df, keys, flipped, k).drop("rn")
