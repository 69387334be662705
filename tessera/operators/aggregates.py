"""Counting, top lists, exact percentiles, grouping into lists, roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import (_either, join_on_keys, list_parts, number_rows, split_hot, top_per_key,
                                        weighted_places)
from tessera.session import cut_lineage

# Words left out of the content-word count.
STOP_WORDS = ["the", "is", "and", "with", "are", "a", "an", "in", "on", "at"]

# Fixed value: a run of plain letters with no letter, digit or underscore beside it.
PLAIN_WORD = r"(?<![\p{L}\p{N}_])[a-z]++(?![\p{L}\p{N}_])"


def tokens(text: Column) -> Column:
    """Lower-case words of plain letters, bounded like Python's ``\\b[a-zA-Z]+\\b`` (trap 6)."""
    return F.regexp_extract_all(F.lower(text), F.lit(PLAIN_WORD), F.lit(0))


def most_common(df: DataFrame, item: str, position: str, n: int, least: bool = False) -> DataFrame:
    """Top or bottom ``n`` items by count, ties by first occurrence (G-A6, G-A7).

    The bottom list is the end of the full ranking, read backwards.
    """
    counts = df.groupBy(item).agg(F.count(F.lit(1)).alias("cnt"), F.min(position).alias("first_pos"))
    order = ([F.asc("cnt"), F.desc("first_pos"), F.desc(item)] if least
             else [F.desc("cnt"), F.asc("first_pos"), F.asc(item)])
    return counts.orderBy(*order).limit(n)


def percentile_exact(df: DataFrame, keys: Sequence[str], value: str, p: float, name: str = "pct",
                     hot_rows: int | None = None) -> DataFrame:
    """Interpolated percentile per key (G-A3).

    Spark's own aggregate keeps every distinct value of a group in one buffer. For groups above ``hot_rows`` rows
    are counted per value, equal ones before the shuffle, and the one or two values at the wanted rank are read
    off the prefix sums of the counts.
    """
    rows = df.select(*keys, value).filter(F.col(value).isNotNull())
    cold, hot, _ = split_hot(rows, keys, hot_rows)
    if cold is not None:
        cold = cold.groupBy(*keys).agg(F.percentile(value, p).alias(name))
    if hot is not None:
        hot = _percentile_of_places(hot, keys, value, p, name, hot_rows)
    return _either(cold, hot)


def _percentile_of_places(hot: DataFrame, keys: Sequence[str], value: str, p: float, name: str,
                          hot_rows: int | None) -> DataFrame:
    places = cut_lineage(weighted_places(hot, keys, [value], hot_rows))
    sizes = places.groupBy(*keys).agg(F.sum("weight").alias("__n"))  # one row for each hot key
    at = (F.col("__n") - 1) * p + 1
    low, share = F.floor(at), at - F.floor(at)

    def holds(rank):
        return (F.col("upto") >= rank) & (F.col("upto") - F.col("weight") < rank)

    part = F.when(holds(low), 1 - share).otherwise(0.0) + F.when(holds(low + 1), share).otherwise(0.0)
    near = join_on_keys(places, F.broadcast(sizes), keys).filter(holds(low) | (holds(low + 1) & (share > 0)))
    return near.groupBy(*keys).agg(F.sum(F.col(value) * part).alias(name))


def latency_stats(df: DataFrame, keys: Sequence[str], value: str, hot_rows: int | None = None) -> DataFrame:
    """Count, total, mean, extremes and median per key (G-A19): one pass, and the median of hot keys by their counts."""
    def stats(rows, *more):
        return rows.groupBy(*keys).agg(
            F.count(value).alias("calls"), F.sum(value).alias("total_time"), F.avg(value).alias("avg_time"),
            F.min(value).alias("min_time"), F.max(value).alias("max_time"), *more)

    cold, hot, _ = split_hot(df.select(*keys, value), keys, hot_rows)
    if cold is not None:
        cold = stats(cold, F.percentile(value, 0.5).alias("median_time"))
    if hot is not None:
        median = _percentile_of_places(hot.filter(F.col(value).isNotNull()), keys, value, 0.5, "median_time", hot_rows)
        hot = join_on_keys(stats(hot), F.broadcast(median), keys)  # one row for each hot key
    return _either(cold, hot)


def text_profile(df: DataFrame, keys: Sequence[str], text: str, top: int = 5) -> tuple[DataFrame, DataFrame]:
    """Token statistics and top content words per key (G-A9).

    Tokens are counted per (key, word) first; the totals follow from these counts.
    """
    words = df.select(*keys, F.explode(tokens(F.col(text))).alias("word"))
    counts = words.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("cnt"))
    totals = counts.groupBy(*keys).agg(F.sum("cnt").alias("total_words"), F.count(F.lit(1)).alias("unique_words"))
    stats = totals.withColumn("richness", F.col("unique_words") / F.col("total_words"))
    content = counts.filter(~F.col("word").isin(STOP_WORDS))
    return stats, top_per_key(content, keys, ["-cnt", "word"], top)


def top_words(df: DataFrame, key: str, text: str, top: int = 3) -> DataFrame:
    """Most frequent words of each document, ties by first occurrence (G-A13).

    Words are counted per document before the shuffle, so only distinct words of a document travel.
    """
    words = tokens(F.col(text))
    rows = df.select(key, F.posexplode(words).alias("at", "word"))
    counts = rows.groupBy(key, "word").agg(F.count(F.lit(1)).alias("cnt"), F.min("at").alias("first_at"))
    return top_per_key(counts, [key], ["-cnt", "first_at"], top)


def quality_profile(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Value distribution and missing count of several columns in one pass (G-A10)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"))
                                for c in columns]))
    counts = (df.select(pairs.alias("e")).groupBy("e.field", F.coalesce("e.value", F.lit("NULL")).alias("value"))
              .agg(F.count(F.lit(1)).alias("cnt")))
    gone = F.col("value").isin("NULL", "")
    missing = counts.groupBy("field").agg(F.sum(F.when(gone, F.col("cnt")).otherwise(0)).alias("missing"))
    return counts, missing


def top_items(df: DataFrame, category: str, item: str, n: int) -> DataFrame:
    """Items per category with the category total, first ``n`` only (G-A11)."""
    counts = df.groupBy(category, item).agg(F.count(F.lit(1)).alias("cnt"))
    totals = counts.groupBy(category).agg(F.sum("cnt").alias("total"))
    return top_per_key(counts, [category], ["-cnt", item], n).join(totals, category)


def nested_counts(df: DataFrame, outer: str, inner: str, item: str = "hits", part_rows: int = 10_000,
                  hot_rows: int | None = None) -> DataFrame:
    """``outer, part -> {inner: count}``, the inner map ordered by key, in parts of bounded length (G-A12).

    A map holds up to ``part_rows`` keys; more continue in part 1, 2 and so on. A key stands in one part only.
    """
    counts = df.groupBy(outer, inner).agg(F.count(F.lit(1)).alias("cnt"))
    return nest_levels(counts, [outer, inner], F.col("cnt"), item, part_rows, hot_rows)


def group_sets(df: DataFrame, keys: Sequence[str], value: str, part_rows: int = 10_000,
               hot_rows: int | None = None) -> DataFrame:
    """Distinct values of each key in order, in parts of bounded length (G-A16)."""
    return list_parts(df.select(*keys, value).distinct(), keys, value, [value], part_rows, hot_rows=hot_rows)


def nest_levels(df: DataFrame, levels: Sequence[str], leaf: Column, name: str = "tree",
                part_rows: int | None = 10_000, hot_rows: int | None = None) -> DataFrame:
    """Nested maps from the last level up to the first, in parts of bounded size or whole (G-A17).

    ``df`` holds one row per combination of levels. Output: the first level, ``part`` and the tree. The leaves below
    one first level are numbered in the order of all levels and dealt to parts of ``part_rows`` leaves, so no row
    grows with the data at any level: an inner key whose leaves go beyond a part goes on under the same key in the
    next. Each leaf stands in one part, so the parts of a tree merge by their keys. With ``part_rows=None`` a first
    level is one row with its whole tree and no ``part``, which grows with the different keys below it. Levels below
    the first are map keys and must not be null.
    """
    rows, cut = df.select(*levels, leaf.alias("__leaf")), []
    if part_rows is not None:
        rows, cut = number_rows(rows, levels[:1], levels[1:], "__pos", hot_rows), ["part"]
        rows = rows.withColumn("part", F.floor((F.col("__pos") - 1) / part_rows))

    def by_key(a, b):
        return F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0)

    for depth in range(len(levels) - 1, 0, -1):
        children = F.collect_list(F.struct(F.col(levels[depth]).alias("k"), F.col("__leaf").alias("v")))
        rows = rows.groupBy(*levels[:depth], *cut).agg(
            F.map_from_entries(F.array_sort(children, by_key)).alias("__leaf"))
    return rows.select(levels[0], *cut, F.col("__leaf").alias(name))


def folds(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Sum, product and maximum (G-A20)."""
    return df.groupBy(*keys).agg(F.sum(value).alias("total"), F.product(value).alias("product"),
                                 F.max(value).alias("largest"))


def health(df: DataFrame, keys: Sequence[str], status: str) -> DataFrame:
    """All healthy, else any unhealthy, else degraded (G-A22)."""
    col = F.col(status)
    return df.groupBy(*keys).agg(
        F.when(F.every(col == "healthy"), "healthy").when(F.some(col == "unhealthy"), "unhealthy")
         .otherwise("degraded").alias("overall"))


def sum_of_squares(df: DataFrame, value: str, name: str = "total") -> DataFrame:
    """Sum of squares without overflow (G-A24).

    A square that fits 63 bits is summed as three limbs of 21 bits in plain long
    arithmetic, good for 2^42 rows. Larger values are found by a range filter,
    which the scan can answer from its statistics, and summed as decimals.
    """
    v = F.col(value).cast("bigint")
    top = 3_037_000_499
    square = F.when(v.between(-top, top), v * v)
    mask = F.lit((1 << 21) - 1)
    limbs = df.agg(*[F.sum(F.shiftright(square, 21 * i).bitwiseAND(mask)).alias(f"__l{i}") for i in range(3)])
    wide = v.cast("decimal(19,0)")
    large = df.filter((v > top) | (v < -top)).agg(F.sum(wide * wide).alias("__large"))

    def part(name: str, scale: int) -> Column:
        return F.coalesce(F.col(name).cast("decimal(24,0)") * F.lit(scale).cast("decimal(14,0)"), F.lit(0))

    total = part("__l0", 1) + part("__l1", 1 << 21) + part("__l2", 1 << 42) + F.coalesce("__large", F.lit(0))
    return join_on_keys(limbs, large, []).select(total.cast("decimal(38,0)").alias(name))


def hit_rate(df: DataFrame, keys: Sequence[str], hit: Column) -> DataFrame:
    """Hits, misses and hits by calls, 0 without calls (G-A25)."""
    counted = df.groupBy(*keys).agg(F.count_if(hit).alias("hits"), F.count_if(~hit).alias("misses"))
    calls = F.col("hits") + F.col("misses")
    return counted.withColumn("hit_rate", F.coalesce(F.try_divide("hits", calls), F.lit(0.0)))
