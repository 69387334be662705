"""Joins beyond the plain equi-join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import join_on_keys, list_parts, number_rows, running_over, top_per_key

SMALL_ROWS = 1_000


def small_rows(small: DataFrame, limit: int = SMALL_ROWS) -> list | None:
    """Rows of a table, or None when it has more than ``limit``."""
    found = small.take(limit + 1)
    return None if len(found) > limit else found


def pair_with_small(df: DataFrame, small: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """Each row with each row of a small table (J-3).

    The result has ``limit`` times the rows of ``df`` at most; a larger second
    table is refused, since all pairs of two large tables is not a usable result;
    callers who want more raise ``limit``. An empty second table gives no rows.
    """
    found = small_rows(small, limit)
    if found is None:
        raise ValueError(f"the second table of a cross pairing may hold {limit} rows at most")
    if not found:
        return df.limit(0).select(*df.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in small.schema])
    types = {f.name: f.dataType for f in small.schema.fields}
    values = F.array(*[F.struct(*[F.lit(row[n]).cast(types[n]).alias(n) for n in types]) for row in found])
    return (df.withColumn("__pair", F.explode(values))
            .select(*df.columns, *[F.col(f"__pair.{c}").alias(c) for c in small.columns]))


def newest_child(parents: DataFrame, children: DataFrame, on: tuple[str, str], order: Sequence[str],
                 keep_childless: bool = False) -> DataFrame:
    """Parent with the first of its children in ``order`` (J-4)."""
    parent_key, child_key = on
    first = top_per_key(children, [child_key], order, 1).drop("rn")
    how = "left" if keep_childless else "inner"
    return parents.join(first, parents[parent_key] == first[child_key], how).drop(child_key)


def attach_children(parents: DataFrame, children: DataFrame, on: tuple[str, str], value: str,
                    order: Sequence[str], part_rows: int = 10_000, hot_rows: int | None = None) -> DataFrame:
    """Parents with their children as lists, in parts of bounded length (J-8)."""
    parent_key, child_key = on
    lists = list_parts(children.withColumnRenamed(child_key, "__fk"), ["__fk"], value, order, part_rows,
                       hot_rows=hot_rows)
    return (parents.join(lists, parents[parent_key] == lists["__fk"], "left").drop("__fk")
            .withColumn("part", F.coalesce("part", F.lit(0).cast("bigint"))))


def lookup_batch(requests: DataFrame, table: DataFrame, key: tuple[str, str]) -> DataFrame:
    """One answer per request; unknown ids stay with NULLs (J-9).

    The table is cut down to the distinct ids asked for before it meets the requests.
    """
    asked, known = key
    wanted = requests.select(F.col(asked).alias(known)).distinct()
    found = table.join(wanted, known, "left_semi")
    return requests.join(found, requests[asked] == found[known], "left").drop(known)


def tier_lookup(df: DataFrame, volume: str, tiers: DataFrame, threshold: str, price: str,
                name: str = "tier_price", limit: int = SMALL_ROWS) -> DataFrame:
    """Price of the highest threshold at or below the volume (J-11).

    Below the lowest threshold the lowest tier applies. Of tiers with one
    threshold that with the greatest price counts; a NULL threshold counts for
    nothing. A tier table of
    checked size becomes a literal searched inside each row; a larger one is
    merged with the rows in volume order and carried forward.
    """
    ordered = tiers.select(F.col(threshold).cast("double").alias("t"), F.col(price).alias("p"))
    ordered = ordered.filter("t IS NOT NULL").groupBy("t").agg(F.max("p").alias("p"))
    steps = small_rows(ordered, limit)
    if steps:
        steps = sorted((row["t"], row["p"]) for row in steps)
        kind = ordered.schema["p"].dataType
        if len(steps) <= 32:
            best = F.lit(steps[0][1]).cast(kind)
            for t, p in steps[1:]:
                best = F.when(F.col(volume) >= t, F.lit(p).cast(kind)).otherwise(best)
        else:
            table = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).cast(kind).alias("p")) for t, p in steps])
            at = F.filter(table, lambda s: s["t"] <= F.col(volume))
            best = F.coalesce(F.try_element_at(at, F.lit(-1)), table[0])["p"]
        return df.withColumn(name, F.when(F.col(volume).isNotNull(), best))
    lowest = ordered.agg(F.min("t").alias("__low"))
    rows = join_on_keys(df, lowest, []).withColumn("__at", F.greatest(F.col(volume).cast("double"), "__low"))
    marks = ordered.select(F.col("t").alias("__at"), F.col("t").alias("__tier"), F.lit(0).alias("__kind"))
    merged = rows.withColumn("__kind", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    carried = running_over(merged, [], ["__at", "__kind"], {"__t": ("max", "__tier")})
    priced = carried.filter(F.col("__kind") == 1).join(
        ordered.select(F.col("t").alias("__t"), F.col("p").alias(name)), "__t", "left")
    return (priced.withColumn(name, F.when(F.col(volume).isNotNull(), F.col(name)))
            .select(*df.columns, name))


def positional_join(left: DataFrame, right: DataFrame, orders: tuple[Sequence[str], Sequence[str]],
                    hot_rows: int | None = None) -> DataFrame:
    """The i-th row with the i-th row, up to the end of the shorter table (J-12)."""
    a = number_rows(left, [], orders[0], "pos", hot_rows)
    b = number_rows(right, [], orders[1], "pos", hot_rows)
    return a.join(b, "pos")


def zip_shortest(combine, *arrays: Column) -> Column:
    """``combine`` over the i-th elements, stopping with the shortest array (J-12)."""
    n = F.size(arrays[0]) if len(arrays) == 1 else F.least(*[F.size(a) for a in arrays])
    zipped = F.arrays_zip(*[F.slice(a, F.lit(1), n).alias(f"a{i}") for i, a in enumerate(arrays)])
    return F.transform(zipped, lambda z: combine(*[z[f"a{i}"] for i in range(len(arrays))]))


def order_view(orders: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Denormalised read model of orders (J-13).

    ``orders(order_id, user_id, status)``, ``users(user_id, user_name)``,
    ``items(order_id, amount)``; items are summed before they meet the orders.
    """
    totals = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("item_count"),
                                           F.sum("amount").alias("total_amount"))
    return (orders.join(users, "user_id").join(totals, "order_id", "left")
            .select("order_id", "user_id", "user_name", "status",
                    F.coalesce("item_count", F.lit(0).cast("bigint")).alias("item_count"),
                    F.coalesce("total_amount", F.lit(0)).alias("total_amount")))
