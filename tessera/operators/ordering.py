"""Row order, frames and per-key scans on groups of any size.

A Spark window puts one key into one task. That is the best plan as long as
every group fits a task, so each operator here first measures the largest
group (one map-side combined count). Groups above ``hot_rows`` take another,
equally exact way: they are range-sorted across tasks, numbered from
per-partition counts, and cut into blocks of bounded size.

``order`` entries are column names, ``"-name"`` for descending; NULLs come
last either way. An order should be total (end in a unique column) for the
result to be determined.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage

HOT_ROWS = 2_000_000
BLOCK_ROWS = 500_000

_LOCAL_MASK = (1 << 33) - 1


def order_names(order: Sequence[str]) -> list[str]:
    return [o.lstrip("-") for o in order]


def sort_columns(order: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_last(o[1:]) if o.startswith("-") else F.asc_nulls_last(o) for o in order]


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of the key columns of two frames."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on null-safe keys and keep one copy of them; no keys means ``right`` is one row."""
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    if not keys:
        return left.join(F.broadcast(renamed), F.lit(True), how)
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def split_hot(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None
              ) -> tuple[DataFrame | None, DataFrame | None, DataFrame | None]:
    """``(rows of ordinary groups, rows of hot groups, hot keys)``.

    Only the key columns are read for the count. The list of hot keys holds
    at most ``rows / hot_rows`` entries, so it may be broadcast.
    """
    limit = HOT_ROWS if hot_rows is None else hot_rows
    if not keys:
        return (None, df, None) if df.count() > limit else (df, None, None)
    hot = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
             .filter(F.col("__n") > limit).select(*keys))
    if not hot.take(1):
        return df, None, None
    hot = F.broadcast(cut_lineage(hot))
    same = same_keys(df, hot, keys)
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi"), hot


def _either(cold: DataFrame | None, hot: DataFrame | None) -> DataFrame:
    if hot is None:
        return cold
    return hot if cold is None else cold.unionByName(hot)


def _number_by_range(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Position within the key for groups too large for one task.

    The range sort is written out before it is counted: its bounds come from a
    sample, so a second run could place rows differently. Rows equal in the order
    are told apart by their place in the input, so ties are split between tasks too.
    """
    sort = [*[F.asc_nulls_last(k) for k in keys], *sort_columns(order), F.asc("__tie")]
    df = df.withColumn("__tie", F.monotonically_increasing_id())
    ranged = cut_lineage(df.repartitionByRange(*sort).sortWithinPartitions(*sort).drop("__tie")
                           .withColumn("__id", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("__part", F.shiftright("__id", 33))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
                     .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off")))
    placed = (ranged.join(F.broadcast(offsets), "__part")
                    .withColumn(name, F.col("__id").bitwiseAND(F.lit(_LOCAL_MASK)) + F.col("__off") + 1)
                    .drop("__part", "__id", "__off"))
    if not keys:
        return placed
    starts = placed.groupBy(*keys).agg((F.min(name) - 1).alias("__start"))
    return (join_on_keys(placed, F.broadcast(starts), keys)
            .withColumn(name, F.col(name) - F.col("__start")).drop("__start"))


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "pos",
                hot_rows: int | None = None) -> DataFrame:
    """Add the 1-based position of each row within its key."""
    cold, hot, _ = split_hot(df, keys, hot_rows)
    if cold is not None:
        w = Window.partitionBy(*keys).orderBy(*sort_columns(order))
        cold = cold.withColumn(name, F.row_number().over(w).cast("bigint"))
    if hot is not None:
        hot = _number_by_range(hot, keys, order, name)
    return _either(cold, hot)


def rank_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rank",
              hot_rows: int | None = None) -> DataFrame:
    """SQL ``RANK()``: equal order values share the lowest position."""
    cold, hot, _ = split_hot(df, keys, hot_rows)
    if cold is not None:
        w = Window.partitionBy(*keys).orderBy(*sort_columns(order))
        cold = cold.withColumn(name, F.rank().over(w).cast("bigint"))
    if hot is not None:
        by = [*keys, *order_names(order)]
        limit = HOT_ROWS if hot_rows is None else hot_rows
        ranks = cut_lineage(weighted_places(hot, keys, order, hot_rows).select(
            *by, "weight", (F.col("upto") - F.col("weight") + 1).alias(name)))
        # a value with very many rows meets its rank without a shuffle; there are at most rows / limit of them
        heavy = F.broadcast(ranks.filter(F.col("weight") > limit).select(*by, name))
        light = ranks.filter(F.col("weight") <= limit).select(*by, name)
        hot = join_on_keys(hot, heavy, by, "inner").unionByName(
            join_on_keys(hot.join(heavy, same_keys(hot, heavy, by), "left_anti"), light, by, "inner"))
    return _either(cold, hot)


def weighted_places(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """The keys, each distinct value of the order columns, its ``weight`` in rows, and ``upto``, the rows up to it.

    Rows are counted per value before the shuffle, so a value that most rows share is one row; the weights'
    prefix sums run over distinct values and split keys that have very many.
    """
    counts = cut_lineage(df.groupBy(*keys, *order_names(order)).agg(F.count(F.lit(1)).alias("weight")))
    return running_over(counts, keys, order, {"upto": ("sum", "weight")}, hot_rows)


def _blocked(hot: DataFrame, keys: Sequence[str], order: Sequence[str], block_rows: int) -> DataFrame:
    return (_number_by_range(hot, keys, order, "__pos")
            .withColumn("__block", F.floor((F.col("__pos") - 1) / block_rows)))


def frame_over(df: DataFrame, keys: Sequence[str], order: Sequence[str], before: int, after: int,
               aggs: dict[str, Column], hot_rows: int | None = None,
               block_rows: int | None = None) -> DataFrame:
    """Aggregates over the rows from ``before`` ahead to ``after`` behind each row.

    Hot groups are cut into blocks; a row near an edge is copied to the
    neighbouring block as context and dropped again after the frame is taken.
    """
    cold, hot, _ = split_hot(df, keys, hot_rows)
    if cold is not None:
        w = Window.partitionBy(*keys).orderBy(*sort_columns(order)).rowsBetween(-before, after)
        cold = cold.select("*", *[a.over(w).alias(n) for n, a in aggs.items()])
    if hot is not None:
        size = max(block_rows or BLOCK_ROWS, before + after + 1)
        rows = _blocked(hot, keys, order, size)
        low = F.floor((F.greatest(F.col("__pos") - after, F.lit(1)) - 1) / size)
        high = F.floor((F.col("__pos") + before - 1) / size)
        rows = rows.withColumn("__into", F.explode(F.sequence(low, high)))
        w = Window.partitionBy(*keys, "__into").orderBy("__pos").rowsBetween(-before, after)
        hot = (rows.select("*", *[a.over(w).alias(n) for n, a in aggs.items()])
                   .filter(F.col("__into") == F.col("__block")).drop("__into", "__block", "__pos"))
    return _either(cold, hot)


_MERGE = {
    "sum": (F.sum, lambda a, b: a + b),
    "count": (F.count, lambda a, b: a + b),
    "product": (F.product, lambda a, b: a * b),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
}


def running_over(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 folds: dict[str, tuple[str, str]], hot_rows: int | None = None,
                 block_rows: int | None = None) -> DataFrame:
    """Running folds from the first row of the key to the current one.

    ``folds`` maps an output name to ``(kind, column)``, kind one of sum,
    count, product, min, max. Hot groups fold each block on its own and then
    combine with the fold of the blocks before it.
    """
    cold, hot, _ = split_hot(df, keys, hot_rows)
    if cold is not None:
        w = (Window.partitionBy(*keys).orderBy(*sort_columns(order))
             .rowsBetween(Window.unboundedPreceding, 0))
        cold = cold.select("*", *[_MERGE[k][0](F.col(c)).over(w).alias(n) for n, (k, c) in folds.items()])
    if hot is not None:
        rows = _blocked(hot, keys, order, block_rows or BLOCK_ROWS)
        by = [*keys, "__block"]
        totals = rows.groupBy(*by).agg(*[_MERGE[k][0](F.col(c)).alias(n) for n, (k, c) in folds.items()])
        upto = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
        outer = {"count": F.sum}
        carried = totals.select(*by, *[outer.get(k, _MERGE[k][0])(F.col(n)).over(upto).alias(f"__c_{n}")
                                       for n, (k, _) in folds.items()])
        w = Window.partitionBy(*by).orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.select("*", *[_MERGE[k][0](F.col(c)).over(w).alias(n) for n, (k, c) in folds.items()])
        rows = join_on_keys(rows, carried, by)
        for n, (k, _) in folds.items():
            both = _MERGE[k][1](F.col(f"__c_{n}"), F.col(n))
            rows = rows.withColumn(n, F.coalesce(both, F.col(f"__c_{n}"), F.col(n)))
        hot = rows.drop("__pos", "__block", *[f"__c_{n}" for n in folds])
    return _either(cold, hot)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int,
                name: str = "rn") -> DataFrame:
    """First ``k`` rows of each key.

    Up to Spark's threshold for it (1,000 by default) every map task is limited
    to ``k`` rows per key before the shuffle, so a hot key sends few rows. For
    larger ``k`` the rows are numbered, which splits hot keys between tasks.
    """
    if k > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        return number_rows(df, keys, order, name).filter(F.col(name) <= k)
    w = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    return df.withColumn(name, F.row_number().over(w).cast("bigint")).filter(F.col(name) <= k)


def list_parts(df: DataFrame, keys: Sequence[str], value: Column | str, order: Sequence[str],
               part_rows: int = 10_000, name: str = "values", hot_rows: int | None = None) -> DataFrame:
    """Group values into ordered lists of at most ``part_rows`` entries.

    Output: the keys, ``part`` (0 for the first list of a key) and the list.
    Nothing is dropped: a long group continues in part 1, 2 and so on.
    """
    item = F.col(value) if isinstance(value, str) else value
    numbered = number_rows(df, keys, order, "__pos", hot_rows)
    entry = F.struct(F.col("__pos"), item.alias("v"))
    return (numbered.withColumn("part", F.floor((F.col("__pos") - 1) / part_rows))
            .groupBy(*keys, "part")
            .agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["v"]).alias(name)))


def _scan(columns: list[str], keys: list[str], uses: list[str], step: Callable, fields: list[str],
          exits_only: bool) -> Callable[[Iterable[pd.DataFrame]], Iterable[pd.DataFrame]]:
    """Batch function that walks sorted rows and carries one state at a time."""

    def run(batches):
        current, state = object(), None
        for pdf in batches:
            ids = list(zip(*[pdf[c].astype(object).where(pdf[c].notna(), None) for c in (*keys, "__block")]))
            outs, ends = [], []
            args = zip(*[pdf[c] for c in uses])
            for ident, entry, values in zip(ids, pdf["__entry"], args):
                if ident != current:
                    if exits_only and isinstance(current, tuple):
                        ends.append((*current, json.dumps(state, sort_keys=True)))
                    current = ident
                    state = json.loads(entry) if isinstance(entry, str) else None
                state, out = step(state, *values)
                outs.append(out)
            if exits_only:
                if ends:
                    yield pd.DataFrame(ends, columns=[*keys, "__block", "__exit"])
            else:
                result = pdf[columns].copy()
                for i, f in enumerate(fields):
                    result[f] = [o[i] for o in outs]
                yield result
        if exits_only and isinstance(current, tuple):
            yield pd.DataFrame([(*current, json.dumps(state, sort_keys=True))],
                               columns=[*keys, "__block", "__exit"])

    return run


def _summaries(keys: list[str], uses: list[str], step: Callable) -> Callable:
    """Batch function that walks each block from every entry its rule can have, as ``[[entry, exit], ...]``.

    Entries whose states have become equal are walked as one from then on.
    """

    def merged(walks):
        by_state = {}
        for names, state in walks:
            by_state.setdefault(json.dumps(state, sort_keys=True), ([], state))[0].extend(names)
        return list(by_state.values())

    def said(ident, walks):
        pairs = [[name, state] for names, state in walks for name in names]
        return (*ident, json.dumps(pairs))

    def run(batches):
        current, walks, walked = None, [], 0
        for pdf in batches:
            ids = list(zip(*[pdf[c].astype(object).where(pdf[c].notna(), None) for c in (*keys, "__block")]))
            done = []
            for ident, values in zip(ids, zip(*[pdf[c] for c in uses])):
                if ident != current:
                    if current is not None:
                        done.append(said(current, merged(walks)))
                    current, walked = ident, 0
                    walks = [([name], state) for name, state in step.entries]
                walks = [(names, step(state, *values)[0]) for names, state in walks]
                walked += 1
                if len(walks) > 1 and walked % 64 == 0:
                    walks = merged(walks)
            if done:
                yield pd.DataFrame(done, columns=[*keys, "__block", "__sum"])
        if current is not None:
            yield pd.DataFrame([said(current, merged(walks))], columns=[*keys, "__block", "__sum"])

    return run


def _entries(keys: list[str], step: Callable) -> Callable:
    """Batch function that goes along the blocks of a key, from summary to summary, to the state each is entered with."""

    def run(batches):
        current, state, known = object(), None, True
        for pdf in batches:
            ids = list(zip(*[pdf[c].astype(object).where(pdf[c].notna(), None) for c in keys])) if keys else [()] * len(pdf)
            out = []
            for ident, block, pairs in zip(ids, pdf["__block"], pdf["__sum"]):
                if ident != current:
                    current, state, known = ident, None, True
                out.append((*ident, block, None if state is None else json.dumps(state, sort_keys=True), known))
                found = dict(json.loads(pairs)).get(step.entry_of(state)) if known else None
                known = known and found is not None
                state = step.fill(found, state) if known else None
            yield pd.DataFrame(out, columns=[*keys, "__block", "__entry", "__known"])

    return run


def fold_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], uses: Sequence[str],
              step: Callable, adds: str, hot_rows: int | None = None,
              block_rows: int | None = None) -> DataFrame:
    """Per-key sequential logic: each row's outcome depends on earlier outcomes.

    ``step(state, *values)`` takes the state (``None`` at first, otherwise
    anything JSON can hold) and the values of the ``uses`` columns; it returns
    the next state and a tuple for the columns declared in ``adds`` (a DDL
    string).

    Ordinary keys are sorted inside their partitions and walked batch by batch, holding one state in memory. A
    hot key is cut into blocks that are walked in parallel. If the step names the entries it can have
    (``entries``, ``entry_of``, ``fill``, see :mod:`tessera.operators.steps`), a block is a map from entry to
    exit: one pass makes the maps, one row a block goes from map to map, and a second pass walks the rows from
    the states found, whatever the number of blocks. Other rules are walked from a supposed entry state (at
    first the empty one); blocks whose supposed entry differs from the exit of the block before are walked again
    until nothing changes. The first block is right from the start and each round settles at least one more, so
    the result is exact; states that forget their start settle in a few rounds.
    """
    keys, uses = list(keys), list(uses)
    columns = df.columns
    added = T.StructType.fromDDL(adds)
    schema = T.StructType([*df.schema.fields, *added.fields])
    fields = added.names
    cold, hot, _ = split_hot(df, keys, hot_rows)

    def walk(rows: DataFrame, exits_only: bool = False) -> DataFrame:
        by = [*keys, "__block"]
        rows = rows.repartition(*by).sortWithinPartitions(*by, *sort_columns(order))
        out = (T.StructType([*[df.schema[k] for k in keys], T.StructField("__block", T.LongType()),
                             T.StructField("__exit", T.StringType())]) if exits_only else schema)
        return rows.mapInPandas(_scan(columns, keys, uses, step, fields, exits_only), out)

    if cold is not None:
        cold = walk(cold.withColumn("__block", F.lit(0).cast("bigint"))
                        .withColumn("__entry", F.lit(None).cast("string")))
    def kinds(*more: T.StructField) -> T.StructType:
        return T.StructType([*[df.schema[k] for k in keys], T.StructField("__block", T.LongType()), *more])

    def composed(rows: DataFrame) -> DataFrame | None:
        """Entry state of each block by its maps; None if the rule has none or a state beyond them turned up."""
        if not hasattr(step, "entries"):
            return None
        by = [*keys, "__block"]
        maps = (rows.repartition(*by).sortWithinPartitions(*by, *sort_columns(order))
                .mapInPandas(_summaries(keys, uses, step), kinds(T.StructField("__sum", T.StringType()))))
        maps = cut_lineage(maps)
        lined = maps.repartition(*keys) if keys else maps.coalesce(1)
        found = cut_lineage(lined.sortWithinPartitions(*by).mapInPandas(_entries(keys, step), kinds(
            T.StructField("__entry", T.StringType()), T.StructField("__known", T.BooleanType()))))
        return None if found.filter("NOT __known").take(1) else found.drop("__known")

    def by_rounds(rows: DataFrame) -> DataFrame:
        """Entry state of each block by walking blocks again whose entry was wrong."""
        by = [*keys, "__block"]
        nothing = F.lit(None).cast("string")
        used = rows.select(*by).distinct().withColumn("__entry", nothing)
        exits = cut_lineage(walk(rows.withColumn("__entry", nothing), exits_only=True))
        while True:
            follow = exits.select(*keys, (F.col("__block") + 1).alias("__block"),
                                  F.col("__exit").alias("__next"))
            wanted = join_on_keys(used, follow, by)
            stale = F.coalesce(~F.col("__entry").eqNullSafe(F.col("__next")), F.lit(False))
            wanted = cut_lineage(wanted.withColumn("__stale", stale))
            dirty = wanted.filter("__stale").select(*by, F.col("__next").alias("__entry"))
            used = wanted.select(*by, F.col("__next").alias("__entry"))
            if not dirty.take(1):
                return used
            again = join_on_keys(rows, F.broadcast(dirty), by, "inner")
            redone = walk(again, exits_only=True).withColumnRenamed("__exit", "__new")
            exits = cut_lineage(join_on_keys(exits, redone, by)
                                .select(*by, F.coalesce("__new", "__exit").alias("__exit")))

    if hot is not None:
        rows = cut_lineage(_blocked(hot, keys, order, block_rows or BLOCK_ROWS).drop("__pos"))
        entered = composed(rows)
        if entered is None:
            entered = by_rounds(rows)
        hot = walk(join_on_keys(rows, F.broadcast(entered), [*keys, "__block"]))
    return _either(cold, hot)
