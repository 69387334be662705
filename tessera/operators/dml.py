"""Insert, update, delete and merge as copy-on-write operators.

Each returns ``(new_target, returning)``: the table after the change and the
rows the statement touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import localcontext
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.operators.graph import linked_groups
from tessera.operators.ordering import join_on_keys, number_rows
from tessera.session import cut_lineage


def insert(target: DataFrame, rows: DataFrame, key: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Append rows under new keys that follow the highest one (M-1)."""
    top = target.agg(F.coalesce(F.max(key), F.lit(0).cast("bigint")).alias("__top"))
    numbered = join_on_keys(number_rows(rows, [], order, "__i"), top, [])
    new = numbered.withColumn(key, (F.col("__top") + F.col("__i")).cast(target.schema[key].dataType))
    new = new.select(*target.columns)
    return target.unionByName(new), new.select(key)


def insert_select(archive: DataFrame, source: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Append the matching rows of another table (M-2)."""
    chosen = source.filter(condition)
    return archive.unionByName(chosen), chosen


def require_unique(source: DataFrame, key: str) -> None:
    """Raise when two source rows carry one key."""
    twice = source.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").take(1)
    if twice:
        raise ValueError(f"more than one source row for {key} = {twice[0][0]}")


def upsert(target: DataFrame, source: DataFrame, key: str, sets: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Insert, or on a known key set the listed columns to the incoming values (M-3)."""
    require_unique(source, key)
    new = source.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__s_{c}") for c in source.columns if c != key],
                        F.lit(True).alias("__in"))
    both = target.withColumn("__old", F.lit(True)).join(new, F.col(key) == F.col("__key"), "full")

    def pick(c: str) -> Column:
        if c == key:
            return F.coalesce(key, "__key")
        if c not in source.columns:
            return F.col(c)
        incoming = F.col("__in") if c in sets else F.col("__in") & F.col("__old").isNull()
        return F.when(incoming, F.col(f"__s_{c}")).otherwise(F.col(c))

    out = both.select(*[pick(c).alias(c) for c in target.columns], F.col("__in"))
    return out.drop("__in"), out.filter("__in").drop("__in")


def merge_amounts(target: DataFrame, source: DataFrame, key: str, balance: str, amount: str) -> tuple[DataFrame, DataFrame]:
    """Matched: balance plus amount; not matched: insert with the amount (M-4)."""
    require_unique(source, key)
    new = source.select(F.col(key).alias("__key"), F.col(amount).alias("__amount"))
    both = target.join(new, F.col(key) == F.col("__key"), "full")
    fresh = F.col(key).isNull()
    total = F.when(fresh, F.col("__amount")).when(F.col("__key").isNull(), F.col(balance)).otherwise(
        F.col(balance) + F.col("__amount"))
    out = both.select(*[F.coalesce(key, "__key").alias(c) if c == key else total.alias(c) if c == balance
                        else F.col(c) for c in target.columns], F.col("__key").isNotNull().alias("__in"))
    return out.drop("__in"), out.filter("__in").drop("__in")


def update(target: DataFrame, condition: Column, sets: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Set columns where the condition holds (M-5, M-12)."""
    hit = F.coalesce(condition, F.lit(False))
    marked = target.withColumn("__hit", hit)
    out = marked.select(*[F.when(F.col("__hit"), sets[c]).otherwise(F.col(c)).alias(c) if c in sets else F.col(c)
                          for c in target.columns], "__hit")
    return out.drop("__hit"), out.filter("__hit").drop("__hit")


def update_from(target: DataFrame, source: DataFrame, on: tuple[str, str], sets: dict[str, str]
                ) -> tuple[DataFrame, DataFrame]:
    """Set columns from the matching source row; a NULL there overwrites too (M-6)."""
    mine, theirs = on
    require_unique(source, theirs)
    new = source.select(F.col(theirs).alias("__key"), *[F.col(s).alias(f"__s_{c}") for c, s in sets.items()])
    both = target.join(new, F.col(mine) == F.col("__key"), "left")
    found = F.col("__key").isNotNull()
    out = both.select(*[F.when(found, F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c) if c in sets else F.col(c)
                        for c in target.columns], found.alias("__hit"))
    return out.drop("__hit"), out.filter("__hit").drop("__hit")


def delete(target: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Remove rows for which the condition is true; unknown keeps the row (M-7)."""
    hit = F.coalesce(condition, F.lit(False))
    return target.filter(~hit), target.filter(hit)


def delete_using(target: DataFrame, source: DataFrame, on: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    """Remove rows with a partner in the other table (M-8)."""
    mine, theirs = on
    keys = source.select(F.col(theirs).alias("__key"))
    same = F.col(mine) == F.col("__key")
    return target.join(keys, same, "left_anti"), target.join(keys, same, "left_semi")


def update_first(target: DataFrame, condition: Column, order: Sequence[str], sets: dict[str, Column]
                 ) -> tuple[DataFrame, DataFrame]:
    """Change the first match in ``order`` only; the order columns must be unique (M-9)."""
    place = F.struct(*order)
    first = target.agg(F.min(F.when(F.coalesce(condition, F.lit(False)), place)).alias("__first"))
    rows = join_on_keys(target, first, [])
    out, hit = update(rows, F.struct(*order) == F.col("__first"), sets)
    return out.drop("__first"), hit.drop("__first")


def set_path(column: str, path: str, value: Column) -> Column:
    """``$set`` of a field inside a struct column (M-9)."""
    return F.col(column).withField(path, value)


def _settle(held: dict, src, dst, qty) -> bool | None:
    """Apply a move to the held balances if its source has enough; whether it had, NULL if that is not known."""
    have = held[src]
    done = None if have is None or qty is None or have != have or qty != qty else bool(have >= qty)
    if done:
        held[src] = have - qty
        held[dst] = None if held[dst] is None else held[dst] + qty
    return done


def _walk_moves(names: list[str]):
    """Batch function that goes through the moves of each group in order and keeps the balances of its accounts."""

    def run(batches):
        current, held = object(), {}
        for pdf in batches:
            decided = []
            for group, src, dst, qty, has, gets in zip(*[pdf[c] for c in ("__group", "src", "dst", "qty", "__has", "__gets")]):
                if group != current:
                    current, held = group, {}
                held.setdefault(src, has)
                held.setdefault(dst, gets)
                decided.append(_settle(held, src, dst, qty))
            out = pdf[names].copy()
            out["done"] = decided
            yield out

    return run


def transfer(accounts: DataFrame, moves: DataFrame, key: str, balance: str, group_rows: int = 200_000
             ) -> tuple[DataFrame, DataFrame]:
    """Paired transfers ``(seq, src, dst, qty)``, applied in ``seq`` order (M-10).

    A move is refused when its source holds less than ``qty`` or an account is unknown; its ``done`` is NULL if
    the balance or ``qty`` is. Moves depend on each other only through the accounts they share, so accounts
    joined by moves form groups, and each group is walked in order by one task that keeps the balances of its
    accounts: any number of moves takes a fixed number of passes. A group of more than ``group_rows`` moves is
    cut into blocks of so many instead, walked side by side from supposed balances until these are right. Only
    accounts that moves touch are read along; the table is written once.
    """
    known = accounts.select(F.col(key).alias("__k"))
    live = cut_lineage(moves.join(known, F.col("src") == F.col("__k"), "left_semi")
                       .join(known, F.col("dst") == F.col("__k"), "left_semi"))
    strange = moves.join(live.select("seq"), "seq", "left_anti").withColumn("done", F.lit(False))
    groups = linked_groups(live, "src", "dst").withColumnRenamed("group", "__group")
    grouped = cut_lineage(live.join(groups, F.col("src") == F.col("node")).drop("node"))
    large = cut_lineage(grouped.groupBy("__group").agg(F.count(F.lit(1)).alias("__n"))
                        .filter(F.col("__n") > group_rows).select("__group"))  # moves / group_rows at most
    large = F.broadcast(large)
    funds = cut_lineage(accounts.select(F.col(key).alias("__k"), F.col(balance).alias("__b")).join(
        groups.select(F.col("node").alias("__k")), "__k"))

    def with_funds(rows):
        return rows.join(funds.toDF("src", "__has"), "src").join(funds.toDF("dst", "__gets"), "dst")

    small = (with_funds(grouped.join(large, "__group", "left_anti"))
             .repartition("__group").sortWithinPartitions("__group", "seq"))
    schema = T.StructType([*live.schema.fields, T.StructField("done", T.BooleanType())])
    decided = small.mapInPandas(_walk_moves(live.columns), schema).unionByName(strange)
    if large.take(1):
        many = with_funds(grouped.join(large, "__group", "left_semi"))
        decided = decided.unionByName(_by_blocks(many, max(group_rows, 1), live.columns))
    decided = cut_lineage(decided)
    deltas = _deltas(decided.filter("done"))
    change = F.coalesce("__d", F.lit(0))
    state = accounts.join(deltas, F.col(key) == F.col("__k"), "left").withColumn(
        balance, (F.col(balance) + change).cast(accounts.schema[balance].dataType))
    return state.select(*accounts.columns), decided


def _deltas(good: DataFrame) -> DataFrame:
    """Sum of what each account pays and gets."""
    return (good.select(F.col("src").alias("__k"), (-F.col("qty")).alias("__d"))
            .unionByName(good.select(F.col("dst").alias("__k"), F.col("qty").alias("__d")))
            .groupBy("__k").agg(F.sum("__d").alias("__d")))


def _money(*kinds: T.DataType) -> T.DataType:
    """A type that holds balances and amounts of these types and sums of them."""
    if any(isinstance(k, T.FractionalType) and not isinstance(k, T.DecimalType) for k in kinds):
        return T.DoubleType()
    return T.DecimalType(37, max(k.scale if isinstance(k, T.DecimalType) else 0 for k in kinds))


def _walk_blocks(schema: T.StructType):
    """Batch function that goes through the moves of each block in order, after its balances (``qty`` at place 0).

    It gives the outcome of each move, and at place 0 each account that a move of the block changed, with the
    balance it leaves with and what it gained.
    """
    form = to_arrow_schema(schema)

    def run(batches):
        current, held, gains = None, {}, {}
        for batch in batches:
            out = []
            with localcontext(prec=76):
                for *block, place, src, dst, qty in zip(*map(_values, batch.columns)):
                    if block != current:
                        out += [(*current, 0, k, held[k], gain, None) for k, gain in gains.items()] if gains else []
                        current, held, gains = block, {}, {}
                    if place == 0:
                        held[src] = qty
                        continue
                    done = _settle(held, src, dst, qty)
                    if done:
                        gains[src] = gains.get(src, 0) - qty
                        if held[dst] is not None:
                            gains[dst] = gains.get(dst, 0) + qty
                    out.append((*block, place, None, None, None, done))
            yield _as_batch(out, form)
        yield _as_batch([(*current, 0, k, held[k], gain, None) for k, gain in gains.items()], form)

    return run


def _values(column: pa.Array) -> list:
    """The values of a column; decimals and whole numbers take the faster ways."""
    if pa.types.is_decimal(column.type):
        return column.to_pandas().tolist()
    if pa.types.is_integer(column.type) and not column.null_count:
        return column.to_numpy().tolist()
    return column.to_pylist()


def _as_batch(rows: list[tuple], form: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(form)
    return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, form)], schema=form)


def _by_blocks(paid: DataFrame, block_rows: int, columns: Sequence[str]) -> DataFrame:
    """Moves of large groups with their outcome, walked in blocks of ``block_rows`` moves.

    Every block is walked from the balances that its accounts have if the blocks before it did as they last did,
    at first from those before all moves; blocks whose balances come out different are walked again. After each
    round one block more has its final balances, so there are as many rounds as blocks in a group at most, and
    few where blocks do little to each other. A final balance is the one the block before left, not a sum, so
    floating point gives what one walk gives.
    """
    kind = _money(paid.schema["__has"].dataType, paid.schema["qty"].dataType)
    block, known = ["__group", "__block"], F.col("seq").isNotNull().alias("__known")
    rows = number_rows(paid.select("*", known), ["__group"], ["__known", "seq"], "__pos")
    rows = cut_lineage(rows.withColumn("__block", F.floor((F.col("__pos") - 1) / block_rows)))

    def side(account, at, balance):
        return rows.select(*block, F.col(account).alias("__k"),
                           F.struct("__pos", F.lit(at).alias("at"), F.col(balance).cast(kind).alias("b")).alias("__first"))

    touched = side("src", 0, "__has").unionByName(side("dst", 1, "__gets")).groupBy(*block, "__k").agg(
        F.min("__first").alias("__first"))
    account, by_block = Window.partitionBy("__k"), Window.partitionBy("__k").orderBy("__block")
    held = cut_lineage(touched.select(
        *block, "__k", F.first("__first").over(by_block)["b"].alias("__start"),
        (F.max("__block").over(account) > F.min("__block").over(account)).alias("__shared"))
        .withColumn("__entry", F.col("__start")))
    own, held = held.filter(~F.col("__shared")), held.filter("__shared")  # an account of one block enters it as it was
    place, node = T.LongType(), held.schema["__k"].dataType
    schema = T.StructType([T.StructField(*f) for f in [
        ("__group", rows.schema["__group"].dataType), ("__block", place), ("__pos", place), ("__k", node),
        ("__exit", kind), ("__gain", kind), ("done", T.BooleanType())]])
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    moves = rows.select(*block, "__pos", "src", "dst", F.col("qty").cast(kind).alias("qty"))
    judged = again = None
    for final in count(1):  # blocks before this one are right at the end of the round
        entries = own.select(*block, "__k", "__entry").unionByName(held.select(*block, "__k", "__entry"))
        walked = moves.unionByName(entries.select(
            *block, F.lit(0).cast(place).alias("__pos"), F.col("__k").alias("src"), F.lit(None).cast(node).alias("dst"),
            F.col("__entry").alias("qty")))
        if again is not None:
            walked = walked.join(again, block, "left_semi")
        walked = cut_lineage(walked.repartition(*block).sortWithinPartitions(*block, "__pos")
                             .mapInArrow(_walk_blocks(schema), schema))
        judged = walked if judged is None else cut_lineage(judged.join(again, block, "left_anti").unionByName(walked))
        ends = judged.filter("__pos = 0").select(*block, "__k", "__exit", "__gain")
        left = F.last(F.when(F.col("__block") < final, F.col("__exit")), ignorenulls=True).over(before)
        more = F.sum(F.when(F.col("__block") >= final, F.col("__gain"))).over(before).cast(kind)
        entry = F.coalesce(left, "__start") + F.coalesce(more, F.lit(0).cast(kind))
        held = cut_lineage(held.join(ends, [*block, "__k"], "left").select(
            *block, "__k", "__start", F.col("__entry").alias("__was"), entry.cast(kind).alias("__entry")))
        again = cut_lineage(held.filter(~F.col("__entry").eqNullSafe(F.col("__was"))).select(*block).distinct())
        if not again.take(1):
            break
        again = F.broadcast(again)  # moves / block_rows at most
    outcome = judged.filter("__pos > 0").select("__group", "__pos", "done")
    return rows.join(outcome, ["__group", "__pos"]).select(*columns, "done")


def patch(target: DataFrame, changes: DataFrame, key: str, allowed: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Apply sent fields of the allow-list (M-11).

    ``changes`` holds the key and per field ``f`` a flag ``f_sent`` and the value ``f``.
    """
    require_unique(changes, key)
    fields = [c for c in allowed if f"{c}_sent" in changes.columns]
    new = changes.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__s_{c}") for c in fields],
                         *[F.col(f"{c}_sent").alias(f"__f_{c}") for c in fields])
    both = target.join(new, F.col(key) == F.col("__key"), "left")
    out = both.select(*[F.when(F.col(f"__f_{c}"), F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c) if c in fields
                        else F.col(c) for c in target.columns], F.col("__key").isNotNull().alias("__hit"))
    return out.drop("__hit"), out.filter("__hit").drop("__hit")
