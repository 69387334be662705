"""Array functions and function composition (F-17 to F-19, U-1 to U-4)."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_all(a: Column, b: Column) -> Column:
    """``a @> b``: every element of ``b`` occurs in ``a``."""
    return F.size(F.array_except(b, a)) == 0


def run_lengths(a: Column) -> Column:
    """``(value, many)`` for each run of equal neighbours; of a sorted array the counts of its values.

    The array is bound by lambdas, so it and the run starts are computed once a row.
    """
    def runs(v):
        starts = F.filter(F.sequence(F.lit(0), F.size(v) - 1), lambda i: (i == 0) | (F.get(v, i) != F.get(v, i - 1)))
        return F.transform(F.array(starts), lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(v, i).alias("value"), (F.coalesce(F.get(at, k + 1), F.size(v)) - i).alias("many"))))[0]

    some = F.transform(F.array(a), lambda v: F.when(F.size(v) > 0, runs(v)))
    return some[0]


def map_where(a: Column, keep: Callable, change: Callable) -> Column:
    """``change(x)`` for the elements that pass ``keep``."""
    return F.transform(F.filter(a, keep), change)


def compose(*steps: Callable) -> Callable:
    """One function that applies all steps, the last of them first."""
    def run(value):
        for step in reversed(steps):
            value = step(value)
        return value

    return run


def pipe(*steps: Callable) -> Callable:
    """Apply the first function first."""
    return compose(*reversed(steps))


def multiplier(factor) -> Callable[[Column], Column]:
    """Function of one column with the factor bound now (U-2)."""
    bound = F.lit(factor)
    return lambda column: column * bound


def curried(fn: Callable, *bound) -> Callable:
    """Partial application over columns (U-2)."""
    return lambda *rest: fn(*[F.lit(b) for b in bound], *rest)


def fold(a: Column, start: Column, step: Callable) -> Column:
    """Fold with a binary function (U-4)."""
    return F.aggregate(a, start, step)


def strategies(table: dict[str, Callable], names: Sequence[str], column: Column) -> list[Column]:
    """One column per named function; each name keeps its own function."""
    return [table[n](column).alias(n) for n in names]
