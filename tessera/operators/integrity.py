"""Constraints as audits, identity keys and access rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import number_rows


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in a column that forbids it (A-CON1)."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull()
    return df.filter(bad)


def unique_violations(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Values that occur more than once; NULLs never clash (A-CON2)."""
    rows = df.select(*[e.alias(n) for n, e in exprs.items()]).na.drop("any")
    return rows.groupBy(*exprs).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


def foreign_key_violations(child: DataFrame, parent: DataFrame, on: tuple[str, str]) -> DataFrame:
    """Child rows with a key that has no parent; a NULL key passes (A-CON3)."""
    fk, pk = on
    known = parent.select(F.col(pk).alias("__pk"))
    return child.filter(F.col(fk).isNotNull()).join(known, F.col(fk) == F.col("__pk"), "left_anti")


def check_violations(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is false; unknown passes (A-CON4)."""
    return df.filter(~F.coalesce(condition, F.lit(True)))


def identity_key(df: DataFrame, order: Sequence[str], start: int = 1, name: str = "id",
                 hot_rows: int | None = None) -> DataFrame:
    """Gap-free keys from ``start`` on in the given order (D-4)."""
    return number_rows(df, [], order, name, hot_rows).withColumn(name, F.col(name) + (start - 1))


def own_rows(df: DataFrame, owner: str, user) -> DataFrame:
    """Rows the user may see (D-5)."""
    return df.filter(F.col(owner) == F.lit(user))


# Role levels.
ROLE_LEVELS = {"viewer": 0, "editor": 1, "admin": 2}


def role_level(role: Column) -> Column:
    """Level of a role; an unknown one is -1 (D-6)."""
    level = F.lit(-1)
    for name, value in ROLE_LEVELS.items():
        level = F.when(role == name, value).otherwise(level)
    return level


def has_role(role: Column, minimum: str) -> Column:
    return role_level(role) >= ROLE_LEVELS[minimum]
