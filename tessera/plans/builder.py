"""Fluent selection and a repository over one table (U-6, U-7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import dml
from tessera.operators.ordering import sort_columns


class Selection:
    """Table, joins, ANDed conditions, order and page as one lazy DataFrame (U-6).

    Values in text conditions are bound by name (``where("a = :x", x=1)``),
    never pasted into the text.
    """

    def __init__(self, table: DataFrame, joins=(), conditions=(), orders=(), limit=None, offset=0):
        self._table, self._joins, self._conditions = table, tuple(joins), tuple(conditions)
        self._orders, self._limit, self._offset = tuple(orders), limit, offset

    def _with(self, **changes) -> Selection:
        now = dict(table=self._table, joins=self._joins, conditions=self._conditions, orders=self._orders,
                   limit=self._limit, offset=self._offset)
        return Selection(**{**now, **changes})

    def where(self, condition: Column | str, **values) -> Selection:
        return self._with(conditions=(*self._conditions, (condition, values)))

    def join(self, table: DataFrame, on: Column | str, how: str = "inner") -> Selection:
        return self._with(joins=(*self._joins, (table, on, how)))

    def order(self, column: str, direction: str = "ASC") -> Selection:
        return self._with(orders=(*self._orders, ("-" if direction.upper() == "DESC" else "") + column))

    def paginate(self, page: int, size: int) -> Selection:
        return self._with(limit=size, offset=(page - 1) * size)

    def build(self) -> DataFrame:
        df = self._table
        for table, on, how in self._joins:
            df = df.join(table, F.expr(on) if isinstance(on, str) else on, how)
        for condition, values in self._conditions:
            df = self._apply(df, condition, values)
        if self._orders:
            df = df.orderBy(*sort_columns(self._orders))
        if self._limit:
            df = df.offset(self._offset).limit(self._limit)
        return df

    @staticmethod
    def _apply(df: DataFrame, condition: Column | str, values: dict) -> DataFrame:
        if isinstance(condition, str) and values:
            return df.sparkSession.sql(f"SELECT * FROM {{df}} WHERE {condition}", args=values, df=df)
        return df.filter(condition)


class Repository:
    """get, list, save, delete and find_by over one table (U-7).

    Tables do not change in place: ``save`` and ``delete`` return a repository
    over the new table.
    """

    def __init__(self, table: DataFrame, key: str):
        self.table, self.key = table, key

    def get(self, value) -> DataFrame:
        return self.table.filter(F.col(self.key) == F.lit(value))

    def list(self, limit: int = 50, offset: int = 0) -> DataFrame:
        return self.table.orderBy(self.key).offset(offset).limit(limit)

    def find_by(self, **criteria) -> DataFrame:
        tests = [F.col(c) == F.lit(v) for c, v in criteria.items()]
        return self.table.filter(reduce(lambda a, b: a & b, tests, F.lit(True)))

    def save(self, rows: DataFrame) -> Repository:
        sets = [c for c in rows.columns if c != self.key]
        return Repository(dml.upsert(self.table, rows, self.key, sets)[0], self.key)

    def delete(self, *values) -> Repository:
        return Repository(dml.delete(self.table, F.col(self.key).isin(*values))[0], self.key)
