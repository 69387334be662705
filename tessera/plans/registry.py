"""Registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.readers import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
OPERATORS: dict[str, str] = {}


class Tables:
    """Lazy access to the parquet tables of one directory: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def wide(self, name: str, *columns: str) -> DataFrame:
        """A table with much work per row, read by all cores."""
        return spread(self.__getattr__(name).select(*columns))

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, operator: str, sql: str | None = None):
    """Register a query over :class:`Tables` under the operator id of the survey."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        OPERATORS[name] = operator
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def r(column: Column | str, places: int = 6) -> Column:
    """Doubles are rounded on both sides before they are compared."""
    return F.round(column, places)


def text(array: Column | str, sep: str = ",") -> Column:
    """Lists are compared as joined text."""
    column = F.col(array) if isinstance(array, str) else array
    return F.array_join(F.transform(column, lambda x: x.cast("string")), sep)
