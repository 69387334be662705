"""Joins to tables whose size is checked first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a table that may be sent to every executor.
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(table: DataFrame, row_bytes: Column | int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table, to be broadcast if its rows take ``limit`` bytes at most, else left to the planner.

    Texts that meet narrow decisions then stay where they are instead of being shuffled.
    """
    size = F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes
    total = table.agg(F.sum(size)).head()[0] or 0
    return F.broadcast(table) if total <= limit else table
