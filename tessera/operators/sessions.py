"""The per-key rules applied to tables: limiters, replay, caches, machines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import steps
from tessera.operators.ordering import fold_rows

SECOND = steps.SECOND


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _timed(df: DataFrame, keys, order, ts, step, adds, extra=(), **sizes) -> DataFrame:
    rows = df.withColumn("__t", micros(ts))
    return fold_rows(rows, keys, order, ["__t", *extra], step, adds, **sizes).drop("__t")


def replay_machine(df: DataFrame, keys: Sequence[str], order: Sequence[str], event: str, transitions, initial: str,
                   **sizes) -> DataFrame:
    """Replay of events per key: ``ok`` and the state after each (G-4)."""
    return fold_rows(df, keys, order, [event], steps.machine(transitions, initial), "ok boolean, state string", **sizes)


def replay_edits(df: DataFrame, keys: Sequence[str], order: Sequence[str], op: str, value: str,
                 max_history: int = 10, **sizes) -> DataFrame:
    """Replay of execute, undo and redo per session (G-5)."""
    return fold_rows(df, keys, order, [op, value], steps.undo_redo(max_history), "current string", **sizes)


def limit_sliding(df: DataFrame, keys, order, ts: str, max_calls: int, window_seconds: float, **sizes) -> DataFrame:
    """``allowed`` per call under a sliding window (ST-3)."""
    return _timed(df, keys, order, ts, steps.sliding_limiter(max_calls, round(window_seconds * SECOND)),
                  "allowed boolean", **sizes)


def limit_bucket(df: DataFrame, keys, order, ts: str, capacity: int, rate: float, need: str | None = None, **sizes
                 ) -> DataFrame:
    """``allowed`` per call under a discrete token bucket (ST-4); column ``need`` holds the tokens of each call."""
    return _timed(df, keys, order, ts, steps.bucket_discrete(capacity, rate), "allowed boolean",
                  [need] if need else [], **sizes)


def wait_bucket(df: DataFrame, keys, order, ts: str, capacity: int, rate: float, need: str | None = None, **sizes
                ) -> DataFrame:
    """``wait`` in seconds per call under a continuous token bucket (ST-5); ``need`` as in :func:`limit_bucket`."""
    return _timed(df, keys, order, ts, steps.bucket_continuous(capacity, rate), "wait double",
                  [need] if need else [], **sizes)


def needs_record(method: str, key: str) -> Column:
    """Requests whose response is kept: POST and PATCH with a key."""
    return F.coalesce(F.col(method).isin("POST", "PATCH") & (F.col(key) != ""), F.lit(False))


def replay_responses(df: DataFrame, keys, order, ts: str, method: str, path: str, key: str, body: str,
                     ttl_seconds: float = 86_400, status: str | None = None, **sizes) -> DataFrame:
    """``response``, ``replayed`` and ``response_status`` per request (ST-6).

    Only POST and PATCH with a key are kept; the name space is path and key.
    Other requests pass through without touching any state. Without a ``status`` column the status is NULL.
    """
    kept = needs_record(method, key)
    code = F.col(status).cast("int") if status else F.lit(None).cast("int")
    plain = df.filter(~kept).select("*", F.col(body).cast("string").alias("response"), F.lit(False).alias("replayed"),
                                    code.alias("response_status"))
    guarded = _timed(df.filter(kept), [*keys, path, key], order, ts, steps.replay_guard(round(ttl_seconds * SECOND)),
                     "response string, replayed boolean, response_status int",
                     extra=[body, status] if status else [body], **sizes)
    return guarded.unionByName(plain)


def cache_hits(df: DataFrame, keys, order, ts: str, ttl_seconds: float, **sizes) -> DataFrame:
    """``hit`` per lookup of a cache with expiry (E-13)."""
    return _timed(df, keys, order, ts, steps.ttl_cache(round(ttl_seconds * SECOND)), "hit boolean", **sizes)
