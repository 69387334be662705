"""Per-key rules on streams, and helpers to run a stream to its end."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tessera.operators import steps
from tessera.operators.sessions import SECOND, micros, needs_record
from tessera.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class StepProcessor(StatefulProcessor):
    """Walks the new rows of a key in order and keeps the rule's state as JSON."""

    def __init__(self, step, order, uses, columns, adds, ttl_seconds):
        self.step, self.order, self.uses = step, list(order), list(uses)
        self.columns, self.adds, self.ttl = list(columns), list(adds), ttl_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        kind = T.StructType([T.StructField("state", T.StringType())])
        if self.ttl is None:
            self.kept = handle.getValueState("state", kind)
        else:
            self.kept = handle.getValueState("state", kind, ttlDurationMs=int(self.ttl * 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable", ignore_index=True)
        state = json.loads(self.kept.get()[0]) if self.kept.exists() else None
        outs = []
        for values in zip(*[batch[c] for c in self.uses]):
            state, out = self.step(state, *values)
            outs.append(out)
        self.kept.update((json.dumps(state),))
        result = batch[self.columns].copy()
        for i, name in enumerate(self.adds):
            result[name] = [o[i] for o in outs]
        yield result

    def close(self) -> None:
        pass


def stateful(stream: DataFrame, keys: Sequence[str], order: Sequence[str], uses: Sequence[str], step: Callable,
             adds: str, ttl_seconds: float | None = None) -> DataFrame:
    """Streaming twin of ``fold_rows``: state per key, rows of a micro-batch in order.

    Only the new rows of a key are in memory at once. Bound the micro-batch at
    the source (``maxBytesPerTrigger``, ``maxOffsetsPerTrigger``), which bounds
    the rows of a hot key as well; a long history is better run by the batch
    twin, which splits hot keys. ``ttl_seconds`` lets Spark forget keys not
    seen for that long.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    added = T.StructType.fromDDL(adds)
    processor = StepProcessor(step, order, uses, stream.columns, added.names, ttl_seconds)
    return stream.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=T.StructType([*stream.schema.fields, *added.fields]),
        outputMode="Append", timeMode="None" if ttl_seconds is None else "ProcessingTime")


class OrderedProcessor(StatefulProcessor):
    """Holds the rows of a key until the watermark has passed them, then walks them in order.

    One event-time timer per key: at its earliest held row or, with none held, at the time after which the
    rule's state decides like none; then the state is cleared.
    """

    def __init__(self, step, order, uses, schema, adds, time):
        self.step, self.order, self.uses, self.schema = step, list(order), list(uses), schema
        self.adds, self.time = list(adds), schema.names.index(time)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rule = handle.getValueState("rule", T.StructType([T.StructField("state", T.StringType()),
                                                               T.StructField("due", T.LongType())]))
        self.held = handle.getListState("held", self.schema)

    def _load(self) -> tuple:
        if not self.rule.exists():
            return None, None
        text, due = self.rule.get()
        return None if text is None else json.loads(text), due

    def _save(self, state, due, wanted) -> None:
        """Keep the state with the timer that is wanted in place of the one that is due."""
        if due != wanted:
            if due is not None:
                self.handle.deleteTimer(due)
            if wanted is not None:
                self.handle.registerTimer(wanted)
        if state is None and wanted is None:
            self.rule.clear()
        else:
            self.rule.update((None if state is None else json.dumps(state), wanted))

    def _walk(self, rows: list[tuple], state):
        frame = pd.DataFrame(rows, columns=self.schema.names).sort_values(self.order, kind="stable", ignore_index=True)
        outs = []
        for values in zip(*[frame[c] for c in self.uses]):
            state, out = self.step(state, *values)
            outs.append(out)
        for i, name in enumerate(self.adds):
            frame[name] = [o[i] for o in outs]
        return frame, state

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        batch.columns = [*self.schema.names, "__time", "__beat"]  # Spark renames fields that begin with an underscore
        batch = batch[~batch["__beat"]][self.schema.names]
        fresh = [tuple(r) for r in batch.astype(object).where(batch.notna(), None).itertuples(index=False)]
        state, due = self._load()
        timeless = [r for r in fresh if r[self.time] is None]
        fresh = [(*r[:self.time], int(r[self.time]), *r[self.time + 1:]) for r in fresh if r[self.time] is not None]
        if fresh:
            self.held.appendList(fresh)
            first = min(-(-r[self.time] // 1000) for r in fresh)
            self._save(state, due, first if due is None else min(due, first))
        if timeless:
            yield self._walk(timeless, state)[0]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        state, _ = self._load()
        held = list(self.held.get()) if self.held.exists() else []
        ready = [r for r in held if r[self.time] <= passed]
        rest = [r for r in held if r[self.time] > passed]
        out = None
        if ready:
            out, state = self._walk(ready, state)
            if rest:
                self.held.put(rest)
            else:
                self.held.clear()
        ends = getattr(self.step, "ends", None)
        wanted = min((-(-r[self.time] // 1000) for r in rest), default=None)
        if wanted is None and ends is not None and state is not None:
            end = ends(state)
            state, wanted = (None, None) if end <= passed else (state, -(-end // 1000))
        self._save(state, None, wanted)  # the timer that fired is gone
        if out is not None:
            yield out

    def close(self) -> None:
        pass


def in_time_order(stream: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, uses: Sequence[str],
                  step: Callable, adds: str, delay: str, beats: DataFrame | None = None) -> DataFrame:
    """Streaming twin of ``fold_rows`` whose rows may come in any order within ``delay``.

    Each row waits in the key's state until the watermark, the latest time seen less ``delay``, has passed it;
    so the outcome is that of the batch twin whatever batches the rows come in. A row that comes later than
    ``delay`` behind the latest one is dropped by Spark and counted in the query's ``numRowsDroppedByWatermark``.
    Rows without a time pass at once. Time columns in ``uses`` are named ``t_micros``. States that decide like
    none are cleared. ``beats`` is a stream of one timestamp column that moves the watermark on while the
    source is still.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = stream.withColumn("t_micros", micros(ts))
    schema, added = rows.schema, T.StructType.fromDDL(adds)
    rows = rows.withColumn("__time", F.col(ts).cast("timestamp")).withColumn("__beat", F.lit(False))
    if beats is not None:
        beat = beats.select(F.col(beats.columns[0]).cast("timestamp").alias("__time"), F.lit(True).alias("__beat"))
        rows = rows.unionByName(beat, allowMissingColumns=True)
    processor = OrderedProcessor(step, order, uses, schema, added.names, "t_micros")
    out = rows.withWatermark("__time", delay).groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=T.StructType([*schema.fields, *added.fields]),
        outputMode="Append", timeMode="EventTime")
    return out.drop("t_micros")


def disorder(table: DataFrame, ts: str) -> str:
    """Delay with which no row of a table's files, read in order of their age, comes late."""
    files = (table.select(F.col("_metadata.file_modification_time").alias("age"), F.col("_metadata.file_path").alias("f"),
                          F.col(ts).cast("timestamp").alias("t"))
             .groupBy("age", "f").agg(F.min("t").alias("low"), F.max("t").alias("high")))
    upto = Window.orderBy("age", "f").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    back = F.unix_micros(F.max("high").over(upto)) - F.unix_micros("low")
    most = files.select(back.alias("back")).agg(F.max("back")).head()[0] or 0
    return f"{max(0, most) // SECOND + 2} seconds"


def run_in_time(make: Callable[[DataFrame], DataFrame], spark: SparkSession, label: str = "ordered",
                path: str | None = None) -> DataFrame:
    """Run ``make(beats)`` over everything available, then once more with a last beat, and read its table.

    The beat, at 2250 (pandas has no times beyond 2262), comes when all rows are in, so the rows still held are walked and states that end are cleared;
    for a stream that goes on, write beats of the present time instead.
    """
    path = path or scratch_path(spark, label)
    spark.createDataFrame([], "at timestamp").write.mode("append").parquet(f"{path}/beats")
    run_to_table(make(spark.readStream.schema("at timestamp").parquet(f"{path}/beats")), path=path)
    (spark.range(1).select(F.lit("2250-01-01").cast("timestamp").alias("at"))
     .write.mode("append").parquet(f"{path}/beats"))
    return run_to_table(make(spark.readStream.schema("at timestamp").parquet(f"{path}/beats")), path=path)


def _rule(stream, keys, order, ts, step, adds, extra=(), delay=None, beats=None) -> DataFrame:
    if delay is not None:
        return in_time_order(stream, keys, order, ts, ["t_micros", *extra], step, adds, delay, beats)
    rows = stream.withColumn("t_micros", micros(ts))
    return stateful(rows, keys, order, ["t_micros", *extra], step, adds).drop("t_micros")


def rolling_counts(stream: DataFrame, keys, order, item: str, n: int, ts: str | None = None, **timing) -> DataFrame:
    """Counts among the last ``n`` items of each key (ST-2); the state is the last ``n`` items and stays."""
    step = steps.rolling(n)
    if ts is None:
        return stateful(stream, keys, order, [item], step, "counts string")
    return in_time_order(stream, keys, order, ts, [item], step, "counts string", **timing)


def limit_sliding(stream: DataFrame, keys, order, ts: str, max_calls: int, window_seconds: float, **timing) -> DataFrame:
    """Sliding-window limiter on a stream (ST-3).

    ``delay`` and ``beats``, here and below, are those of :func:`in_time_order`; without them the rows of a
    micro-batch are walked as they come.
    """
    return _rule(stream, keys, order, ts, steps.sliding_limiter(max_calls, round(window_seconds * SECOND)),
                 "allowed boolean", **timing)


def limit_bucket(stream: DataFrame, keys, order, ts: str, capacity: int, rate: float, need: str | None = None,
                 **timing) -> DataFrame:
    """Discrete token bucket on a stream (ST-4); column ``need`` holds the tokens of each call.

    A new bucket is empty and one long unused is full, so its state is never like none and stays.
    """
    return _rule(stream, keys, order, ts, steps.bucket_discrete(capacity, rate), "allowed boolean",
                 [need] if need else [], **timing)


def wait_bucket(stream: DataFrame, keys, order, ts: str, capacity: int, rate: float, need: str | None = None,
                **timing) -> DataFrame:
    """Continuous token bucket on a stream (ST-5); ``need`` as in :func:`limit_bucket`."""
    return _rule(stream, keys, order, ts, steps.bucket_continuous(capacity, rate), "wait double",
                 [need] if need else [], **timing)


def replay_responses(stream: DataFrame, order, ts: str, path: str, key: str, body: str,
                     ttl_seconds: float = 86_400, method: str | None = None, status: str | None = None,
                     **timing) -> DataFrame:
    """Idempotent replay of keyed requests on a stream (ST-6): ``response``, ``replayed`` and ``response_status``.

    POST and PATCH with a key are kept; all others need no state and pass beside it with their own body and
    status. Without a ``method`` column all rows are requests to keep; without ``status`` it is NULL.
    """
    guard = steps.replay_guard(round(ttl_seconds * SECOND))
    adds = "response string, replayed boolean, response_status int"
    extra = [body, status] if status else [body]
    if method is None:
        return _rule(stream, [path, key], order, ts, guard, adds, extra, **timing)
    kept = needs_record(method, key)
    code = F.col(status).cast("int") if status else F.lit(None).cast("int")
    plain = stream.filter(~kept).select("*", F.col(body).cast("string").alias("response"), F.lit(False).alias("replayed"),
                                        code.alias("response_status"))
    return _rule(stream.filter(kept), [path, key], order, ts, guard, adds, extra, **timing).unionByName(plain)


def table_stream(spark: SparkSession, folder: str, name: str, bytes_per_trigger: int = 512 * 1024 * 1024) -> DataFrame:
    """A parquet table of a folder as a file stream, so many bytes per micro-batch."""
    reader = (spark.readStream.schema(spark.read.parquet(f"{folder}/{name}.parquet").schema)
              .option("maxBytesPerTrigger", bytes_per_trigger))
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def run_to_table(stream: DataFrame, label: str = "stream", path: str | None = None) -> DataFrame:
    """Run a stream over everything available, into a parquet table, and read it (ST-1); ``path`` keeps its progress."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, label)
    query = (stream.writeStream.format("parquet").option("path", f"{path}/data")
             .option("checkpointLocation", f"{path}/log").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], label: str = "batches",
                path: str | None = None) -> None:
    """Run a stream to its end, each micro-batch through ``handle``; ``path`` keeps its progress."""
    path = path or scratch_path(stream.sparkSession, label)
    query = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{path}/log")
             .trigger(availableNow=True).start())
    query.awaitTermination()


def tagged(stream: DataFrame) -> DataFrame:
    """The transform of the produce-transform-result stream: one result per item (ST-1)."""
    return stream.select("event_id", F.concat(F.lit("processed_"), F.upper("event_type")).alias("result"))
