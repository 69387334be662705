"""Routing, read model, outbox and fan-out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import dml
from tessera.operators.joins import order_view
from tessera.operators.ordering import order_names, top_per_key
from tessera.session import cut_lineage, remove, scratch_path
from tessera.sources.sinks import write_batches
from tessera.streaming.stateful import run_batches


def route(batch: DataFrame, kind: str, known: Sequence[str], strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Events of registered types, and the others (ST-7); ``strict`` makes an unknown type an error."""
    is_known = F.coalesce(F.col(kind).isin(*known), F.lit(False))
    if strict:
        checked = F.when(is_known, F.col(kind)).otherwise(
            F.raise_error(F.concat(F.lit("no handler for "), F.coalesce(kind, F.lit("NULL")))))
        return batch.withColumn(kind, checked), batch.limit(0)
    return batch.filter(is_known), batch.filter(~is_known)


def route_stream(stream: DataFrame, kind: str, known: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Write each type to its own folder and unknown ones to a dead-letter table (ST-7).

    One write per micro-batch, split by folder; a repeated batch overwrites its
    own output.
    """
    spark = stream.sparkSession
    path = scratch_path(spark, "routed")
    ran = []

    def handle(batch: DataFrame, number: int) -> None:
        ran.append(number)
        good, dead = route(batch, kind, known)
        good.withColumn("handler", F.col(kind)).write.mode("overwrite").partitionBy("handler").parquet(f"{path}/good/batch={number}")
        dead.write.mode("overwrite").parquet(f"{path}/dead/batch={number}")

    run_batches(stream, handle, "route")
    routed = T.StructType([*stream.schema.fields, T.StructField("handler", T.StringType()),
                           T.StructField("batch", T.LongType())])
    if not ran:
        return spark.createDataFrame([], routed), spark.createDataFrame([], stream.schema)
    good = spark.read.schema(routed).parquet(f"{path}/good")
    return good, spark.read.schema(stream.schema).parquet(f"{path}/dead")


def project_orders(stream: DataFrame, users: DataFrame, items: DataFrame, path: str | None = None,
                   newest: Sequence[str] = ()) -> DataFrame:
    """Keep the order view up to date from a stream of created orders, and read it (ST-8).

    Every micro-batch is an upsert into the view, copied on write: batch ``n`` merges into version ``n - 1`` and
    writes version ``n``, so a repeated batch gives the same version again, and the one before the last goes. A
    batch costs as much as the view; a table format with MERGE would rewrite the files it touches only.
    Of several events of an order in one micro-batch the first by ``newest`` counts (such as
    ``["-created_at"]``), ties by the other columns; a later micro-batch replaces an earlier one. With a ``path``
    the view and the stream's progress live there and go on after a restart.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, "project")
    shape = order_view(spark.createDataFrame([], stream.schema), users, items).schema

    def version(number: int) -> DataFrame:
        return spark.read.schema(shape).parquet(f"{path}/view/version={number}")

    def handle(batch: DataFrame, number: int) -> None:
        rest = [c for c in batch.columns if c not in ("order_id", *order_names(newest))]
        rows = order_view(top_per_key(batch, ["order_id"], [*newest, *rest], 1).drop("rn"), users, items)
        old = version(number - 1) if number else spark.createDataFrame([], shape)
        dml.upsert(old, cut_lineage(rows), "order_id", shape.names)[0].write.mode("overwrite").parquet(
            f"{path}/view/version={number}")
        remove(spark, f"{path}/view/version={number - 2}")

    run_batches(stream, handle, path=path)
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(f"{path}/view/version=*")
    found = place.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(place)
    numbers = [int(f.getPath().getName().split("=")[1]) for f in found or ()]  # two at most
    return version(max(numbers)) if numbers else spark.createDataFrame([], shape)


def outbox_round(outbox: DataFrame, now, limit: int = 100) -> tuple[DataFrame, DataFrame]:
    """Oldest unpublished events, and the outbox with them stamped (ST-9)."""
    chosen = (outbox.filter(F.col("published_at").isNull()).orderBy("created_at", "id").limit(limit))
    stamped, _ = dml.update_from(outbox, chosen.select(F.col("id").alias("sent_id"), F.lit(now).alias("stamp")),
                                 ("id", "sent_id"), {"published_at": "stamp"})
    return chosen, stamped


def drain_outbox(outbox: DataFrame, now, send: Callable[[list], None], limit: int = 100) -> DataFrame:
    """Publish everything unpublished, ``limit`` rows at a time, and stamp it (ST-9).

    The pending rows are range-sorted by age, and each task sends its range in
    batches, oldest first: tasks take the place of the concurrent pollers, each
    with rows of its own. The stamp follows once all are sent, so a broken run
    may send a row again but loses none.
    """
    pending = cut_lineage(outbox.filter(F.col("published_at").isNull()))
    ordered = pending.repartitionByRange("created_at", "id").sortWithinPartitions("created_at", "id")
    write_batches(ordered, send, limit)
    sent = pending.select(F.col("id").alias("sent_id"), F.lit(now).alias("stamp"))
    return dml.update_from(outbox, sent, ("id", "sent_id"), {"published_at": "stamp"})[0]


def fan_out(messages: DataFrame, members: DataFrame, channel: str) -> DataFrame:
    """Each message for each member of its channel (ST-10)."""
    return messages.join(members.dropDuplicates(), channel)
