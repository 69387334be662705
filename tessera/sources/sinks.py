"""Batched writes, tables, and messages keyed for a log."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.ordering import number_rows


def write_batches(df: DataFrame, send: Callable[[list], None], size: int = 500) -> None:
    """Hand rows to ``send`` in lists of ``size``, the last one shorter (S-12).

    Each partition sends its own batches; a retried task sends its rows again,
    so ``send`` must be idempotent.
    """

    def run(rows):
        rows = iter(rows)
        while batch := list(islice(rows, size)):
            send(batch)

    df.foreachPartition(run)


def write_jdbc(df: DataFrame, url: str, table: str, size: int = 500, **options) -> None:
    """Database sink with ``size`` rows per statement (S-12)."""
    (df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", size)
       .options(**options).mode("append").save())


def batch_numbers(df: DataFrame, order: Sequence[str], size: int = 500, hot_rows: int | None = None) -> DataFrame:
    """Number of the batch each row falls into, counted over the whole table (S-12)."""
    return number_rows(df, [], order, "batch", hot_rows).withColumn("batch", F.ceil(F.col("batch") / size))


def create_table(spark: SparkSession, name: str, schema: str, if_not_exists: bool = True) -> None:
    """Empty parquet table (D-1)."""
    spark.sql(f"CREATE TABLE {'IF NOT EXISTS ' if if_not_exists else ''}{name} ({schema}) USING parquet")


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def drop_table(spark: SparkSession, name: str, if_exists: bool = True) -> None:
    spark.sql(f"DROP TABLE {'IF EXISTS ' if if_exists else ''}{name}")


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def keyed_messages(df: DataFrame, key: str) -> DataFrame:
    """``key`` and JSON ``value``; one key stays in one partition of the log (S-11)."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def parse_messages(df: DataFrame, schema: str) -> DataFrame:
    """Columns of JSON message values (S-10)."""
    return df.select(F.from_json(F.col("value").cast("string"), schema).alias("m")).select("m.*")


def kafka_source(spark: SparkSession, servers: str, topic: str = "order.created", group: str = "orders") -> DataFrame:
    """Stream of raw messages (S-10); needs the Kafka connector on the class path."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
            .option("kafka.group.id", group).option("startingOffsets", "earliest").load())


def kafka_sink(df: DataFrame, key: str, servers: str, topic: str, checkpoint: str):
    """Write a stream as keyed messages (S-11); needs the Kafka connector."""
    return (keyed_messages(df, key).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint).start())
