"""Connector sinks. Addresses and credentials come from the caller's options."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.functions.messages import to_message


def jdbc_append(
    df: DataFrame,
    table: str,
    options: Mapping[str, str],
    partitions: int = 8,
    batch_size: int = 10000,
    format: str = "jdbc",
) -> None:
    """Append to a database table over at most ``partitions`` connections."""
    (
        df.write.format(format)
        .mode("append")
        .options(**options)
        .option("dbtable", table)
        .option("numPartitions", partitions)
        .option("batchsize", batch_size)
        .save()
    )


def warehouse_append(
    df: DataFrame, table: str, options: Mapping[str, str], format: str = "bigquery"
) -> None:
    """Append to a cloud warehouse table, through its Spark connector."""
    df.write.format(format).mode("append").options(**options).option("table", table).save()


def encode_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Each row as a JSON ``value``, with an optional message ``key``."""
    value = to_message(df.columns).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).alias("key"), value)


def publish_messages(
    df: DataFrame,
    servers: str,
    topic: str,
    key: str | None = None,
    options: Mapping[str, str] | None = None,
    format: str = "kafka",
) -> None:
    """Publish each row as one JSON message; one distributed write."""
    (
        encode_messages(df, key)
        .write.format(format)
        .mode("append")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**(options or {}))
        .save()
    )
