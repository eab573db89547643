"""One sink for all that a topic brings: each message is parsed once and stored under its route."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quotemill.schemas import QUOTE_MESSAGE
from quotemill.streaming.decode import QUOTES, route_messages
from quotemill.streaming.sink import plain_batch_writer, read_batches, start_batches


def start_routed_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    schema: T.StructType = QUOTE_MESSAGE,
    once: bool = False,
) -> StreamingQuery:
    """One query and one write per batch, partitioned by route; a replay overwrites its batch."""
    write = plain_batch_writer(path, partition_by=["route"])
    return start_batches(route_messages(messages, schema), write, checkpoint, once, mode="append")


def read_route(
    spark: SparkSession, path: str, route: str = QUOTES, schema: T.StructType = QUOTE_MESSAGE
) -> DataFrame:
    """What was stored under one route: quotes, or else texts as ``message``. Other routes are not read."""
    stored = T.StructType(
        [*schema, T.StructField("message", T.StringType()), T.StructField("route", T.StringType())]
    )
    rows = read_batches(spark, path, stored).where(F.col("route") == route)
    return rows.select(*(schema.fieldNames() if route == QUOTES else ["message"]), "batch_id")
