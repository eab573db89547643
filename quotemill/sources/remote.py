"""Connector sources. Addresses and credentials come from the caller's options."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader


def jdbc_query(spark: SparkSession, query: str, options: Mapping[str, str]) -> DataFrame:
    """A query run by the remote database; ``options`` hold url, user, password, driver."""
    return spark.read.format("jdbc").options(**options).option("query", query).load()


def jdbc_table(
    spark: SparkSession,
    table: str,
    options: Mapping[str, str],
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A remote table, read in parallel slices of ``partition_column``."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partitioned read needs bounds")
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=partitions,
        )
    return reader.load()


def warehouse_query(
    spark: SparkSession, query: str, options: Mapping[str, str], format: str = "bigquery"
) -> DataFrame:
    """A query run by the cloud warehouse, through its Spark connector."""
    return spark.read.format(format).options(**options).option("query", query).load()


def topic_reader(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    options: Mapping[str, str] | None = None,
    format: str = "kafka",
) -> DataStreamReader:
    """Reader of one topic; on restart the query's checkpoint decides the offsets."""
    return (
        spark.readStream.format(format)
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**(options or {}))
    )
