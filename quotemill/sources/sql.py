"""User SQL over the star tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def register_tables(tables: Mapping[str, DataFrame]) -> None:
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def sql_query(spark: SparkSession, query: str) -> DataFrame:
    """Any Spark SQL; rows stay distributed."""
    return spark.sql(query)


def sql_query_named(spark: SparkSession, query: str, columns: Sequence[str]) -> DataFrame:
    """The same with result columns named by position."""
    return spark.sql(query).toDF(*columns)
