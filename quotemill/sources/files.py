"""CSV sources, always with a schema: no inference pass over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quotemill.schemas import QUOTE, STAGING, SYMBOLS

# Quotes doubled inside a field, as spreadsheet and pandas writers do; blanks are
# data. An empty field is NULL: CSV cannot tell it from an empty text.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV with a header line; the schema must match the header."""
    return spark.read.options(**CSV_OPTIONS).option("enforceSchema", "false").schema(schema).csv(path)


def read_quotes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv(spark, path, QUOTE)


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """Codes of the symbol list, other columns are not parsed."""
    return read_csv(spark, path, SYMBOLS).select("Stock_Code")


def read_shard_files(
    spark: SparkSession,
    folder: str,
    pattern: str = "stock_price_*.csv",
    schema: T.StructType = QUOTE,
) -> DataFrame:
    """All shard files of a folder and nothing else in it, such as the merged file."""
    return read_csv(spark, f"{folder}/{pattern}", schema)


def bulk_load(spark: SparkSession, path: str, schema: T.StructType = STAGING) -> DataFrame:
    """Fields by position whatever the header line says."""
    return spark.read.options(**CSV_OPTIONS).option("enforceSchema", "true").schema(schema).csv(path)
