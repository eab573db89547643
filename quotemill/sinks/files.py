"""CSV output with a header line."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quotemill.sources.files import CSV_OPTIONS


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A folder of CSV files, one per partition, each with the header."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)
