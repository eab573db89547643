"""Staging rows to six dimensions and one fact table, and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.functions.keys import date_key
from quotemill.operators.numbering import assign_keys
from quotemill.schemas import DATETIME_DIM, FOREIGN_KEYS, MEASURE_DIMS, STAGING

ROW_KEY = "__row_key"


def datetime_dim(staging: DataFrame, padded: bool = False) -> DataFrame:
    """Distinct trading dates and update times with their computed key."""
    renamed = {"stock_year": "year_col", "stock_month": "month_col", "stock_day": "day_col"}
    return staging.select(
        date_key(padded).alias("date_id"),
        *(F.col(renamed.get(c, c)).alias(c) for c in DATETIME_DIM.fieldNames()[1:]),
    ).distinct()


def _measure_columns(table: str) -> list[Column]:
    _, measures = MEASURE_DIMS[table]
    return [
        F.col("code"), F.col("stock_date"),
        *(F.col(old).alias(new) for new, old in measures.items()),
    ]


def measure_rows(staging: DataFrame, table: str, *keys: str) -> DataFrame:
    """Columns of one measure dimension, one row per staging row, after ``keys`` that the rows have."""
    return staging.select(*keys, *_measure_columns(table))


def measure_dim(
    staging: DataFrame, table: str, start: int | Column = 0, land_input: bool = True
) -> DataFrame:
    """One measure dimension, keyed on its own."""
    key, _ = MEASURE_DIMS[table]
    return assign_keys(measure_rows(staging, table), key, start=start, land_input=land_input)


def number_staging(staging: DataFrame, land_input: bool = True) -> DataFrame:
    """Staging rows, landed once, with the row number all measure dimensions share."""
    return assign_keys(staging, ROW_KEY, land_input=land_input)


def keyed_measures(numbered: DataFrame, table: str, start: int | Column = 0) -> DataFrame:
    """One measure dimension of numbered staging rows, its keys after ``start``."""
    key, _ = MEASURE_DIMS[table]
    first = F.lit(start) if isinstance(start, int) else start
    return numbered.select(
        (F.col(ROW_KEY) + first).cast("bigint").alias(key), *_measure_columns(table)
    )


def dimensions(
    staging: DataFrame, padded: bool = False, land_input: bool = True
) -> dict[str, DataFrame]:
    """All six dimensions of one load.

    Each staging row is one row of every measure dimension, so the rows are
    numbered once and the five tables are projections of that. The date
    dimension reads the same landed rows.
    """
    numbered = number_staging(staging, land_input)
    tables = {"datetime_dim": datetime_dim(numbered, padded)}
    tables.update({table: keyed_measures(numbered, table) for table in MEASURE_DIMS})
    return tables


def fact_table(
    staging: DataFrame, dims: Mapping[str, DataFrame], keep: Sequence[str] = ()
) -> DataFrame:
    """Surrogate keys of every staging row that all six dimensions match, after them ``keep``
    of the columns of the joins (code, stock_date, time_update).

    The date join comes first, while rows are narrow. The five joins after it
    share one key, so staging is shuffled for them at most once. No side is
    broadcast by hint: Spark decides by measured size.
    """
    rows = staging.select("code", "stock_date", "time_update", "floor", "typeStock")
    dates = dims["datetime_dim"].select(
        "stock_date", "time_update", F.col("date_id").alias("dateKey")
    )
    joined = rows.join(dates, ["stock_date", "time_update"], "inner")
    for column, (table, key) in FOREIGN_KEYS.items():
        if table in MEASURE_DIMS:
            keys = dims[table].select("code", "stock_date", F.col(key).alias(column))
            joined = joined.join(keys, ["code", "stock_date"], "inner")
    return joined.select("code", "dateKey", "floor", "typeStock", *list(FOREIGN_KEYS)[1:], *keep)


def star_readback(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Staging rows rebuilt from the star by its surrogate keys.

    The date key must be unique, so the star has to be built with ``padded``.
    """
    dates = dims["datetime_dim"].withColumnRenamed("date_id", "dateKey")
    rows = fact.join(dates, "dateKey", "inner")
    for column, (table, key) in FOREIGN_KEYS.items():
        if table in MEASURE_DIMS:
            _, measures = MEASURE_DIMS[table]
            dim = dims[table].select(
                F.col(key).alias(column), *(F.col(new).alias(old) for new, old in measures.items())
            )
            rows = rows.join(dim, column, "inner")
    renamed = {"year_col": "stock_year", "month_col": "stock_month", "day_col": "stock_day"}
    rebuilt = {"date_string": F.date_format("stock_date", "yyyy-MM-dd")}
    return rows.select(
        *(
            rebuilt.get(c, F.col(renamed.get(c, c))).alias(c)
            for c in STAGING.fieldNames()
        )
    )
