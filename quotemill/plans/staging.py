"""Quotes to staging rows: 25 columns in, 36 out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.functions.clock import CLOCK_UNITS, clock_text, clock_unit, stamp_date
from quotemill.schemas import QUOTE, STAGING


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    if len(df.columns) != len(names):
        raise ValueError(f"{len(df.columns)} columns but {len(names)} names")
    return df.toDF(*names)


def blank_staging(spark: SparkSession) -> DataFrame:
    """The empty staging table, typed."""
    return spark.createDataFrame([], STAGING)


def transform_quotes(
    quotes: DataFrame,
    run_date: dt.date | str | None = None,
    update_parts_from: str = "date_string",
) -> DataFrame:
    """Derive the date and time columns and give all columns their staging names.

    ``update_parts_from="date_string"`` takes year, month and day of the update
    from the trading date, which is the established output; ``"date_update"``
    takes them from the update date. Projections only, no shuffle.
    """
    if update_parts_from not in ("date_string", "date_update"):
        raise ValueError("update_parts_from is date_string or date_update")
    # Texts are taken apart once, the columns after it read the parts.
    parsed = quotes.select(
        *(F.col(name) for name in QUOTE.fieldNames() if name not in ("date", "time")),
        F.col("date").cast("date").alias("date"),
        clock_text(F.col("time")).alias("time"),
        stamp_date(F.col("time"), run_date).alias("__update_day"),
    )
    update_day = F.col("__update_day")
    parts_day = F.col("date") if update_parts_from == "date_string" else update_day
    derived = [
        F.date_format("date", "yyyy-MM-dd"),
        F.year("date"), F.month("date"), F.dayofmonth("date"),
        update_day,
        F.year(parts_day), F.month(parts_day), F.dayofmonth(parts_day),
        *(clock_unit(F.col("time"), unit) for unit in CLOCK_UNITS),
    ]
    return rename_by_position(
        parsed.select(*QUOTE.fieldNames(), *derived), STAGING.fieldNames()
    )
