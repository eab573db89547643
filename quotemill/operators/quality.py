"""Key constraints as queries: each returns the rows that break the rule."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.functions.keys import INT_MAX
from quotemill.schemas import FOREIGN_KEYS, MEASURE_DIMS


def pk_violations(table: DataFrame, key: str) -> DataFrame:
    """Key values that are NULL or used more than once, with their row counts."""
    return (
        table.groupBy(key)
        .agg(F.count("*").alias("n_rows"))
        .where((F.col("n_rows") > 1) | F.col(key).isNull())
    )


def date_id_overflow(datetime_dim: DataFrame, key: str = "date_id") -> DataFrame:
    """Rows whose key does not fit a 32-bit integer."""
    return datetime_dim.where(F.col(key) > INT_MAX)


def fk_orphans(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Fact keys without a dimension row: (fact_column, key, n_rows). NULL passes.

    All six constraints in one pass over the facts. Keys are counted before the
    join, so a key used by many facts is one row there.
    """
    used = (
        fact.select(*(F.col(column).cast("bigint").alias(column) for column in FOREIGN_KEYS))
        .unpivot([], list(FOREIGN_KEYS), "fact_column", "key")
        .where(F.col("key").isNotNull())
        .groupBy("fact_column", "key")
        .agg(F.count("*").alias("n_rows"))
    )
    valid = reduce(
        DataFrame.unionByName,
        [
            dims[table].select(
                F.lit(column).alias("fact_column"), F.col(key).cast("bigint").alias("key")
            )
            for column, (table, key) in FOREIGN_KEYS.items()
        ],
    )
    return used.join(valid, ["fact_column", "key"], "left_anti")


def unmatched_quotes(staging: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Quotes that do not reach the fact table: (code, stock_date, time_update, reason).

    One row per quote and dimension without a match. The five measure
    dimensions share their key, so one join answers for all of them. NULL keys
    match nothing; they skip the joins, so they cannot gather in one task.
    """
    quote = staging.select("code", "stock_date", "time_update")
    no_measure_key = F.col("code").isNull() | F.col("stock_date").isNull()
    no_date_key = F.col("stock_date").isNull() | F.col("time_update").isNull()
    measures = F.array(*(F.lit(table) for table in MEASURE_DIMS))
    no_reason = F.array().cast("array<string>")

    keyless = quote.where(no_measure_key | no_date_key).select(
        "*",
        F.explode(
            F.concat(
                F.when(no_date_key, F.array(F.lit("datetime_dim"))).otherwise(no_reason),
                F.when(no_measure_key, measures).otherwise(no_reason),
            )
        ).alias("reason"),
    )
    loaded = reduce(
        DataFrame.unionByName,
        [dims[t].select("code", "stock_date", F.lit(t).alias("__table")) for t in MEASURE_DIMS],
    )
    # At most five names per key, whatever the number of rows behind them.
    present = loaded.groupBy("code", "stock_date").agg(F.collect_set("__table").alias("__in"))
    without_measures = (
        quote.where(~no_measure_key)
        .join(present, ["code", "stock_date"], "left")
        .select(
            *quote.columns,
            F.explode(F.array_except(measures, F.coalesce("__in", no_reason))).alias("reason"),
        )
    )
    dates = dims["datetime_dim"].select("stock_date", "time_update").distinct()
    without_date = (
        quote.where(~no_date_key)
        .join(dates, ["stock_date", "time_update"], "left_anti")
        .select(*quote.columns, F.lit("datetime_dim").alias("reason"))
    )
    return keyless.unionByName(without_measures).unionByName(without_date)
