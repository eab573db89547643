"""The symbol list: positions, slices, shards, symbols without data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.operators.numbering import positions


def symbol_positions(symbols: DataFrame, code: str = "Stock_Code") -> DataFrame:
    """Add ``position``, the 0-based place in code order."""
    return positions(symbols, [code])


def symbol_count(symbols: DataFrame) -> DataFrame:
    return symbols.agg(F.count("*").alias("n_symbols"))


def position_slice(symbols: DataFrame, start: int, end: int) -> DataFrame:
    """Symbols with start <= position < end."""
    return symbols.where((F.col("position") >= start) & (F.col("position") < end))


def symbol_shards(symbols: DataFrame, shards: int = 3) -> DataFrame:
    """Add ``shard``: equal slices of n div shards, the remainder in the last one.

    With fewer symbols than shards the slices are empty and all symbols are in
    the last shard.
    """
    total = symbol_count(symbols).scalar()
    width = F.floor(total / shards)
    last = F.lit(shards - 1).cast("bigint")
    slot = F.floor(F.col("position") / F.greatest(width, F.lit(1)))
    shard = F.when(width == 0, last).otherwise(F.least(slot, last))
    return symbols.withColumn("shard", shard.cast("int"))


def missing_codes(
    symbols: DataFrame, quotes: DataFrame, symbol: str = "Stock_Code", code: str = "code"
) -> DataFrame:
    """Symbols without any quote."""
    # distinct() shrinks hot symbols before the shuffle; the anti join reuses it.
    seen = quotes.select(F.col(code).alias(symbol)).distinct()
    return symbols.select(symbol).join(seen, symbol, "left_anti")
