"""Dense row numbers and surrogate keys without a single-partition sort.

Rows are spread by sampled ranges of the full sort key, so a hot date, symbol or
(symbol, date) is cut into many ranges. Exact copies of a row cannot be cut by
value; they are told apart by their place in a landed file, which is the same on
every attempt. Each range numbers its own rows while it is written, and a table
with one row per range supplies the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.scratch import land

_PLACE = "__place"
_COPY = "__copy"
_RANGE = "__range"
_BEFORE = "__before"

# monotonically_increasing_id(): partition in the upper 31 bits, row in the lower 33.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def sort_columns(df: DataFrame, order: Sequence[str]) -> list[str]:
    """``order`` followed by every other column, so only exact copies tie."""
    return [*order, *(c for c in df.columns if c not in order)]


def positions(
    df: DataFrame,
    order: Sequence[str],
    position: str = "position",
    land_input: bool = True,
) -> DataFrame:
    """Add the 0-based position of each row in the order of ``order``, then all columns.

    Runs when called: the ranges are written to scratch. ``land_input=False``
    saves one write; it is right when ``df`` is a plain scan of files or has no
    exact copies of rows.
    """
    source = land(df, "rows") if land_input else df
    keys = [*sort_columns(df, order), _COPY]
    ranged = (
        source.withColumn(_COPY, F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(*df.columns, F.monotonically_increasing_id().alias(_PLACE))
    )
    numbered = land(ranged, "ranges").withColumn(
        _RANGE, F.shiftright(F.col(_PLACE), _ROW_BITS).cast("int")
    )
    # One row per range: bounded by the number of shuffle partitions, whatever
    # the data size, so the window and the broadcast below stay small.
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy(_RANGE)
        .agg(F.count("*").alias("__rows"))
        .select(_RANGE, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias(_BEFORE))
    )
    place_in_range = F.col(_PLACE).bitwiseAND(F.lit(_ROW_MASK))
    return numbered.join(F.broadcast(offsets), _RANGE).select(
        *df.columns, (F.col(_BEFORE) + place_in_range).alias(position)
    )


def assign_keys(
    df: DataFrame,
    key: str,
    order: Sequence[str] = ("stock_date", "code"),
    start: int | Column = 0,
    land_input: bool = True,
) -> DataFrame:
    """Put a key ``start+1, start+2, ...`` in front of ``df``, in ``order``."""
    first = F.lit(start) if isinstance(start, int) else start
    numbered = positions(df, order, "__position", land_input)
    return numbered.select((first + F.col("__position") + 1).cast("bigint").alias(key), *df.columns)


def last_key(existing: DataFrame, key: str) -> Column:
    """Highest key in use, 0 for an empty table; a scalar inside the plan."""
    return existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("last")).scalar()
