"""Union of shards and the all-or-nothing gate in front of the load."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_shards(frames: Sequence[DataFrame]) -> DataFrame:
    """Union all by column name; a column missing on one side is NULL there."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def publish_if_complete(
    quotes: DataFrame,
    shards: Sequence[int],
    shard: str = "shard",
    failures: DataFrame | None = None,
) -> DataFrame:
    """All rows when each expected shard has a row and none failed, else no rows.

    ``failures`` holds failed requests with the same shard column. The decision
    is a scalar inside the plan: it counts distinct shards, so each task sends a
    few rows whatever the data size.
    """
    expected = list(shards)
    present = (
        quotes.where(F.col(shard).isin(expected))
        .agg((F.count_distinct(shard) == len(set(expected))).alias("complete"))
        .scalar()
    )
    if failures is None:
        return quotes.where(present)
    failed = (
        failures.where(F.col(shard).isin(expected))
        .agg((F.count("*") == 0).alias("clean"))
        .scalar()
    )
    return quotes.where(present & failed)
