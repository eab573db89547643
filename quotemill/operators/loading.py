"""Which rows of a load are new to a table, with continued keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.operators.numbering import assign_keys, last_key

BUSINESS_KEY = ("code", "stock_date")


def rows_not_in(
    candidates: DataFrame, existing: DataFrame, business_key: Sequence[str] = BUSINESS_KEY
) -> DataFrame:
    """Candidates whose business key is not loaded yet; NULL equals NULL.

    A struct compares NULL fields as equal, and distinct() and the join hash the
    same column, so existing keys are reduced and shuffled once.
    """
    key = F.struct(*business_key).alias("__key")
    known = existing.select(key).distinct()
    return candidates.select("*", key).join(known, "__key", "left_anti").drop("__key")


def append_new(
    candidates: DataFrame,
    existing: DataFrame,
    key: str,
    business_key: Sequence[str] = BUSINESS_KEY,
    order: Sequence[str] = ("stock_date", "code"),
) -> DataFrame:
    """New rows only, keyed from the highest existing key on."""
    fresh = rows_not_in(candidates, existing, business_key)
    return assign_keys(fresh, key, order, start=last_key(existing, key))
