"""Row selection over quotes: ranges, pages, first records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemill.operators.numbering import positions, sort_columns
from quotemill.schemas import PAGE_SIZE


def price_range(
    quotes: DataFrame,
    from_date: str,
    to_date: str,
    codes: DataFrame | str | None = None,
    code: str = "code",
    date: str = "date",
) -> DataFrame:
    """Quotes of the closed date range, of one code or of a table of codes."""
    day = F.col(date)
    in_range = quotes.where(
        (day >= F.lit(from_date).cast("date")) & (day <= F.lit(to_date).cast("date"))
    )
    if codes is None:
        return in_range
    if isinstance(codes, str):
        return in_range.where(F.col(code) == codes)
    wanted = codes.select(F.col(codes.columns[0]).alias(code))
    return in_range.join(wanted, code, "left_semi")


def price_page(
    quotes: DataFrame,
    page: int = 1,
    size: int = PAGE_SIZE,
    code: str = "code",
    order: Sequence[str] = ("date",),
) -> DataFrame:
    """Page ``page`` (from 1) of each symbol's records in ``order``.

    Only symbols with more than ``size`` records need ranking, and those are
    ranked by global position, so no symbol is ever held in one task. All other
    symbols are on page 1 whole and are not shuffled.
    """
    if page < 1 or size < 1:
        raise ValueError("page and size start at 1")
    skipped = size * (page - 1)
    least = max(size, skipped)
    long_codes = (
        quotes.groupBy(code)
        .count()
        .where(F.col("count") > least)
        .select(F.col(code).alias("__long"))
    )
    # One bounded row tells whether anything has to be ranked at all.
    if long_codes.isEmpty():
        return quotes if page == 1 else quotes.where(F.lit(False))
    is_long = F.col(code).eqNullSafe(F.col("__long"))
    ranked = positions(
        quotes.join(long_codes, is_long, "left_semi"), [code, *order], "__position"
    )
    firsts = ranked.groupBy(code).agg(F.min("__position").alias("__first")).alias("f")
    paged = (
        ranked.alias("r")
        .join(firsts, F.col(f"r.{code}").eqNullSafe(F.col(f"f.{code}")))
        .where((F.col("__position") - F.col("__first")).between(skipped, skipped + size - 1))
        .select(*(F.col(f"r.{c}") for c in quotes.columns))
    )
    if page > 1:
        return paged
    return quotes.join(long_codes, is_long, "left_anti").unionByName(paged)


def first_record(
    quotes: DataFrame,
    by: Sequence[str] = ("code",),
    order: Sequence[str] = ("date",),
    ascending: bool = True,
) -> DataFrame:
    """First record of each group in ``order``; ties broken by all other columns.

    ``row_number() = 1`` gets a group limit before the shuffle, so each task
    sends at most one row per group however large the group is.
    """
    lead = [F.col(c).asc() if ascending else F.col(c).desc() for c in order]
    rest = [F.col(c) for c in sort_columns(quotes, order) if c not in order and c not in by]
    window = Window.partitionBy(*by).orderBy(*lead, *rest)
    return (
        quotes.withColumn("__rank", F.row_number().over(window))
        .where(F.col("__rank") == 1)
        .drop("__rank")
    )


def distinct_on_date(quotes: DataFrame, day: str, date: str = "date") -> DataFrame:
    """Distinct rows of one day."""
    return quotes.where(F.col(date) == F.lit(day).cast("date")).distinct()
