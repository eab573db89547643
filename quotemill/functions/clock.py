"""Column expressions for the date and time texts of a price record."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

CLOCK_UNITS = ("hours", "minutes", "seconds")


def _spaced(stamp: Column) -> Column:
    # "<date> <clock>" or "<date>T<clock>", with one blank between.
    return F.replace(F.trim(stamp), F.lit("T"), F.lit(" "))


def _has_date(stamp: Column) -> Column:
    return F.contains(_spaced(stamp), F.lit(" "))


def _is_bare_clock(stamp: Column) -> Column:
    return ~_has_date(stamp) & F.contains(stamp, F.lit(":"))


def _part(text: Column, separator: str, number: int) -> Column:
    # Part ``number`` from 1, which must exist unless it is the first. Index
    # search only: splitting builds an array, and a pattern, for each row.
    until = F.substring_index(text, separator, number)
    return until if number == 1 else F.substring_index(until, separator, -1)


def clock_text(stamp: Column) -> Column:
    """Time of day of a stamp, NULL when there is none."""
    return F.when(_has_date(stamp), _part(_spaced(stamp), " ", 2)).when(
        F.contains(stamp, F.lit(":")), F.trim(stamp)
    )


def stamp_date(stamp: Column, run_date: dt.date | str | None = None) -> Column:
    """Date of a stamp. A bare clock takes ``run_date``; the system clock is never read."""
    day = F.lit(None if run_date is None else str(run_date)).cast("date")
    return F.when(_is_bare_clock(stamp), day).otherwise(
        _part(_spaced(stamp), " ", 1).try_cast("date")
    )


def clock_unit(clock: Column, unit: str) -> Column:
    """Hours, minutes or seconds of a time of day; NULL when missing or not a number."""
    complete = F.concat(clock, F.lit("::"))  # missing parts are empty, so not a number
    piece = _part(complete, ":", CLOCK_UNITS.index(unit) + 1)
    return _part(piece, ".", 1).try_cast("int")
