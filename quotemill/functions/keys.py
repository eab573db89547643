"""Column expressions for computed keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The parts of the date key in order, with their full widths.
DATE_KEY_PARTS = {
    "year_col": 4,
    "month_col": 2,
    "day_col": 2,
    "hours_update": 2,
    "minutes_update": 2,
    "seconds_update": 2,
}

INT_MAX = 2147483647


def date_key(padded: bool = False) -> Column:
    """Date key of a staging row; NULL when any part is NULL.

    Unpadded parts are the established format and can collide (1:55:50 and
    15:55:00); ``padded`` gives each part its full width, yyyyMMddHHmmss.
    """
    parts = [
        F.lpad(F.col(name).cast("string"), width, "0") if padded else F.col(name).cast("string")
        for name, width in DATE_KEY_PARTS.items()
    ]
    return F.concat(*parts).try_cast("bigint")
