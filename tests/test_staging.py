import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotemill import plans
from quotemill.schemas import QUOTE, STAGING

DAY = dt.date(2023, 8, 10)


def quote_rows(spark, rows):
    """Quotes of (code, date, time); all other fields NULL."""
    frame = spark.createDataFrame(rows, "code string, date date, time string")
    names = [f for f in QUOTE if f.name not in ("code", "date", "time")]
    full = frame.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in names))
    return full.select(*QUOTE.fieldNames())


def staged(spark, time, date=DAY, **options):
    return plans.transform_quotes(quote_rows(spark, [("A", date, time)]), **options).first()


def clock(row):
    return row.time_update, row.date_update, row.hours_update, row.minutes_update, row.seconds_update


def test_full_stamp(spark):
    row = staged(spark, "2023-08-11 15:11:02")
    assert clock(row) == ("15:11:02", dt.date(2023, 8, 11), 15, 11, 2)
    assert (row.date_string, row.year_col, row.month_col, row.day_col) == ("2023-08-10", 2023, 8, 10)


def test_iso_stamp_and_fraction(spark):
    row = staged(spark, "2023-08-11T05:01:09.250")
    assert clock(row) == ("05:01:09.250", dt.date(2023, 8, 11), 5, 1, 9)


def test_bare_clock_takes_the_given_run_date(spark):
    assert clock(staged(spark, "15:11:02"))[1] is None
    row = staged(spark, "15:11:02", run_date="2023-08-12")
    assert clock(row) == ("15:11:02", dt.date(2023, 8, 12), 15, 11, 2)


@pytest.mark.parametrize("time", ["bad", "", None])
def test_unreadable_time_is_null(spark, time):
    assert clock(staged(spark, time, run_date="2023-08-12")) == (None,) * 5


def test_partly_readable_clock(spark):
    row = staged(spark, "2023-08-11 15:xx")
    assert (row.hours_update, row.minutes_update, row.seconds_update) == (15, None, None)


def test_update_parts(spark):
    row = staged(spark, "2023-08-11 15:11:02")
    assert (row.year_update, row.month_update, row.day_update) == (2023, 8, 10)
    row = staged(spark, "2023-08-11 15:11:02", update_parts_from="date_update")
    assert (row.year_update, row.month_update, row.day_update) == (2023, 8, 11)
    with pytest.raises(ValueError):
        staged(spark, "x", update_parts_from="clock")


def test_null_date(spark):
    row = staged(spark, "2023-08-11 15:11:02", date=None)
    assert (row.stock_date, row.date_string, row.year_col) == (None, None, None)


def test_schema(spark, quotes):
    staging = plans.transform_quotes(quotes)
    assert [(f.name, f.dataType) for f in staging.schema] == [(f.name, f.dataType) for f in STAGING]
    assert plans.blank_staging(spark).schema == STAGING
    assert plans.blank_staging(spark).count() == 0


def test_rename_needs_all_columns(quotes):
    with pytest.raises(ValueError):
        plans.rename_by_position(quotes, ["a"])


def test_date_key_forms(spark):
    rows = [
        ("A", dt.date(2024, 1, 19), "2024-01-19 01:55:50"),
        ("B", dt.date(2024, 1, 19), "2024-01-19 15:55:00"),
        ("C", dt.date(2024, 1, 19), None),
    ]
    staging = plans.transform_quotes(quote_rows(spark, rows))
    plain = sorted(r.date_id for r in plans.datetime_dim(staging).collect() if r.date_id)
    assert plain == [202411915550, 202411915550]
    padded = plans.datetime_dim(staging, padded=True).collect()
    assert {r.date_id for r in padded} == {20240119015550, 20240119155500, None}
