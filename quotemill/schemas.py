"""Column names and types of every table the engine reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names, their order and their types are the data contract
# with the price source and with readers of the star tables.

QUOTE = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("time", T.StringType()),
        T.StructField("floor", T.StringType()),
        T.StructField("type", T.StringType()),
    ]
    + [
        T.StructField(name, T.DoubleType())
        for name in (
            "basicPrice", "ceilingPrice", "floorPrice",
            "open", "high", "low", "close", "average",
            "adOpen", "adHigh", "adLow", "adClose", "adAverage",
            "nmVolume", "nmValue", "ptVolume", "ptValue",
            "change", "adChange", "pctChange",
        )
    ]
)

# Stream messages carry the same fields; only ``date`` is a timestamp there.
QUOTE_MESSAGE = T.StructType(
    [
        T.StructField(f.name, T.TimestampType() if f.name == "date" else f.dataType)
        for f in QUOTE
    ]
)

STAGING = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("stock_date", T.DateType()),
        T.StructField("time_update", T.StringType()),
        T.StructField("floor", T.StringType()),
        T.StructField("typeStock", T.StringType()),
    ]
    + [
        T.StructField(name, T.DoubleType())
        for name in (
            "basicPrice", "ceilingPrice", "floorPrice",
            "open_col", "high_col", "low_col", "close_col", "average_col",
            "ad_open", "ad_high", "ad_low", "ad_close", "adaverage",
            "nmVolumne", "nmValue", "ptVolumne", "ptValue",
            "changecol", "adChange", "pctChange",
        )
    ]
    + [
        T.StructField("date_string", T.StringType()),
        T.StructField("year_col", T.IntegerType()),
        T.StructField("month_col", T.IntegerType()),
        T.StructField("day_col", T.IntegerType()),
        T.StructField("date_update", T.DateType()),
        T.StructField("year_update", T.IntegerType()),
        T.StructField("month_update", T.IntegerType()),
        T.StructField("day_update", T.IntegerType()),
        T.StructField("hours_update", T.IntegerType()),
        T.StructField("minutes_update", T.IntegerType()),
        T.StructField("seconds_update", T.IntegerType()),
    ]
)

DATETIME_DIM = T.StructType(
    [
        T.StructField("date_id", T.LongType()),
        T.StructField("stock_date", T.DateType()),
        T.StructField("stock_year", T.IntegerType()),
        T.StructField("stock_month", T.IntegerType()),
        T.StructField("stock_day", T.IntegerType()),
        T.StructField("date_update", T.DateType()),
        T.StructField("year_update", T.IntegerType()),
        T.StructField("month_update", T.IntegerType()),
        T.StructField("day_update", T.IntegerType()),
        T.StructField("time_update", T.StringType()),
        T.StructField("hours_update", T.IntegerType()),
        T.StructField("minutes_update", T.IntegerType()),
        T.StructField("seconds_update", T.IntegerType()),
    ]
)

# Measure dimensions: table -> (surrogate key, {dimension column: staging column}).
MEASURE_DIMS = {
    "price_dim": (
        "price_id",
        {"basicPrice": "basicPrice", "ceilingPrice": "ceilingPrice", "floorPrice": "floorPrice"},
    ),
    "OHLC_dim": (
        "idOHLC",
        {
            "open_col": "open_col", "high_col": "high_col", "low_col": "low_col",
            "close_col": "close_col", "average": "average_col",
        },
    ),
    "ad_dim": (
        "ad_id",
        {
            "adopen": "ad_open", "adhigh": "ad_high", "adlow": "ad_low",
            "adclose": "ad_close", "adaverage": "adaverage",
        },
    ),
    "vol_val_dim": (
        "id_vol_val_dim",
        {
            "nmVolumne": "nmVolumne", "nmValue": "nmValue",
            "ptVolumne": "ptVolumne", "ptValue": "ptValue",
        },
    ),
    "change_dim": (
        "change_id",
        {"changecol": "changecol", "adChange": "adChange", "pctChange": "pctChange"},
    ),
}

FACT = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("dateKey", T.LongType()),
        T.StructField("floor", T.StringType()),
        T.StructField("typeStock", T.StringType()),
        T.StructField("priceKey", T.LongType()),
        T.StructField("OHLCKey", T.LongType()),
        T.StructField("adKey", T.LongType()),
        T.StructField("vol_val_key", T.LongType()),
        T.StructField("changeKey", T.LongType()),
    ]
)

# Fact foreign keys: fact column -> (referenced table, referenced key).
FOREIGN_KEYS = {
    "dateKey": ("datetime_dim", "date_id"),
    "priceKey": ("price_dim", "price_id"),
    "OHLCKey": ("OHLC_dim", "idOHLC"),
    "adKey": ("ad_dim", "ad_id"),
    "vol_val_key": ("vol_val_dim", "id_vol_val_dim"),
    "changeKey": ("change_dim", "change_id"),
}

SYMBOLS = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("Stock_Code", "Name_Company", "Industry", "Exchange", "KLCPNY")
    ]
)

# The streaming target names one field differently from the message.
STREAM_RENAMES = {"change": "changeCol"}

# Page size of one price response.
PAGE_SIZE = 9990


def measure_dim_schema(table: str) -> T.StructType:
    key, measures = MEASURE_DIMS[table]
    return T.StructType(
        [
            T.StructField(key, T.LongType()),
            T.StructField("code", T.StringType()),
            T.StructField("stock_date", T.DateType()),
        ]
        + [T.StructField(name, T.DoubleType()) for name in measures]
    )


def stream_table_schema() -> T.StructType:
    return T.StructType(
        [T.StructField("id", T.LongType())]
        + [T.StructField(STREAM_RENAMES.get(f.name, f.name), f.dataType) for f in QUOTE_MESSAGE]
    )


def star_schemas() -> dict[str, T.StructType]:
    """Every table of the star, staging included, by table name."""
    tables = {"full_data": STAGING, "datetime_dim": DATETIME_DIM}
    tables.update({name: measure_dim_schema(name) for name in MEASURE_DIMS})
    tables["fact_table"] = FACT
    return tables
