"""Inputs derived from the given tables; every one grows with its table.

Each fixture has the same definition as SQL in ``workload.oracles``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotemill.functions.messages import to_message
from quotemill.operators import symbol_positions, symbol_shards
from quotemill.schemas import QUOTE
from quotemill.scratch import land, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def symbol_code(number: str) -> Column:
    digits = F.col(number).cast("string")
    return F.concat(F.lit("U"), F.lpad(digits, F.greatest(F.lit(5), F.length(digits)), F.lit("0")))


def quotes_of(events: DataFrame) -> DataFrame:
    """each event as one quote; several quotes share a symbol and a date."""
    value = F.col("value")
    volume = F.get_json_object("props", "$.k").cast("double")
    fields = {
        "code": symbol_code("user_id"),
        "date": F.col("ts").cast("date"),
        "time": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        "floor": F.col("event_type"),
        "type": F.lit("STOCK"),
        "basicPrice": value,
        "ceilingPrice": value * 1.07,
        "floorPrice": value * 0.93,
        "open": value,
        "high": value + 1.0,
        "low": value - 1.0,
        "close": value + 0.5,
        "average": value,
        "adOpen": value / 2,
        "adHigh": (value + 1.0) / 2,
        "adLow": (value - 1.0) / 2,
        "adClose": (value + 0.5) / 2,
        "adAverage": value / 2,
        "nmVolume": volume,
        "nmValue": volume * value,
        "ptVolume": F.lit(0.0),
        "ptValue": F.lit(0.0),
        "change": F.lit(0.5),
        "adChange": F.lit(0.25),
        "pctChange": F.lit(50.0) / F.nullif(value, F.lit(0.0)),
    }
    return events.select(*(fields[name].alias(name) for name in QUOTE.fieldNames()))


def quotes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes_of(table(spark, sf_dir, "events"))


def quotes_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one quote per symbol and date."""
    earliest = Window.partitionBy("code", "date").orderBy("time", "basicPrice", "floor", "nmVolume")
    return (
        quotes_raw(spark, sf_dir)
        .withColumn("rn", F.row_number().over(earliest))
        .where(F.col("rn") == 1)
        .drop("rn")
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a response of 0, 1 or 2 records per event; some are not JSON.

    A second record is the same quote one day later.
    """
    quotes = quotes_raw(spark, sf_dir)
    next_day = [
        (F.date_add("date", 1) if name == "date" else F.col(name)).alias(name)
        for name in quotes.columns
    ]
    k = F.col("nmVolume").cast("int")
    records = F.slice(F.array(F.struct(*quotes.columns), F.struct(*next_day)), F.lit(1), k % 3)
    payload = F.when(k % 7 == 6, F.lit("upstream error")).otherwise(
        F.to_json(F.struct(records.alias("data")))
    )
    return quotes.select("code", payload.alias("payload"))


def clean_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per F2 quote, none of them failed."""
    quotes = quotes_daily(spark, sf_dir)
    record = F.array(F.struct(*quotes.columns)).alias("data")
    return quotes.select("code", F.to_json(F.struct(record)).alias("payload"))


def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the symbol list, one symbol per customer."""
    return table(spark, sf_dir, "customer").select(symbol_code("c_custkey").alias("Stock_Code"))


def traded_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols with at least one quote."""
    return quotes_raw(spark, sf_dir).select(F.col("code").alias("Stock_Code")).distinct()


def sharded_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 with the shard of its symbol, landed because several readers follow."""
    shards = symbol_shards(symbol_positions(traded_symbols(spark, sf_dir)))
    placed = shards.select(F.col("Stock_Code").alias("code"), "shard")
    quotes = quotes_daily(spark, sf_dir).join(placed, "code")
    return land(quotes.select(*QUOTE.fieldNames(), "shard"), "shards")


def messages_of(events: DataFrame) -> DataFrame:
    """each quote as a JSON message, the time of its event beside it.

    Messages of ``error`` events are cut short, those of ``signup`` events hold
    text in a number field.
    """
    quotes = quotes_of(events)
    kind = F.col("floor")
    text = to_message(quotes.columns)
    bad_number = F.regexp_replace(text, r'"basicPrice":[^,]*', '"basicPrice":"n/a"')
    value = F.when(kind == "error", F.substring_index(text, ",", 6))
    value = value.when(kind == "signup", bad_number).otherwise(text)
    stamp = F.to_timestamp("time")
    return quotes.select(value.alias("value"), stamp.alias("timestamp"))


def spread(rows: DataFrame) -> DataFrame:
    """The rows over as many tasks as run at once: a short table may lie in few row groups, and
    what is made of its rows is many times as long."""
    return rows.repartition(max(2, rows.sparkSession.sparkContext.defaultParallelism))


def messages_plain(quotes: DataFrame) -> DataFrame:
    """Each quote as a JSON message."""
    return quotes.select(to_message(quotes.columns).alias("value"))


def message_stream(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """The messages as a stream over files, with the columns of a topic."""
    events = spread(table(spark, sf_dir, "events"))
    if broken:
        messages = messages_of(events)
    else:
        quotes = quotes_of(events)
        stamp = F.to_timestamp("time").alias("timestamp")
        messages = quotes.select(to_message(quotes.columns).alias("value"), stamp)
    path = scratch_path(spark, "topic")
    land(messages, path=path)
    return spark.readStream.schema(messages.schema).parquet(path)


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a company response per supplier."""
    record = F.struct(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("bigint").alias("nation"),
    )
    payload = F.to_json(F.struct(F.array(record).alias("Data")))
    return table(spark, sf_dir, "supplier").select(payload.alias("payload"))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a listing page per customer: two heading rows, one data row.

    The segment cell is missing, with those after it, for customers in debt.
    """
    customer = table(spark, sf_dir, "customer")

    def cell(text: Column) -> Column:
        return F.concat(F.lit("<td>"), text, F.lit("</td>"))

    row = F.concat(
        F.lit('<tr class="row">'),
        cell(F.lit("1")),
        cell(F.concat(F.lit("<b>"), symbol_code("c_custkey"), F.lit("</b>"))),
        cell(F.col("c_name")),
        F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(
            F.concat(
                cell(F.col("c_mktsegment")),
                cell(F.concat(F.lit("EX"), F.col("c_nationkey").cast("string"))),
                cell(F.col("c_custkey").cast("string")),
            )
        ),
        F.lit("</tr>"),
    )
    html = F.concat(
        F.lit("<table><tr><th>Listing</th></tr>\n<tr><th>No</th><th>Code</th></tr>\n"),
        row,
        F.lit("</table>"),
    )
    return customer.select(F.col("c_custkey").alias("page_id"), html.alias("html"))


def nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a page per order: a row for it whose second cell holds a table of its lines, then a row without one.

    The status of a line stands in a third table, in a cell of the second. A table in a comment counts for nothing.
    """
    def row(line: Column) -> Column:
        return F.concat(
            F.lit("<tr><td>"), line["l_linenumber"].cast("string"), F.lit("</td>\n<td><table><tr><td>"),
            line["l_linestatus"], F.lit("</td></tr></table></td><td>"), line["l_returnflag"], F.lit("</td></tr>"),
        )

    # The text of a line is made after the shuffle: it is several times as long as what it is made of.
    columns = F.struct("l_linenumber", "l_suppkey", "l_linestatus", "l_returnflag")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("page_id")).agg(F.collect_list(columns).alias("lines"))
    ordered = F.transform("lines", lambda one: F.struct(one["l_linenumber"], one["l_suppkey"], row(one).alias("row")))
    lines = lines.select("page_id", F.sort_array(ordered).alias("lines"))
    inner = F.array_join(F.transform("lines", lambda one: one["row"]), "\n")
    html = F.concat(
        F.lit("<!-- <table><tr> --><TABLE class='t'><tr><td>"), F.col("page_id").cast("string"),
        F.lit("</td><td>lines <TABLE>"), inner, F.lit("</TABLE> end</td><td><b>last</b></td></tr>\n<tr><td>total</td><td>"),
        F.size("lines").cast("string"), F.lit("</td></tr></TABLE></table>"),
    )
    return lines.select("page_id", html.alias("html"))
