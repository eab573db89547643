"""One query per engine operation, over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill import operators as op
from quotemill import plans, sinks, sources, streaming
from quotemill.schemas import MEASURE_DIMS, QUOTE, STAGING, STREAM_RENAMES, star_schemas
from quotemill.scratch import delete_folder, land, scratch_path
from workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

STREAM_TIMEOUT = 300

MONTH = ("2024-01-01", "2024-01-31")
STORED_TO = "2024-01-10"
RELOADED = ("2024-01-10", "2024-01-20")
LOADS = (("2024-01-01", "2024-01-12"), ("2024-01-09", "2024-01-20"), ("2024-01-21", "2024-01-31"))


def _staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging rows of F2, landed: dimensions and fact read them several times."""
    return land(plans.transform_quotes(fx.quotes_daily(spark, sf_dir)), "staging")


def _star(
    spark: SparkSession, sf_dir: str, padded: bool = False
) -> tuple[DataFrame, dict[str, DataFrame]]:
    staging = _staging(spark, sf_dir)
    return staging, plans.dimensions(staging, padded, land_input=False)


def _first_load(staging: DataFrame, padded: bool = False) -> dict[str, DataFrame]:
    """Dimensions of an earlier load that held each symbol's first quote only."""
    first = op.first_record(staging, by=("code",), order=("stock_date",))
    return plans.dimensions(land(first, "first"), padded, land_input=False)


def _table_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


# Sources


def envelope_explode(spark, sf_dir):
    return sources.envelope_explode(fx.responses(spark, sf_dir))


def response_status(spark, sf_dir):
    status = sources.response_status(fx.responses(spark, sf_dir))
    return status.groupBy("code", "status").agg(
        F.count("*").alias("n_responses"),
        F.sum(F.col("n_records").cast("bigint")).alias("n_records"),
    )


def symbol_scan(spark, sf_dir):
    path = scratch_path(spark, "symbols")
    customer = fx.table(spark, sf_dir, "customer")
    listing = customer.select(
        fx.symbol_code("c_custkey").alias("Stock_Code"),
        F.col("c_name").alias("Name_Company"),
        F.col("c_mktsegment").alias("Industry"),
        F.concat(F.lit("EX"), F.col("c_nationkey").cast("string")).alias("Exchange"),
        F.col("c_custkey").cast("string").alias("KLCPNY"),
    )
    sinks.write_csv(listing, path)
    return sources.read_symbols(spark, path)


def html_rows(spark, sf_dir):
    return sources.html_rows(
        fx.table(spark, sf_dir, "pages"), r'<li><a href="([^"]*)">', "href", keep=("page_id",)
    )


def table_rows(spark, sf_dir):
    return sources.table_rows(fx.listing_pages(spark, sf_dir), keep=("page_id",))


NESTED_CELLS = {"name": 1, "content": 2, "flag": 3}


def nested_table_rows(spark, sf_dir):
    """Rows of outer tables: what stands in an inner table is text of its cell."""
    return sources.nested_table_rows(fx.nested_pages(spark, sf_dir), NESTED_CELLS, keep=("page_id",))


def inner_table_rows(spark, sf_dir):
    """Rows of the tables inside cells, and of those inside their cells."""
    pages = fx.nested_pages(spark, sf_dir)
    levels = [
        sources.nested_table_rows(pages, NESTED_CELLS, keep=("page_id",), depth=depth).withColumn("depth", F.lit(depth))
        for depth in (2, 3)
    ]
    return levels[0].unionByName(levels[1])


COMPANY = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("nation", T.LongType()),
    ]
)


def company_records(spark, sf_dir):
    return sources.company_records(fx.companies(spark, sf_dir), COMPANY)


def company_records_inferred(spark, sf_dir):
    return sources.company_records(fx.companies(spark, sf_dir))


def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    sinks.write_csv(fx.quotes_daily(spark, sf_dir), path)
    return sources.read_quotes(spark, path)


def directory_scan(spark, sf_dir):
    folder = scratch_path(spark, "day")
    quotes = fx.sharded_quotes(spark, sf_dir)
    for shard in range(3):
        rows = quotes.where(F.col("shard") == shard).drop("shard")
        sinks.write_csv(rows, f"{folder}/stock_price_{shard + 1}.csv")
    # The merged file of an earlier run, which the scan must leave out.
    sinks.write_csv(quotes.drop("shard"), f"{folder}/full_data.csv")
    return sources.read_shard_files(spark, folder)


def directory_scan_new(spark, sf_dir):
    """Two shards are loaded, a third file comes and one is written again: the second scan reads these two."""
    folder, ledger = scratch_path(spark, "day"), sources.FileLedger(spark, scratch_path(spark, "files"))
    quotes = fx.sharded_quotes(spark, sf_dir)

    def write(shard: int, rows: DataFrame) -> None:
        sinks.write_csv(rows.drop("shard"), f"{folder}/stock_price_{shard + 1}.csv", mode="overwrite")

    for shard in range(2):
        write(shard, quotes.where(F.col("shard") == shard))
    _, files = sources.read_new_shard_files(spark, f"{folder}/*", ledger, "*.csv")
    ledger.commit(files)
    write(2, quotes.where(F.col("shard") == 2))
    write(1, quotes.where((F.col("shard") == 1) & (F.col("floor") != "error")))
    return sources.read_new_shard_files(spark, f"{folder}/*", ledger, "*.csv")[0]


def _listed_symbols(spark, sf_dir):
    """The symbol list in files, in an order that is not that of the codes."""
    path = scratch_path(spark, "symbols")
    customer = fx.table(spark, sf_dir, "customer")
    mixed = F.md5(F.col("c_custkey").cast("string"))
    listing = customer.repartitionByRange(4, mixed).sortWithinPartitions(mixed).select(
        fx.symbol_code("c_custkey").alias("Stock_Code"),
        *(F.lit(None).cast("string").alias(c) for c in ("Name_Company", "Industry", "Exchange", "KLCPNY")),
    )
    sinks.write_csv(listing, path)
    return sources.read_symbols_listed(spark, path)


def position_slice_listed(spark, sf_dir):
    return op.position_slice(_listed_symbols(spark, sf_dir), 25, 75)


def symbol_shards_listed(spark, sf_dir):
    return op.symbol_shards(_listed_symbols(spark, sf_dir))


def bulk_load_positional(spark, sf_dir):
    path = scratch_path(spark, "bulk")
    staging = plans.transform_quotes(fx.quotes_daily(spark, sf_dir))
    headings = [f"field_{i}" for i in range(len(STAGING))]
    sinks.write_csv(staging.toDF(*headings), path)
    return sources.bulk_load(spark, path)


def blank_staging(spark, sf_dir):
    """Blank table plus staging rows: the same schema, so the same rows."""
    staging = plans.transform_quotes(fx.quotes_raw(spark, sf_dir))
    return plans.blank_staging(spark).unionByName(staging)


STAR_SQL = """
SELECT d.stock_month, d.stock_day, f.floor, count(*) AS n_quotes,
       min(o.low_col) AS lowest, max(o.high_col) AS highest, max(v.nmVolumne) AS top_volume
FROM fact_table f
JOIN datetime_dim d ON f.dateKey = d.date_id
JOIN OHLC_dim o ON f.OHLCKey = o.idOHLC
JOIN vol_val_dim v ON f.vol_val_key = v.id_vol_val_dim
GROUP BY d.stock_month, d.stock_day, f.floor
"""


def sql_query(spark, sf_dir):
    staging, dims = _star(spark, sf_dir)
    sources.register_tables({**dims, "fact_table": plans.fact_table(staging, dims)})
    return sources.sql_query(spark, STAR_SQL)


def sql_query_named(spark, sf_dir):
    staging = _staging(spark, sf_dir)
    sources.register_tables({"full_data": staging})
    query = "SELECT code, max(high_col), min(low_col), count(*) FROM full_data GROUP BY code"
    return sources.sql_query_named(spark, query, ["symbol", "top", "bottom", "days"])


def distinct_on_date(spark, sf_dir):
    quotes = fx.quotes_raw(spark, sf_dir)
    return op.distinct_on_date(quotes.unionAll(quotes), "2024-01-15")


# Selection


def price_range(spark, sf_dir):
    building = fx.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    codes = building.select(fx.symbol_code("c_custkey").alias("Stock_Code"))
    return op.price_range(fx.quotes_raw(spark, sf_dir), "2024-01-05", "2024-01-20", codes)


def price_page(spark, sf_dir):
    return op.price_page(fx.quotes_raw(spark, sf_dir), page=1)


def price_page_small(spark, sf_dir):
    return op.price_page(fx.quotes_raw(spark, sf_dir), page=1, size=70)


def price_page_second(spark, sf_dir):
    return op.price_page(fx.quotes_raw(spark, sf_dir), page=2, size=30)


def first_record(spark, sf_dir):
    return op.first_record(fx.quotes_raw(spark, sf_dir))


def first_record_latest(spark, sf_dir):
    return op.first_record(fx.quotes_raw(spark, sf_dir), ascending=False)


# Symbols


def symbol_count(spark, sf_dir):
    return op.symbol_count(fx.symbols(spark, sf_dir))


def position_slice(spark, sf_dir):
    return op.position_slice(op.symbol_positions(fx.symbols(spark, sf_dir)), 25, 75)


def symbol_shards(spark, sf_dir):
    return op.symbol_shards(op.symbol_positions(fx.symbols(spark, sf_dir)))


def missing_codes(spark, sf_dir):
    return op.missing_codes(fx.symbols(spark, sf_dir), fx.quotes_raw(spark, sf_dir))


# Union and gate


def union_by_name(spark, sf_dir):
    quotes = fx.sharded_quotes(spark, sf_dir)
    parts = [quotes.where(F.col("shard") == shard) for shard in range(3)]
    return op.union_shards([parts[0], parts[1], parts[2].drop("ptValue")])


def publish_complete(spark, sf_dir):
    return op.publish_if_complete(fx.sharded_quotes(spark, sf_dir), range(3))


def publish_incomplete(spark, sf_dir):
    quotes = fx.sharded_quotes(spark, sf_dir).where(F.col("shard") != 2)
    return op.publish_if_complete(quotes, range(3))


# Staging and dimensions


def transform_quotes(spark, sf_dir):
    return plans.transform_quotes(fx.quotes_raw(spark, sf_dir))


def transform_quotes_bare_time(spark, sf_dir):
    quotes = fx.quotes_raw(spark, sf_dir)
    bare = quotes.withColumn("time", F.split_part("time", F.lit(" "), F.lit(2)))
    return plans.transform_quotes(bare, "2024-02-01", update_parts_from="date_update")


def datetime_dim(spark, sf_dir):
    return plans.datetime_dim(plans.transform_quotes(fx.quotes_daily(spark, sf_dir)))


def datetime_dim_padded(spark, sf_dir):
    return plans.datetime_dim(plans.transform_quotes(fx.quotes_raw(spark, sf_dir)), padded=True)


def _measure_dim(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        staging = plans.transform_quotes(fx.quotes_daily(spark, sf_dir))
        return plans.measure_dim(staging, table)

    return query


def assign_keys(spark, sf_dir):
    return op.assign_keys(fx.quotes_raw(spark, sf_dir), "quote_id", ("date", "code"))


def assign_keys_continue(spark, sf_dir):
    quotes = fx.quotes_raw(spark, sf_dir)
    first = op.assign_keys(op.first_record(quotes), "quote_id", ("date", "code"))
    start = op.last_key(first, "quote_id")
    return first.unionByName(op.assign_keys(quotes, "quote_id", ("date", "code"), start))


def dim_append_new(spark, sf_dir):
    staging = _staging(spark, sf_dir)
    loaded = _first_load(staging)["price_dim"]
    return op.append_new(plans.measure_rows(staging, "price_dim"), loaded, "price_id")


# Fact table


def fact_table(spark, sf_dir):
    staging, dims = _star(spark, sf_dir)
    return plans.fact_table(staging, dims)


def fact_reload_fanout(spark, sf_dir):
    """The same load appended twice without de-duplication."""
    staging, dims = _star(spark, sf_dir)
    for name, (key, _) in MEASURE_DIMS.items():
        again = dims[name].withColumn(key, F.col(key) + op.last_key(dims[name], key))
        dims[name] = dims[name].unionByName(again)
    return plans.fact_table(staging, dims)


def star_readback(spark, sf_dir):
    staging, dims = _star(spark, sf_dir, padded=True)
    return plans.star_readback(plans.fact_table(staging, dims), dims)


def _daily(spark, responses, symbols, first_by, loads=1):
    database = _load_database(spark)
    for _ in range(loads):
        fact = plans.run_daily(
            spark, responses, symbols, "2024-01-01", "2024-01-31", database=database, first_by=first_by
        )
    return fact


def _requests(spark, sf_dir):
    responses = land(fx.clean_responses(spark, sf_dir), "responses")
    return responses, land(fx.traded_symbols(spark, sf_dir), "symbols")


def daily_load(spark, sf_dir):
    """Responses to star tables, the load run twice; the second run adds nothing."""
    return _daily(spark, *_requests(spark, sf_dir), ("code",), loads=2)


def daily_load_all_dates(spark, sf_dir):
    """One record per symbol and date."""
    return _daily(spark, *_requests(spark, sf_dir), ("code", "date"))


def _load_database(spark: SparkSession) -> str:
    database = _table_name("star")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'star')}'")
    return database


def daily_reload_corrected(spark, sf_dir):
    """A month is loaded, then eleven of its days again, corrected: some times, some measures, some both;
    some quotes come late, some are withdrawn. Every quote keeps its keys, and has one fact."""
    database, kind = _load_database(spark), F.col("floor")
    quotes = fx.quotes_daily(spark, sf_dir)
    span = F.col("date").between(*(F.lit(d).cast("date") for d in RELOADED))
    first = land(plans.transform_quotes(quotes.where(~(span & (kind == "signup")))), "first")
    plans.load_star(spark, first, database, padded=True, dates=MONTH)
    corrected = quotes.where(span & (kind != "error")).withColumns(
        {
            "time": F.when(kind.isin("click", "view"), F.concat(F.substring("time", 1, 11), F.lit("23:59:59"))).otherwise(F.col("time")),
            "basicPrice": F.when(kind.isin("purchase", "view"), F.col("basicPrice") + 1).otherwise(F.col("basicPrice")),
            "close": F.when(kind.isin("purchase", "view"), F.col("close") + 1).otherwise(F.col("close")),
        }
    )
    again = land(plans.transform_quotes(corrected), "again")
    for _ in range(2):
        fact = plans.replace_star(spark, again, RELOADED, database, padded=True)
    dims = {name: spark.table(f"{database}.{name}") for name in [*MEASURE_DIMS, "datetime_dim"]}
    price = dims["price_dim"].select(F.col("price_id").alias("priceKey"), "stock_date", "basicPrice")
    ohlc = dims["OHLC_dim"].select(F.col("idOHLC").alias("OHLCKey"), "close_col")
    dates = dims["datetime_dim"].select(F.col("date_id").alias("dateKey"), "time_update")
    orphans = op.fk_orphans(fact, dims).agg(F.count("*").alias("n_orphans")).scalar()
    rows = fact.join(price, "priceKey").join(ohlc, "OHLCKey").join(dates, "dateKey")
    return rows.withColumn("n_orphans", orphans)


def assign_keys_ledger(spark, sf_dir):
    """Three loads into one star, the second over some days of the first: keys continue by the ledger."""
    database = _load_database(spark)
    staging = _staging(spark, sf_dir)
    for dates in LOADS:
        part = land(staging.where(F.col("stock_date").between(*(F.lit(d).cast("date") for d in dates))), "part")
        plans.load_star(spark, part, database, dates=dates)
    return spark.table(f"{database}.price_dim")


def response_rejects(spark, sf_dir):
    """Why a load is void: symbols without a response, with an unreadable one, with a record without a date."""
    responses = fx.clean_responses(spark, sf_dir)
    k = F.get_json_object("payload", "$.data[0].nmVolume").cast("double").cast("int")
    spoilt = F.when(k % 7 == 6, F.lit("upstream error")).otherwise(
        F.regexp_replace("payload", r'"date":"2024-01-01"', '"date":"01/2024"')
    )
    responses = responses.withColumn("payload", spoilt)
    quotes, rejects = plans.read_day(responses, fx.symbols(spark, sf_dir), *MONTH)
    return rejects.withColumn("n_published", quotes.agg(F.count("*").alias("n")).scalar())


def daily_load_absent_response(spark, sf_dir):
    """A requested symbol has no response: nothing is published."""
    responses, symbols = _requests(spark, sf_dir)
    first = responses.agg(F.min("code").alias("code"))
    return _daily(spark, responses.join(first, "code", "left_anti"), symbols, ("code",))


def daily_load_bad_date(spark, sf_dir):
    """A record's date cannot be read: nothing is published."""
    responses, symbols = _requests(spark, sf_dir)
    spoilt = F.regexp_replace("payload", r'"date":"2024-01-01"', '"date":"01/2024"')
    return _daily(spark, responses.withColumn("payload", spoilt), symbols, ("code",))


# Constraints


def pk_violations(spark, sf_dir):
    return op.pk_violations(datetime_dim(spark, sf_dir), "date_id")


def date_id_overflow(spark, sf_dir):
    return op.date_id_overflow(datetime_dim(spark, sf_dir))


def fk_orphans(spark, sf_dir):
    """Facts of the whole load against dimensions that only hold first quotes."""
    staging, dims = _star(spark, sf_dir)
    return op.fk_orphans(plans.fact_table(staging, dims), _first_load(staging))


def fk_orphans_valid(spark, sf_dir):
    staging, dims = _star(spark, sf_dir)
    return op.fk_orphans(plans.fact_table(staging, dims), dims)


def _summaries(spark: SparkSession) -> op.KeySummaries:
    return op.KeySummaries(spark, f"{_load_database(spark)}.key_summaries")


def pk_violations_of_load(spark, sf_dir):
    """Ten days of dates are stored; those of the other days are checked against them before they are."""
    dates = datetime_dim(spark, sf_dir)
    late = F.col("stock_date") > F.lit(STORED_TO).cast("date")
    path, summaries = scratch_path(spark, "dates"), _summaries(spark)
    dates.where(~late).write.partitionBy("stock_date").parquet(path)
    stored = spark.read.schema(dates.schema).parquet(path)
    summaries.refresh("datetime_dim", stored, "date_id")
    return op.pk_violations_of_load(dates.where(late), stored, "datetime_dim", "date_id", summaries)


def fk_orphans_of_load(spark, sf_dir):
    """Facts of some days against summaries of dimensions that only hold first quotes."""
    staging, dims = _star(spark, sf_dir)
    summaries = _summaries(spark)
    op.refresh_dimensions(summaries, _first_load(staging))
    days = F.col("stock_date").between(*(F.lit(d).cast("date") for d in RELOADED))
    return op.fk_orphans_of_load(plans.fact_table(staging.where(days), dims), summaries)


def unmatched_quotes(spark, sf_dir):
    staging = _staging(spark, sf_dir)
    return op.unmatched_quotes(staging, _first_load(staging))


# Sinks


def staging_replace(spark, sf_dir):
    name, path = _table_name("full_data"), scratch_path(spark, "full_data")
    staging = plans.transform_quotes(fx.quotes_daily(spark, sf_dir))
    for _ in range(2):
        replaced = sinks.replace_table(staging, name, path)
    return replaced


def create_if_absent(spark, sf_dir):
    """Created, filled, created again: the rows stay."""
    name, path = _table_name("price_dim"), scratch_path(spark, "price_dim")
    schema = star_schemas()["price_dim"]
    sinks.create_if_absent(spark, name, schema, path)
    staging = plans.transform_quotes(fx.quotes_daily(spark, sf_dir))
    sinks.append_table(plans.measure_dim(staging, "price_dim"), name)
    return sinks.create_if_absent(spark, name, schema, path)


def write_many(spark, sf_dir):
    """Two frames are written, one with a repeated column name is refused."""
    staging, path = _staging(spark, sf_dir), scratch_path(spark, "many")
    frames = {
        "price_dim": plans.measure_rows(staging, "price_dim"),
        "broken": staging.select("code", F.col("stock_date").alias("code")),
        "change_dim": plans.measure_rows(staging, "change_dim"),
    }
    outcome = sinks.write_tables(spark, frames, path=path)
    written = [
        spark.read.schema(frames[name].schema)
        .parquet(f"{path}/{name}")
        .groupBy(F.lit(name).alias("table"))
        .agg(F.count("*").alias("n_rows"))
        for name in ("price_dim", "change_dim")
    ]
    counts = reduce(DataFrame.unionByName, written)
    return outcome.join(counts, "table", "left").select("table", "ok", "n_rows")


def copy_table(spark, sf_dir):
    name, path = _table_name("daily_close"), scratch_path(spark, "daily_close")
    schema = T.StructType(
        [
            T.StructField("symbol", T.StringType()),
            T.StructField("trading_day", T.DateType()),
            T.StructField("closing", T.DoubleType()),
        ]
    )
    sinks.create_if_absent(spark, name, schema, path)
    source = fx.quotes_raw(spark, sf_dir).select("code", "date", "close")
    return sinks.copy_table(source, name, ["symbol", "trading_day", "closing"])


def json_encode(spark, sf_dir):
    encoded = sinks.encode_messages(fx.quotes_raw(spark, sf_dir))
    return _as_quotes(streaming.decode_quotes(encoded))


def backfill(spark, sf_dir):
    messages = streaming.backfill_messages(
        fx.quotes_raw(spark, sf_dir), fx.symbols(spark, sf_dir), "2024-01-05", "2024-01-20"
    )
    log = land(messages, "topic")
    return _as_quotes(streaming.decode_quotes(log))


def backfill_resumed(spark, sf_dir):
    """A replay dies in its third chunk and is run again: each message is sent once."""
    topic, ledger = scratch_path(spark, "topic"), scratch_path(spark, "chunks")
    quotes, codes = land(fx.quotes_raw(spark, sf_dir), "quotes"), fx.symbols(spark, sf_dir)
    sent = []

    def publish(rows: DataFrame) -> None:
        sent.append(rows)
        if len(sent) == 3:
            raise ConnectionError("injected")
        sinks.publish_messages(rows, "host:9092", "quotes", key="code", options={"path": topic}, format="parquet")

    for _ in range(2):
        try:
            streaming.resumable_backfill(quotes, codes, ledger, publish, "2024-01-05", "2024-01-20", parts=2, days=4)
        except ConnectionError:
            continue
    return _as_quotes(streaming.decode_quotes(spark.read.schema("key string, value string").parquet(topic)))


# Streams


def _as_quotes(decoded: DataFrame) -> DataFrame:
    return decoded.withColumn("date", F.col("date").cast("date"))


def _drain(spark: SparkSession, stream: DataFrame, write) -> None:
    query = streaming.start_batches(stream, write, scratch_path(spark, "checkpoint"), once=True)
    streaming.run_to_end(query, STREAM_TIMEOUT)


def stream_decode(spark, sf_dir):
    decoded = streaming.decode_quotes(fx.message_stream(spark, sf_dir))
    path = scratch_path(spark, "stream")
    _drain(spark, decoded, streaming.plain_batch_writer(path))
    return _as_quotes(streaming.read_batches(spark, path, decoded.schema)).drop("batch_id")


def stream_malformed(spark, sf_dir):
    _, malformed = streaming.split_malformed(fx.message_stream(spark, sf_dir, broken=True))
    path = scratch_path(spark, "malformed")
    _drain(spark, malformed, streaming.plain_batch_writer(path))
    rejected = streaming.read_batches(spark, path, malformed.schema)
    # The code still stands in the rejected text.
    code = F.regexp_extract("value", r'"code":"([^"]*)"', 1).alias("code")
    return rejected.select(code, F.contains("value", F.lit("n/a")).alias("bad_number"))


def stream_readable(spark, sf_dir):
    good, _ = streaming.split_malformed(fx.message_stream(spark, sf_dir, broken=True))
    path = scratch_path(spark, "readable")
    _drain(spark, good, streaming.plain_batch_writer(path))
    return _as_quotes(streaming.read_batches(spark, path, good.schema)).drop("batch_id")


def stream_foreachbatch(spark, sf_dir):
    path, checkpoint = scratch_path(spark, "stream_table"), scratch_path(spark, "checkpoint")
    messages = fx.message_stream(spark, sf_dir)
    for query in streaming.start_quote_stream(messages, path, checkpoint, once=True):
        streaming.run_to_end(query, STREAM_TIMEOUT)
    return _as_quotes(streaming.stream_table(spark, path)).drop("batch_id")


def stream_restart_new_checkpoint(spark, sf_dir):
    """Two checkpoints on one target: all messages of both, once each, under dense ids."""
    path = scratch_path(spark, "stream_table")
    for _ in range(2):
        messages = fx.message_stream(spark, sf_dir)
        checkpoint = scratch_path(spark, "checkpoint")
        for query in streaming.start_quote_stream(messages, path, checkpoint, once=True):
            streaming.run_to_end(query, STREAM_TIMEOUT)
    return _as_quotes(streaming.stream_table(spark, path)).drop("batch_id")


def stream_two_sinks(spark, sf_dir):
    decoded = streaming.decode_quotes(fx.message_stream(spark, sf_dir))
    keyed, echo = scratch_path(spark, "stream_table"), scratch_path(spark, "echo")
    both = streaming.all_of(
        streaming.keyed_batch_writer(keyed), streaming.plain_batch_writer(echo)
    )
    _drain(spark, decoded, both)
    back = {new: old for old, new in STREAM_RENAMES.items()}
    stored = streaming.stream_table(spark, keyed).drop("id", "batch_id").withColumnsRenamed(back)
    echoed = streaming.read_batches(spark, echo, decoded.schema).drop("batch_id")
    return _as_quotes(
        stored.withColumn("sink", F.lit("table")).unionByName(
            echoed.withColumn("sink", F.lit("echo"))
        )
    ).select("sink", *QUOTE.fieldNames())


def stream_recreated_checkpoint(spark, sf_dir):
    """A checkpoint is deleted and begun again at its old path: nothing is erased."""
    path, checkpoint = scratch_path(spark, "stream_table"), scratch_path(spark, "checkpoint")
    # Both read one topic: its messages are made once.
    messages = fx.message_stream(spark, sf_dir)
    for _ in range(2):
        for query in streaming.start_quote_stream(messages, path, checkpoint, once=True):
            streaming.run_to_end(query, STREAM_TIMEOUT)
        delete_folder(spark, checkpoint)
    return _as_quotes(streaming.stream_table(spark, path)).drop("batch_id")


def stream_compacted(spark, sf_dir):
    """Several batches, compacted, more batches, compacted again: each message once, ids dense."""
    path, checkpoint, topic = (scratch_path(spark, x) for x in ("stream_table", "checkpoint", "topic"))
    quotes = fx.quotes_of(fx.spread(fx.table(spark, sf_dir, "events")))
    # Landed, so that each message is made once and not for either half.
    messages = land(fx.messages_plain(quotes).withColumn("half", F.pmod(F.xxhash64("value"), F.lit(2))), "messages")
    for half in range(2):
        # A file is a batch: row groups of 16 MB, so that it is decoded by many tasks.
        chosen = messages.where(F.col("half") == half).select("value").repartition(4)
        chosen.write.mode("append").option("parquet.block.size", 16 << 20).parquet(topic)
        source = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(topic)
        for query in streaming.start_quote_stream(source, path, checkpoint, once=True):
            streaming.run_to_end(query, STREAM_TIMEOUT)
        streaming.compact(spark, path)
    stored = streaming.stream_table(spark, path)
    ids = stored.agg((F.count_distinct("id") == F.max("id")).alias("dense")).scalar()
    return _as_quotes(stored).drop("batch_id", "id").withColumn("ids_dense", ids)


def stream_split_once(spark, sf_dir):
    """Quotes and both kinds of malformed messages from one query."""
    path = scratch_path(spark, "routes")
    messages = fx.message_stream(spark, sf_dir, broken=True)
    query = streaming.start_routed_stream(messages, path, scratch_path(spark, "checkpoint"), once=True)
    streaming.run_to_end(query, STREAM_TIMEOUT)
    code = F.regexp_extract("message", r'"code":"([^"]*)"', 1).alias("code")
    found = [streaming.read_route(spark, path).select("code", "basicPrice", F.lit(streaming.QUOTES).alias("route"))]
    for route in (streaming.BAD_JSON, streaming.BAD_FIELD):
        texts = streaming.read_route(spark, path, route)
        found.append(texts.select(code, F.lit(None).cast("double").alias("basicPrice"), F.lit(route).alias("route")))
    return reduce(DataFrame.unionByName, found)


QUERIES: dict[str, Query] = {
    "envelope_explode": envelope_explode,
    "response_status": response_status,
    "symbol_scan": symbol_scan,
    "html_rows": html_rows,
    "table_rows": table_rows,
    "nested_table_rows": nested_table_rows,
    "inner_table_rows": inner_table_rows,
    "company_records": company_records,
    "company_records_inferred": company_records_inferred,
    "csv_roundtrip": csv_roundtrip,
    "directory_scan": directory_scan,
    "directory_scan_new": directory_scan_new,
    "bulk_load_positional": bulk_load_positional,
    "blank_staging": blank_staging,
    "sql_query": sql_query,
    "sql_query_named": sql_query_named,
    "distinct_on_date": distinct_on_date,
    "price_range": price_range,
    "price_page": price_page,
    "price_page_small": price_page_small,
    "price_page_second": price_page_second,
    "first_record": first_record,
    "first_record_latest": first_record_latest,
    "symbol_count": symbol_count,
    "position_slice": position_slice,
    "symbol_shards": symbol_shards,
    "position_slice_listed": position_slice_listed,
    "symbol_shards_listed": symbol_shards_listed,
    "missing_codes": missing_codes,
    "union_by_name": union_by_name,
    "publish_complete": publish_complete,
    "publish_incomplete": publish_incomplete,
    "transform_quotes": transform_quotes,
    "transform_quotes_bare_time": transform_quotes_bare_time,
    "datetime_dim": datetime_dim,
    "datetime_dim_padded": datetime_dim_padded,
    "price_dim": _measure_dim("price_dim"),
    "ohlc_dim": _measure_dim("OHLC_dim"),
    "ad_dim": _measure_dim("ad_dim"),
    "vol_val_dim": _measure_dim("vol_val_dim"),
    "change_dim": _measure_dim("change_dim"),
    "assign_keys": assign_keys,
    "assign_keys_continue": assign_keys_continue,
    "dim_append_new": dim_append_new,
    "fact_table": fact_table,
    "fact_reload_fanout": fact_reload_fanout,
    "star_readback": star_readback,
    "daily_load": daily_load,
    "daily_reload_corrected": daily_reload_corrected,
    "assign_keys_ledger": assign_keys_ledger,
    "response_rejects": response_rejects,
    "daily_load_all_dates": daily_load_all_dates,
    "daily_load_absent_response": daily_load_absent_response,
    "daily_load_bad_date": daily_load_bad_date,
    "pk_violations": pk_violations,
    "date_id_overflow": date_id_overflow,
    "fk_orphans": fk_orphans,
    "fk_orphans_valid": fk_orphans_valid,
    "pk_violations_of_load": pk_violations_of_load,
    "fk_orphans_of_load": fk_orphans_of_load,
    "unmatched_quotes": unmatched_quotes,
    "staging_replace": staging_replace,
    "create_if_absent": create_if_absent,
    "write_many": write_many,
    "copy_table": copy_table,
    "json_encode": json_encode,
    "backfill": backfill,
    "backfill_resumed": backfill_resumed,
    "stream_decode": stream_decode,
    "stream_malformed": stream_malformed,
    "stream_readable": stream_readable,
    "stream_foreachbatch": stream_foreachbatch,
    "stream_restart_new_checkpoint": stream_restart_new_checkpoint,
    "stream_two_sinks": stream_two_sinks,
    "stream_recreated_checkpoint": stream_recreated_checkpoint,
    "stream_compacted": stream_compacted,
    "stream_split_once": stream_split_once,
}
