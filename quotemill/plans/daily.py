"""The daily load: responses to staging, dimensions and fact table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.functions.keys import date_key
from quotemill.operators.ledger import KeyLedger, new_load
from quotemill.operators.loading import BUSINESS_KEY, rows_not_in
from quotemill.operators.numbering import positions
from quotemill.operators.publish import publish_if_complete
from quotemill.operators.selection import first_record
from quotemill.operators.symbols import symbol_positions, symbol_shards
from quotemill.plans.staging import blank_staging, transform_quotes
from quotemill.plans.star import (
    datetime_dim, fact_table, keyed_measures, measure_rows, number_staging,
)
from quotemill.schemas import FACT, FOREIGN_KEYS, MEASURE_DIMS, QUOTE, star_schemas
from quotemill.scratch import land
from quotemill.sinks.tables import (
    append_table, create_if_absent, replace_partitions, replace_table,
)
from quotemill.sources.responses import response_records

DATE_KEY = ("stock_date", "date_update", "time_update")
FACT_KEY = ("code", "dateKey", "priceKey")


def read_day(
    responses: DataFrame,
    symbols: DataFrame,
    from_date: str,
    to_date: str,
    shards: int = 3,
    first_by: Sequence[str] = ("code",),
) -> tuple[DataFrame, DataFrame]:
    """Quotes of a load, and why there are none: (symbol, reason) of each requested symbol in the way.

    ``responses`` holds (code, payload) and ``symbols`` (Stock_Code). Quotes are the first record per group
    of the responses in range, if every shard is complete. A symbol without a response (``absent``),
    a response that cannot be read (``unreadable``), a record without a readable date (``undated``) or
    an empty shard leaves no quotes at all. Payloads are scanned once, and
    never shuffled: what is landed are their records. Whether any was bad is observed on the way.
    """
    seen = Observation()
    records = response_records(responses, from_date, to_date)
    records = land(records.observe(seen, F.count("reason").alias("n_bad")), "records")
    placed = land(
        symbol_shards(symbol_positions(symbols), shards).select(F.col("Stock_Code").alias("symbol"), "shard"),
        "shards",
    )
    answered = records.select("symbol").distinct()
    in_the_way = placed.join(answered, "symbol", "left_anti").withColumn("reason", F.lit("absent"))
    # Nothing is observed where the plan of the records turned out to have no rows.
    if not records.isEmpty() and seen.get["n_bad"]:
        bad = records.where("reason is not null").select("symbol", "reason").distinct()
        in_the_way = in_the_way.unionByName(bad.join(placed, "symbol"))
    in_the_way = land(in_the_way, "rejects")
    dated = records.where("date is not null").join(placed, "symbol").select(*QUOTE.fieldNames(), "shard")
    # The gate and its scalars read these rows several times: land them once.
    chosen = land(first_record(dated, first_by), "quotes")
    quotes = publish_if_complete(chosen, range(shards), failures=in_the_way).drop("shard")
    return quotes, in_the_way.select("symbol", "reason").distinct()


def day_quotes(
    responses: DataFrame,
    symbols: DataFrame,
    from_date: str,
    to_date: str,
    shards: int = 3,
    first_by: Sequence[str] = ("code",),
) -> DataFrame:
    """The quotes of ``read_day``."""
    return read_day(responses, symbols, from_date, to_date, shards, first_by)[0]


def load_staging(
    spark: SparkSession, quotes: DataFrame, run_date: str | None = None, database: str = "default"
) -> DataFrame:
    """Replace staging by the transformed quotes."""
    rows = blank_staging(spark).unionByName(transform_quotes(quotes, run_date))
    return replace_table(rows, f"{database}.full_data")


def _in_parallel(spark: SparkSession, jobs: Sequence[Callable[[], object]]) -> None:
    # A few Spark jobs that do not depend on each other, submitted together.
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        carried = inheritable_thread_target(spark)
        for done in [pool.submit(carried(job)) for job in jobs]:
            done.result()


def star_tables(spark: SparkSession, database: str = "default") -> dict[str, DataFrame]:
    """The seven tables of the star, created where absent, all partitioned by trading date.

    The stored fact table carries the trading date as one more column; ``fact_rows`` leaves it out.
    """
    tables = {}
    for name, schema in star_schemas().items():
        if name == "full_data":
            continue
        if "stock_date" not in schema.fieldNames():
            schema = T.StructType([*schema, T.StructField("stock_date", T.DateType())])
        tables[name] = create_if_absent(spark, f"{database}.{name}", schema, partition_by=["stock_date"])
    return tables


def fact_rows(spark: SparkSession, database: str = "default") -> DataFrame:
    return spark.table(f"{database}.fact_table").select(*FACT.fieldNames())


def in_dates(table: DataFrame, dates: tuple[str, str] | None) -> DataFrame:
    """Rows of the closed range of trading dates, and those without a date, which any load may hold."""
    if dates is None:
        return table
    day = F.col("stock_date")
    first, last = (F.lit(bound).cast("date") for bound in dates)
    return table.where(day.isNull() | ((day >= first) & (day <= last)))


def key_ledger(spark: SparkSession, database: str = "default") -> KeyLedger:
    return KeyLedger(spark, f"{database}.key_ledger")


def _last_used(
    spark: SparkSession, database: str, dates: tuple[str, str] | None, starts: Mapping[str, int]
) -> dict[str, int | None]:
    """The last key after ``starts`` in each table, None if there is none. Only partitions of the
    load's dates are opened, and in them only row groups with a key after the start."""
    found = []
    for table, start in starts.items():
        key = F.col(MEASURE_DIMS[table][0])
        mine = in_dates(spark.table(f"{database}.{table}"), dates).where(key > start)
        found.append(mine.agg(F.lit(table).alias("table_name"), F.max(key).alias("last")))
    return {r["table_name"]: r["last"] for r in reduce(DataFrame.unionByName, found).collect()}


def load_star(
    spark: SparkSession,
    staging: DataFrame,
    database: str = "default",
    dedupe: bool = True,
    padded: bool = False,
    dates: tuple[str, str] | None = None,
) -> DataFrame:
    """Append one load to the six dimensions and the fact table; returns the fact table.

    The rows are numbered once for all measure dimensions, after the last key in the ledger.
    With ``dedupe`` rows already loaded are skipped, so a repeated load changes nothing; the numbers
    of rows skipped before the last new one stay unused. ``dates`` is the closed range of
    trading dates in ``staging``: all tables are partitioned by trading date, so what was loaded
    for other dates is not read.
    ``staging`` must be a table scan. One writer per table: plain Parquet tables
    have no transactions.
    """
    tables = star_tables(spark, database)
    ledger, this_load = key_ledger(spark, database), new_load()
    numbered = number_staging(staging, land_input=False)
    keys = {table: (tables[table], key) for table, (key, _) in MEASURE_DIMS.items()}
    starts = ledger.open(this_load, keys, numbered.count())

    def load(table: str, rows: DataFrame, business_key: Sequence[str]) -> Callable[[], None]:
        def job() -> None:
            fresh = rows_not_in(rows, in_dates(tables[table], dates), business_key) if dedupe else rows
            append_table(fresh, f"{database}.{table}")

        return job

    jobs = [load("datetime_dim", datetime_dim(numbered, padded), DATE_KEY)]
    jobs += [load(t, keyed_measures(numbered, t, starts[t]), BUSINESS_KEY) for t in MEASURE_DIMS]
    _in_parallel(spark, jobs)
    ledger.close(this_load, starts, _last_used(spark, database, dates, starts))

    dims = {n: in_dates(spark.table(f"{database}.{n}"), dates) for n in tables if n != "fact_table"}
    facts = fact_table(staging, dims, keep=["stock_date"])
    if dedupe:
        facts = rows_not_in(facts, in_dates(tables["fact_table"], dates), FACT_KEY)
    append_table(facts, f"{database}.fact_table")
    return fact_rows(spark, database)


def replace_star(
    spark: SparkSession,
    staging: DataFrame,
    dates: tuple[str, str],
    database: str = "default",
    padded: bool = False,
) -> DataFrame:
    """Make one load all that the star holds of its dates; returns the fact table.

    A quote that was loaded before, by symbol and trading date, keeps its keys, whatever was
    corrected in it; new quotes get keys after the last; quotes that the load no longer
    holds are gone, with their facts. Partitions of other dates are neither read nor
    written. ``staging`` must be a table scan with one quote for each symbol and date of the
    range, as ``run_daily`` makes it; anything else raises ValueError before a table is changed.

    Each table is overwritten by itself. A load that died half-way is mended by running it
    again: keys come from the dimensions, and the fact table is written last.
    """
    tables = star_tables(spark, database)
    first, last = (F.lit(bound).cast("date") for bound in dates)
    inside = F.coalesce(F.col("stock_date").between(first, last), F.lit(False))
    if not staging.where(~inside).isEmpty():
        raise ValueError(f"quotes with a trading date outside {dates[0]} to {dates[1]}, or none")
    if not staging.groupBy(*BUSINESS_KEY).count().where("count > 1").isEmpty():
        raise ValueError("more than one quote for a symbol and a date")

    def here(table: str) -> DataFrame:
        return tables[table].where(F.col("stock_date").between(first, last))

    # One key for all joins: NULL codes are equal, and rows are shuffled for it once.
    same = F.struct(*BUSINESS_KEY)
    matched = staging.withColumn("__same", same)
    for table, (key, _) in MEASURE_DIMS.items():
        old = here(table).groupBy(same.alias("__same")).agg(F.min(key).alias(key))
        matched = matched.join(old, "__same", "left")
    names = {table: key for table, (key, _) in MEASURE_DIMS.items()}
    matched = land(matched.drop("__same"), "matched")
    known = F.lit(True)
    for key in names.values():
        known = known & F.col(key).isNotNull()
    fresh = positions(matched.where(~known), ("stock_date", "code"), "__nth", land_input=False)
    ledger, this_load = key_ledger(spark, database), new_load()
    n_fresh = fresh.count()
    starts = ledger.open(this_load, {t: (tables[t], k) for t, k in names.items()}, n_fresh)
    fresh = fresh.withColumns(
        {k: F.coalesce(k, F.lit(starts[t]) + F.col("__nth") + 1).cast("bigint") for t, k in names.items()}
    )
    keyed = land(matched.where(known).unionByName(fresh.drop("__nth")), "keyed")

    days = keyed.select("stock_date").distinct()
    held = [here(t).select("stock_date").distinct() for t in tables]
    stale = reduce(DataFrame.unionByName, held).distinct().join(days, "stock_date", "left_anti")
    # At most one row for each date of the range.
    gone = [f"stock_date = DATE'{r['stock_date']}'" for r in stale.collect()]

    jobs = [lambda: replace_partitions(datetime_dim(keyed, padded), f"{database}.datetime_dim", gone)]
    for table, key in names.items():
        rows = measure_rows(keyed, table, key)
        jobs.append(lambda rows=rows, table=table: replace_partitions(rows, f"{database}.{table}", gone))
    _in_parallel(spark, jobs)
    ledger.close(this_load, starts, {t: s + n_fresh for t, s in starts.items()})

    # Every quote has its own keys, so the facts need no join. What a join would not match has none.
    complete = F.col("code").isNotNull() & F.col("time_update").isNotNull()
    foreign = {column: key for column, (_, key) in FOREIGN_KEYS.items() if key in names.values()}
    facts = keyed.where(complete).select(
        "code", date_key(padded).alias("dateKey"), "floor", "typeStock",
        *(F.col(key).alias(column) for column, key in foreign.items()), "stock_date",
    )
    replace_partitions(facts, f"{database}.fact_table", gone)
    return fact_rows(spark, database)


def run_daily(
    spark: SparkSession,
    responses: DataFrame,
    symbols: DataFrame,
    from_date: str,
    to_date: str,
    run_date: str | None = None,
    database: str = "default",
    dedupe: bool = True,
    padded: bool = False,
    first_by: Sequence[str] | None = None,
    replace: bool = False,
) -> DataFrame:
    """Responses of one load to the fact table, end to end.

    The load adds what is new; with ``replace`` it becomes all that the star holds of its dates, as
    ``replace_star`` says, unless it was voided.
    A load of one date keeps one record per symbol. For a longer range the caller says
    what to keep: ``("code",)`` one record per symbol, ``("code", "date")`` one per symbol and date.
    The table ``load_rejects`` then tells which symbols voided the load, and why; it is empty if none did.
    """
    if first_by is None:
        if from_date != to_date:
            raise ValueError("say with first_by which records of a range of dates are kept")
        first_by = ("code",)
    quotes, rejects = read_day(responses, symbols, from_date, to_date, first_by=first_by)
    replace_table(rejects, f"{database}.load_rejects")
    staging = load_staging(spark, quotes, run_date, database)
    if replace:
        if staging.isEmpty():
            star_tables(spark, database)
            return fact_rows(spark, database)
        return replace_star(spark, staging, (from_date, to_date), database, padded)
    return load_star(spark, staging, database, dedupe, padded, (from_date, to_date))
