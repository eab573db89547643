"""Replay of a symbol list's history as messages."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quotemill.operators.selection import price_range
from quotemill.sinks.remote import encode_messages, publish_messages

# The span the full replay covers.
HISTORY_FROM = "2000-01-01"
HISTORY_TO = "2023-07-26"


def backfill_messages(
    quotes: DataFrame,
    codes: DataFrame | None = None,
    from_date: str = HISTORY_FROM,
    to_date: str = HISTORY_TO,
) -> DataFrame:
    """One message per quote of the symbols and the date range, keyed by symbol."""
    return encode_messages(price_range(quotes, from_date, to_date, codes), key="code")


def backfill(
    quotes: DataFrame,
    codes: DataFrame | None,
    servers: str,
    topic: str,
    from_date: str = HISTORY_FROM,
    to_date: str = HISTORY_TO,
    options: Mapping[str, str] | None = None,
    format: str = "kafka",
) -> None:
    """Publish the replay in one distributed write."""
    wanted = price_range(quotes, from_date, to_date, codes)
    publish_messages(wanted, servers, topic, "code", options, format)


_CHUNKS = "chunk int, part int, from_date date, to_date date"


def replay_chunks(
    spark: SparkSession, from_date: str, to_date: str, parts: int = 1, days: int = 366
) -> list[Row]:
    """The replay cut into spans of ``days`` and, in each, ``parts`` of the symbols: one row for each chunk."""
    span = F.sequence(F.lit(from_date).cast("date"), F.lit(to_date).cast("date"), F.expr(f"interval {days} days"))
    chunks = spark.range(1).select(F.posexplode(span).alias("nth", "from_date"))
    last = F.least(F.date_add("from_date", days - 1), F.lit(to_date).cast("date"))
    chunks = chunks.select("nth", "from_date", last.alias("to_date"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    number = (F.col("nth") * parts + F.col("part")).cast("int").alias("chunk")
    return chunks.select(number, "part", "from_date", "to_date").orderBy("chunk").collect()


def resumable_backfill(
    quotes: DataFrame,
    codes: DataFrame | None,
    ledger: str,
    publish: Callable[[DataFrame], None],
    from_date: str = HISTORY_FROM,
    to_date: str = HISTORY_TO,
    parts: int = 1,
    days: int = 366,
) -> int:
    """Publish the replay chunk by chunk and note each in ``ledger``; returns how many were published.

    Called again after it died, with the same span and cut, it goes on with the first chunk that is
    not noted, and sends none again that is. Of the chunk it died in some messages may be sent twice, as
    they carry their key. ``publish`` takes the quotes of a chunk, whose dates are a range that
    the scan of ``quotes`` can be pruned by.
    """
    spark = quotes.sparkSession
    try:
        done = {r["chunk"]: r for r in spark.read.schema(_CHUNKS).parquet(ledger).collect()}
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        done = {}
    chunks = replay_chunks(spark, from_date, to_date, parts, days)
    if any(r != chunks[c] if c < len(chunks) else True for c, r in done.items()):
        raise ValueError("the ledger is of another span or cut")
    for chunk in chunks:
        if chunk["chunk"] in done:
            continue
        wanted = price_range(quotes, str(chunk["from_date"]), str(chunk["to_date"]), codes)
        publish(wanted.where(F.pmod(F.xxhash64("code"), F.lit(parts)) == chunk["part"]))
        spark.createDataFrame([chunk], _CHUNKS).coalesce(1).write.mode("append").parquet(ledger)
    return len(chunks) - len(done)
