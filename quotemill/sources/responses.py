"""Price and company responses: JSON envelopes in a payload column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.functions.messages import envelope_records
from quotemill.schemas import QUOTE


def envelope_explode(
    responses: DataFrame,
    payload: str = "payload",
    field: str = "data",
    record: T.StructType = QUOTE,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per record of every response, however many records it holds."""
    records = envelope_records(F.col(payload), field, record)
    return responses.select(*keep, F.inline(records))


def response_records(
    responses: DataFrame,
    from_date: str,
    to_date: str,
    code: str = "code",
    payload: str = "payload",
    field: str = "data",
    symbol: str = "symbol",
) -> DataFrame:
    """(symbol, reason, and the fields of a quote): the records of the closed range of dates.

    Each payload is parsed once, where it lies. A record whose date cannot be read is one row with the
    reason ``undated``. A response of which nothing can be read is one row without a quote, reason
    ``unreadable``; one without a record in range is one row without a quote and reason.
    """
    day = lambda r: r["date"]
    first, last = F.lit(from_date).cast("date"), F.lit(to_date).cast("date")
    wanted = lambda r: day(r).isNull() | ((day(r) >= first) & (day(r) <= last))
    # inline() keeps the parser in one place; a projection would be repeated for every field.
    parsed = responses.select(
        F.col(code).alias(symbol),
        F.inline(F.array(F.struct(envelope_records(F.col(payload), field, QUOTE).alias("__records")))),
    )
    rows = parsed.select(
        symbol,
        F.col("__records").isNull().alias("__failed"),
        F.explode_outer(F.filter("__records", wanted)).alias("__quote"),
    )
    reason = F.when(F.col("__failed"), "unreadable").when(
        F.col("__quote").isNotNull() & F.col("__quote.date").isNull(), "undated"
    )
    return rows.select(symbol, reason.alias("reason"), "__quote.*")


def response_status(
    responses: DataFrame, payload: str = "payload", field: str = "data"
) -> DataFrame:
    """Add ``n_records`` and ``status``: failed, empty, single or multi.

    Only counts the array; the records are not converted. NULL means that
    nothing readable came back.
    """
    n_records = F.json_array_length(F.get_json_object(payload, f"$.{field}"))
    status = (
        F.when(F.col("n_records").isNull(), "failed")
        .when(F.col("n_records") == 0, "empty")
        .when(F.col("n_records") == 1, "single")
        .otherwise("multi")
    )
    return responses.withColumn("n_records", n_records).withColumn("status", status)


def company_records(
    responses: DataFrame,
    schema: T.StructType | None = None,
    payload: str = "payload",
    field: str = "Data",
) -> DataFrame:
    """Companies of ``{"Data": [...]}``; without a schema it is inferred.

    Inference is one distributed aggregate over all payloads that returns a
    single type string.
    """
    if schema is None:
        found = responses.agg(
            F.schema_of_variant_agg(F.try_parse_json(payload)).alias("found")
        ).first()["found"]
        envelope = T.DataType.fromDDL(found.replace("OBJECT<", "STRUCT<"))
        schema = envelope[field].dataType.elementType
    return envelope_explode(responses, payload, field, schema)
