"""Messages to quotes; the same functions serve batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.schemas import QUOTE_MESSAGE

_CORRUPT = "__corrupt"


def decode_quotes(
    messages: DataFrame, schema: T.StructType = QUOTE_MESSAGE, value: str = "value"
) -> DataFrame:
    """One quote per message; unreadable fields, or a whole unreadable message, are NULL."""
    text = F.col(value).cast("string")
    return messages.select(F.from_json(text, schema).alias("records")).select("records.*")


def _parsed(messages: DataFrame, schema: T.StructType, value: str) -> tuple[DataFrame, Column]:
    """``__value``, the fields and what the parser could not read, and whether that makes it malformed."""
    with_corrupt = T.StructType([*schema, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    text = F.col(value).cast("string")
    # inline() parses each message once; a filter on a parsed struct would be
    # pushed below it and parse again for every field it looks at.
    parsed = messages.select(
        text.alias("__value"), F.inline(F.array(F.from_json(text, with_corrupt, options)))
    )
    fields = [F.col(name).cast("string") for name in schema.fieldNames()]
    return parsed, F.col(_CORRUPT).isNotNull() | F.coalesce(*fields).isNull()


def split_malformed(
    messages: DataFrame, schema: T.StructType = QUOTE_MESSAGE, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Quotes of the readable messages, and the text of the others.

    A message is malformed when the parser reports it (broken JSON or a field
    of the wrong type) or when it holds none of the fields.
    """
    parsed, malformed = _parsed(messages, schema, value)
    good = parsed.where(~malformed).select(*schema.fieldNames())
    bad = parsed.where(F.col("__value").isNotNull() & malformed).select(
        F.col("__value").alias("value")
    )
    return good, bad


#: Routes of a message: a quote, text that is no JSON, JSON without fields or with one that cannot be read.
QUOTES, BAD_JSON, BAD_FIELD = "quote", "bad_json", "bad_field"


def route_messages(
    messages: DataFrame, schema: T.StructType = QUOTE_MESSAGE, value: str = "value"
) -> DataFrame:
    """The fields of every message, its text if it is malformed (``message``), and its ``route``.

    Each message is parsed once for all routes; only a malformed one is looked at again. A
    null message has no route and is left out.
    """
    parsed, malformed = _parsed(messages, schema, value)
    text = F.col("__value")
    broken = F.when(F.try_parse_json(text).isNull(), BAD_JSON).otherwise(BAD_FIELD)
    return parsed.where(text.isNotNull()).select(
        *schema.fieldNames(),
        F.when(malformed, text).alias("message"),
        F.when(malformed, broken).otherwise(QUOTES).alias("route"),
    )
