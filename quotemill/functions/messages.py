"""JSON text to and from typed records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def envelope_type(field: str, record: T.StructType) -> T.StructType:
    """Type of ``{"<field>": [record, ...]}``."""
    return T.StructType([T.StructField(field, T.ArrayType(record))])


def envelope_records(payload: Column, field: str, record: T.StructType) -> Column:
    """Array of records inside an envelope; NULL when it cannot be read."""
    return F.from_json(payload, envelope_type(field, record)).getField(field)


def to_message(columns: list[str]) -> Column:
    """One JSON object per row, NULL fields kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
