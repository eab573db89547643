"""Which surrogate keys each load took, so that a load need not read what was loaded before.

A load first *opens* its range for each table: the keys it may use at most. When its rows are
written it *closes* the range with the last key it did use. A load that died in between leaves an
open range: its keys are never given again. The ledger has two rows for each load and table,
whatever the size of the tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.sinks.tables import append_table, create_if_absent

LEDGER = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("load", T.StringType()),
        T.StructField("first_key", T.LongType()),
        T.StructField("last_key", T.LongType()),
        T.StructField("closed", T.BooleanType()),
    ]
)


def new_load() -> str:
    return uuid.uuid4().hex


class KeyLedger:
    """The ledger of the tables of one database. One writer at a time, as for the tables."""

    def __init__(self, spark: SparkSession, table: str) -> None:
        self.spark, self.table = spark, table
        create_if_absent(spark, table, LEDGER)

    def ranges(self) -> DataFrame:
        """(table_name, load, first_key, last_key, closed): one row for each load and table."""
        latest = F.max_by(F.struct("first_key", "last_key", "closed"), "closed").alias("r")
        return self.spark.table(self.table).groupBy("table_name", "load").agg(latest).select(
            "table_name", "load", "r.*"
        )

    def last_keys(self, tables: Mapping[str, tuple[DataFrame, str]]) -> dict[str, int]:
        """The last key given out for each table; ``tables`` maps a name to (table, key column).

        Only a table that the ledger does not know yet, filled before there was one, is read.
        """
        known = {
            r["table_name"]: r["last"]
            for r in self.ranges().groupBy("table_name").agg(F.max("last_key").alias("last")).collect()
        }
        for name, (table, key) in tables.items():
            if name not in known:
                known[name] = table.agg(F.coalesce(F.max(key), F.lit(0)).alias("last")).first()["last"]
        return {name: known[name] for name in tables}

    def _write(self, load: str, ranges: Mapping[str, tuple[int, int]], closed: bool) -> None:
        rows = [(name, load, first, last, closed) for name, (first, last) in ranges.items()]
        append_table(self.spark.createDataFrame(rows, LEDGER).coalesce(1), self.table)

    def open(
        self, load: str, tables: Mapping[str, tuple[DataFrame, str]], n_keys: int | Mapping[str, int]
    ) -> dict[str, int]:
        """Reserve keys for each table; returns the key before the first one.

        A load that is opened again gets the range it had, if that is long enough.
        """
        wanted = {name: n_keys if isinstance(n_keys, int) else n_keys[name] for name in tables}
        mine = {
            r["table_name"]: (r["first_key"], r["last_key"])
            for r in self.ranges().where((F.col("load") == load) & ~F.col("closed")).collect()
        }
        old = {n: r for n, r in mine.items() if n in wanted and r[1] - r[0] + 1 >= wanted[n]}
        last = self.last_keys({n: t for n, t in tables.items() if n not in old})
        fresh = {n: (k + 1, k + wanted[n]) for n, k in last.items()}
        if fresh:
            self._write(load, fresh, closed=False)
        return {n: (old | fresh)[n][0] - 1 for n in tables}

    def close(self, load: str, starts: Mapping[str, int], last: Mapping[str, int | None]) -> None:
        """Say which key was the last that a load used of each table, None if it used none."""
        used = {n: (start + 1, start if last[n] is None else last[n]) for n, start in starts.items()}
        self._write(load, used, closed=True)
