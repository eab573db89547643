"""Which keys each partition of a table holds, so that a load is checked without reading the tables.

A summary row holds the keys of one partition that lie in one block of 32,768 numbers, as a bitmap.
Keys given out in sequence take about one bit each, and what a load may conflict with is found in
the blocks of its own keys.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.schemas import FOREIGN_KEYS
from quotemill.sinks.tables import create_if_absent, replace_partitions

SUMMARY = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("keys", T.BinaryType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("part", T.DateType()),
    ]
)


def key_blocks(rows: DataFrame, key: str, part: str = "stock_date") -> DataFrame:
    """(part, block, n_rows, keys) of ``rows``; NULL keys are counted in the block NULL.

    Bitmaps are built before the shuffle, so a key that many rows use costs one bit there.
    """
    number = F.col(key).cast("bigint")
    return rows.groupBy(F.col(part).alias("part"), F.bitmap_bucket_number(number).alias("block")).agg(
        F.count("*").alias("n_rows"),
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("keys"),
    )


def _holds(keys: Column, number: Column) -> Column:
    at = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring(keys, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), (at % 8).cast("int")) == 1


class KeySummaries:
    """The summaries of the tables of one database, partitioned by table and by the table's partition.

    One writer at a time, as for the tables.
    """

    def __init__(self, spark: SparkSession, table: str) -> None:
        self.spark, self.table = spark, table
        create_if_absent(spark, table, SUMMARY, partition_by=["table_name", "part"])

    def of(self, name: str) -> DataFrame:
        return self.spark.table(self.table).where(F.col("table_name") == name).drop("table_name")

    def refresh(
        self,
        name: str,
        rows: DataFrame,
        key: str,
        dates: tuple[str, str] | None = None,
        part: str = "stock_date",
    ) -> None:
        """Summarise ``rows``, all that the table holds of the closed range of dates, or all it holds.

        Partitions of the range that hold nothing any more lose their summary; others keep it.
        A partition without a date belongs to every range.
        """
        blocks = key_blocks(rows, key, part).withColumn("table_name", F.lit(name))
        held = self.of(name).select("part").distinct()
        if dates is not None:
            first, last = (F.lit(bound).cast("date") for bound in dates)
            held = held.where(F.col("part").isNull() | F.col("part").between(first, last))
        now = rows.select(F.col(part).alias("part")).distinct()
        # At most one row for each date of the range.
        stale = held.join(now, held["part"].eqNullSafe(now["part"]), "left_anti").collect()
        same_table = "table_name = '" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"
        gone = [
            f"{same_table}, part = " + ("NULL" if r["part"] is None else f"DATE'{r['part']}'") for r in stale
        ]
        replace_partitions(blocks, self.table, gone)

    def holders(self, name: str, keys: DataFrame, key: str) -> DataFrame:
        """(key, part): in which partitions of the table each of the distinct ``keys`` stands."""
        wanted = keys.select(F.col(key).cast("bigint").alias(key))
        blocks = self.of(name).where(F.col("block").isNotNull())
        # The bit is tested inside the join, so no bitmap is copied to a row of the result.
        same = (F.bitmap_bucket_number(key) == F.col("block")) & _holds(F.col("keys"), F.col(key))
        return wanted.join(blocks, same).select(key, "part")


def pk_violations_of_load(
    loaded: DataFrame,
    table: DataFrame,
    name: str,
    key: str,
    summaries: KeySummaries,
    part: str = "stock_date",
) -> DataFrame:
    """Keys of a load, not yet in ``table``, that would break its primary key: (key, n_rows).

    As ``pk_violations`` of both together, for the keys of the load: NULL, or used more than once. Of
    the table only those partitions are read that hold a key of the load, by the summaries; how many
    rows have no key the summaries know.
    """
    number = F.col(key).cast("bigint")
    new = loaded.groupBy(number.alias(key)).agg(F.count("*").alias("n_rows"))
    held = summaries.holders(name, new.where(F.col(key).isNotNull()), key)
    # One row for each partition that has such a key.
    parts = [r["part"] for r in held.select("part").distinct().collect()]
    inside = F.col(part).isin([p for p in parts if p is not None])
    if None in parts:
        inside = inside | F.col(part).isNull()
    stored = table.where(inside).select(number.alias(key))
    stored = stored.join(held.select(key).distinct(), key, "left_semi")
    old = stored.groupBy(key).agg(F.count("*").alias("n_rows"))
    keyless = new.where(F.col(key).isNull()).select(key).join(
        summaries.of(name).where(F.col("block").isNull()).select("n_rows")
    )
    together = new.unionByName(old).unionByName(keyless).groupBy(key).agg(F.sum("n_rows").alias("n_rows"))
    return together.where((F.col("n_rows") > 1) | F.col(key).isNull())


def fk_orphans_of_load(facts: DataFrame, summaries: KeySummaries) -> DataFrame:
    """As ``fk_orphans`` for the facts of a load: (fact_column, key, n_rows); NULL passes.

    No dimension is read: their summaries say which keys they hold. Keys are counted before
    the join, so a key used by many facts is one row there.
    """
    used = (
        facts.select(*(F.col(column).cast("bigint").alias(column) for column in FOREIGN_KEYS))
        .unpivot([], list(FOREIGN_KEYS), "fact_column", "key")
        .where(F.col("key").isNotNull())
        .groupBy("fact_column", "key")
        .agg(F.count("*").alias("n_rows"))
    )
    blocks = reduce(
        DataFrame.unionByName,
        [
            summaries.of(table).where(F.col("block").isNotNull()).select(
                F.lit(column).alias("__column"), "block", "keys"
            )
            for column, (table, _) in FOREIGN_KEYS.items()
        ],
    )
    same = (
        (F.col("fact_column") == F.col("__column"))
        & (F.bitmap_bucket_number("key") == F.col("block"))
        & _holds(F.col("keys"), F.col("key"))
    )
    return used.join(blocks, same, "left_anti")


def refresh_dimensions(
    summaries: KeySummaries, dims: Mapping[str, DataFrame], dates: tuple[str, str] | None = None
) -> None:
    """Summarise all dimensions that facts refer to, each with the rows it holds of the dates."""
    for table, key in FOREIGN_KEYS.values():
        summaries.refresh(table, dims[table], key, dates)
