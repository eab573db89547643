"""Catalog tables: create, replace, append, copy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.scratch import land, scratch_path


def replace_table(
    df: DataFrame,
    table: str,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    format: str = "parquet",
) -> DataFrame:
    """Make ``df`` the whole content of ``table``; repeating it changes nothing."""
    writer = df.write.mode("overwrite").format(format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def create_if_absent(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    format: str = "parquet",
) -> DataFrame:
    """Create an empty table; an existing one is left as it is."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    statement = f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {format}"
    if partition_by:
        statement += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})"
    if path is not None:
        escaped = path.replace("\\", "\\\\").replace("'", "\\'")
        statement += f" LOCATION '{escaped}'"
    spark.sql(statement)
    return spark.table(table)


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def append_table(df: DataFrame, table: str) -> DataFrame:
    """Append by column name; ``insertInto`` itself goes by position.

    Rows for a partitioned table are rebalanced first: small partitions share a
    task, a hot one is split over several, and no task writes a file per value.
    """
    spark = df.sparkSession
    rows = df.select(*spark.table(table).columns)
    partitions = _partition_columns(spark, table)
    if partitions:
        rows = rows.hint("rebalance", *(F.col(c) for c in partitions))
    rows.write.insertInto(table)
    return spark.table(table)


def replace_partitions(df: DataFrame, table: str, gone: Sequence[str] = ()) -> DataFrame:
    """Overwrite the partitions that ``df`` has rows for, and drop those that ``gone`` describes,
    each as the condition of one partition; all others stay as they are.

    ``df`` is landed first, so it may be made of ``table`` itself. A repeated call changes nothing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "replacement")
    rows = land(df.select(*spark.table(table).columns), path=path)
    # Overwriting by partition is a setting of a session: the caller's stays as it is.
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    scan = own.read.schema(rows.schema).parquet(path)
    scan = scan.hint("rebalance", *(F.col(c) for c in _partition_columns(spark, table)))
    scan.write.insertInto(table, overwrite=True)
    for condition in gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({condition})")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def bucketed_table(
    df: DataFrame,
    table: str,
    by: Sequence[str],
    buckets: int,
    path: str | None = None,
) -> DataFrame:
    """Replace ``table`` by a bucketed copy, so joins on ``by`` need no shuffle.

    Rows are shuffled to their bucket first: one file per bucket, not one per
    task and bucket.
    """
    writer = (
        df.repartition(buckets, *by)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, *by)
        .sortBy(*by)
    )
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def copy_table(
    source: DataFrame, table: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Append ``source`` to ``table``, its columns renamed by position first."""
    return append_table(source.toDF(*columns) if columns else source, table)


def write_tables(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    format: str = "parquet",
    mode: str = "append",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Write many named frames; a failing one does not stop the others.

    With ``path`` each frame goes to ``<path>/<table>``, otherwise to the table
    option of the connector. Returns (table, ok, error), one row per frame.
    """
    outcome = []
    for table, frame in frames.items():
        writer = frame.write.format(format).mode(mode).options(**(options or {}))
        try:
            if path is None:
                writer.option("table", table).save()
            else:
                writer.save(f"{path}/{table}")
            outcome.append((table, True, None))
        except Exception as error:  # noqa: BLE001 - every failure is reported in the result
            outcome.append((table, False, str(error).splitlines()[0]))
    return spark.createDataFrame(outcome, "table string, ok boolean, error string")
