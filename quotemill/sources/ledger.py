"""A folder that grows: which of its files were loaded, so that a scan reads the new ones only."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.operators.numbering import positions
from quotemill.schemas import QUOTE, SYMBOLS
from quotemill.scratch import land
from quotemill.sources.files import read_csv

_FILES = "path string, length long, modificationTime timestamp"


class FileLedger:
    """The files that were loaded, by path, size and time of change: a file that is written again is new."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def loaded(self) -> DataFrame:
        try:
            return self.spark.read.schema(_FILES).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _FILES)

    def new_files(self, folder: str, pattern: str) -> DataFrame:
        """Files of the folder that are not loaded; only their names, sizes and times are looked at."""
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
        keys = ["path", "length", "modificationTime"]
        return land(listed.select(*keys).join(self.loaded(), keys, "left_anti"), "files")

    def commit(self, files: DataFrame) -> None:
        """Mark files as loaded: call it when their rows are stored. Until then they stay new."""
        files.coalesce(1).write.mode("append").parquet(self.path)


def read_new_shard_files(
    spark: SparkSession,
    folder: str,
    ledger: FileLedger,
    pattern: str = "stock_price_*.csv",
    schema: T.StructType = QUOTE,
) -> tuple[DataFrame, DataFrame]:
    """Rows of the shard files that were not loaded, and these files for ``FileLedger.commit``.

    One path for each new file comes to the driver.
    """
    files = ledger.new_files(folder, pattern)
    paths = [r["path"] for r in files.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], schema), files
    return read_csv(spark, paths, schema), files


def read_symbols_listed(spark: SparkSession, path: str, schema: T.StructType = SYMBOLS) -> DataFrame:
    """(Stock_Code, position): the symbol list in the order in which it stands in its files.

    Files go by name; in a file the place is that of the block and then of the row in its block, so
    neither is read as a whole by one task.
    """
    rows = read_csv(spark, path, schema).select(
        "Stock_Code",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__row"),
    )
    placed = positions(land(rows, "listed"), ["__file", "__block", "__row"], land_input=False)
    return placed.select("Stock_Code", "position")
