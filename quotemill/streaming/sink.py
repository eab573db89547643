"""Micro-batch sinks that survive a restart without losing or repeating rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from quotemill.operators.numbering import assign_keys
from quotemill.schemas import STREAM_RENAMES, stream_table_schema
from quotemill.scratch import delete_folder
from quotemill.sinks.remote import jdbc_append
from quotemill.streaming.decode import decode_quotes

BatchFunction = Callable[[DataFrame, int], None]

#: Fixed value.
TRIGGER = "5 seconds"


def query_id(batch: DataFrame) -> str | None:
    """The id of the streaming query that a batch belongs to. Spark draws it at random and keeps it
    in the checkpoint, so a checkpoint that is deleted and begun again at its old path has another."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def _stream_of(batch: DataFrame, stream: str | None) -> str:
    found = stream or query_id(batch)
    if not found:
        raise ValueError("outside a streaming query, say which stream the batch belongs to")
    return found


def batch_folder(path: str, batch_id: int, stream: str) -> str:
    return f"{path}/stream={stream}/batch_id={batch_id}"


_FOLDERS = [T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType())]


def _read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _folders(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema, *_FOLDERS])).parquet(path)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows written so far; ``batch_id`` comes from the folder names."""
    return _folders(spark, path, schema).drop("stream")


# A leading underscore hides the folders from readers of the batches.
_IDS = "stream string, batch_id long, first_id long, last_id long"
_MANIFEST = "version long, compaction long, stream string, last_batch long, last_id long"


def _ids_folder(path: str) -> str:
    return f"{path}/_ids"


def _compacted_folder(path: str) -> str:
    return f"{path}/_compacted"


@dataclass
class Manifest:
    """What of a stream table is compacted: the compactions to read, and for each stream its last batch
    in them and that batch's last id. One row each in a folder of its own for every version."""

    version: int = 0
    live: tuple[int, ...] = ()
    covered: dict[str, tuple[int, int]] = field(default_factory=dict)

    @classmethod
    def of(cls, spark: SparkSession, path: str) -> Manifest:
        """The latest version. A version is one file, so it is there whole or not at all."""
        rows = _read(spark, f"{path}/_manifest", _MANIFEST)
        if rows is None:
            return cls()
        found = rows.where(F.col("version") == rows.agg(F.max("version").alias("v")).scalar()).collect()
        if not found:
            return cls()
        live = sorted(r["compaction"] for r in found if r["compaction"] is not None)
        covered = {r["stream"]: (r["last_batch"], r["last_id"]) for r in found if r["stream"] is not None}
        return cls(found[0]["version"], tuple(live), covered)

    def write(self, spark: SparkSession, path: str) -> None:
        rows = [(c, None, None, None) for c in self.live]
        rows += [(None, stream, *last) for stream, last in self.covered.items()]
        schema = _MANIFEST.removeprefix("version long, ")
        frame = spark.createDataFrame(rows, schema).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{path}/_manifest/version={self.version}")

    def has(self, stream: str, batch_id: int) -> bool:
        return batch_id <= self.covered.get(stream, (-1, 0))[0]

    def is_open(self) -> Column:
        """Whether a batch folder is not compacted: a condition on folder names alone."""
        found = F.lit(True)
        for stream, (last_batch, _) in self.covered.items():
            found = found & ~((F.col("stream") == stream) & (F.col("batch_id") <= last_batch))
        return found


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """The keyed stream table, each row once: the compactions that the manifest names, and the batches
    that they do not cover. Batches of several streams on one target stand side by side."""
    schema, manifest = stream_table_schema(), Manifest.of(spark, path)
    rows = _folders(spark, path, schema).where(manifest.is_open()).drop("stream")
    if not manifest.live:
        return rows
    fields = [*schema, T.StructField("batch_id", T.LongType()), T.StructField("compaction", T.LongType())]
    old = spark.read.schema(T.StructType(fields)).parquet(_compacted_folder(path))
    return old.where(F.col("compaction").isin(list(manifest.live))).select(*rows.columns).unionByName(rows)


def _known_ids(spark: SparkSession, path: str) -> DataFrame:
    """First and last id of every batch that is not compacted away."""
    known = _read(spark, _ids_folder(path), _IDS)
    return spark.createDataFrame([], _IDS) if known is None else known


def _start_id(spark: SparkSession, path: str, manifest: Manifest, stream: str, batch_id: int) -> int:
    """The last id before a batch: its own if it is replayed, else the highest of the target, whose
    last batch may be another stream's. Reads a row for each batch that is not compacted."""
    mine = (F.col("stream") == stream) & (F.col("batch_id") == batch_id)
    first = F.max(F.when(mine, F.col("first_id"))).alias("first_id")
    found = _known_ids(spark, path).agg(first, F.max("last_id").alias("last_id")).first()
    if found["first_id"] is not None:
        return found["first_id"]
    return max([found["last_id"] or 0, *(last for _, last in manifest.covered.values())])


def keyed_batch_writer(
    path: str, order: Sequence[str] = ("date", "code"), stream: str | None = None
) -> BatchFunction:
    """Write each batch to its own folder, with ids that continue over batches.

    A checkpoint counts its batches from 0, so folders carry the stream they belong to: the id of
    the query, or ``stream``, which must be given where no query runs. A new checkpoint on an existing
    target erases nothing and continues the ids of the target. Beside its rows a batch leaves its
    first and last id, so the next one reads one row per batch since ``compact``, and not the table. A replayed batch
    overwrites its folder and gets the same ids; one that is compacted is left as it is. One
    query at a time writes to a target. The batch is landed before it is numbered: its
    messages are decoded once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, mine = batch.sparkSession, _stream_of(batch, stream)
        manifest = Manifest.of(spark, path)
        if manifest.has(mine, batch_id):
            return
        start = _start_id(spark, path, manifest, mine, batch_id)
        rows = batch.withColumnsRenamed(STREAM_RENAMES)
        keyed = assign_keys(rows, "id", order, F.lit(start).cast("bigint"))
        target = batch_folder(path, batch_id, mine)
        keyed.write.mode("overwrite").parquet(target)
        written = spark.read.schema(keyed.schema).parquet(target)
        ids = written.agg(F.coalesce(F.max("id"), F.lit(start)).alias("last_id")).select(
            F.lit(start).cast("long").alias("first_id"), F.col("last_id").cast("long")
        )
        ids.write.mode("overwrite").parquet(f"{_ids_folder(path)}/stream={mine}/batch_id={batch_id}")

    return write


def compact(spark: SparkSession, path: str, keep_open: int = 1) -> int:
    """Rewrite closed batches of a keyed stream table into one folder per trading date; returns
    how many batches were closed.

    The newest ``keep_open`` batches of each stream stay as they are: a query may replay its newest. The new
    version of the manifest is written last and is what readers go by, so a run that dies
    before it leaves only a folder that the next run overwrites. Batches are deleted when the next
    run begins, so a reader may be one compaction old. May run beside the writer; one compaction at a time.
    """
    before = Manifest.of(spark, path)
    for stream, (last_batch, _) in before.covered.items():
        known = _known_ids(spark, path).where((F.col("stream") == stream) & (F.col("batch_id") <= last_batch))
        # One short row for each batch of the compaction before.
        for row in known.select("batch_id").collect():
            delete_folder(spark, batch_folder(path, row["batch_id"], stream))
            delete_folder(spark, f"{_ids_folder(path)}/stream={stream}/batch_id={row['batch_id']}")
    known = _known_ids(spark, path).where(before.is_open())
    newest = known.groupBy("stream").agg(F.max("batch_id").alias("newest"))
    closed = known.join(newest, "stream").where(F.col("batch_id") <= F.col("newest") - keep_open)
    last = closed.groupBy("stream").agg(
        F.max("batch_id").alias("last_batch"), F.max("last_id").alias("last_id"), F.count("*").alias("n")
    )
    found = last.collect()
    if not found:
        return 0
    version = before.version + 1
    covered = before.covered | {r["stream"]: (r["last_batch"], r["last_id"]) for r in found}
    after = Manifest(version, (*before.live, version), covered)
    schema = stream_table_schema()
    rows = _folders(spark, path, schema).where(before.is_open() & ~after.is_open()).drop("stream")
    dated = rows.withColumn("day", F.col("date").cast("date")).hint("rebalance", F.col("day"))
    dated.write.mode("overwrite").partitionBy("day").parquet(f"{_compacted_folder(path)}/compaction={version}")
    after.write(spark, path)
    return sum(r["n"] for r in found)


def jdbc_batch_writer(
    table: str,
    options: Mapping[str, str],
    partitions: int = 8,
    batch_column: str | None = None,
    stream: str | None = None,
    format: str = "jdbc",
) -> BatchFunction:
    """Append each batch to a database table; a replayed batch is appended again.

    With ``batch_column`` each row carries ``<stream>/<batch id>`` there, by which a reader, or a
    unique index of the table, tells a replayed batch from a new one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumnsRenamed(STREAM_RENAMES)
        if batch_column is not None:
            rows = rows.withColumn(batch_column, F.lit(f"{_stream_of(batch, stream)}/{batch_id}"))
        jdbc_append(rows, table, options, partitions, format=format)

    return write


def plain_batch_writer(
    path: str, partition_by: Sequence[str] = (), stream: str | None = None
) -> BatchFunction:
    """Write each batch as it is to its own folder; a replay overwrites it.

    ``stream`` is as for ``keyed_batch_writer``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite").partitionBy(*partition_by)
        writer.parquet(batch_folder(path, batch_id, _stream_of(batch, stream)))

    return write


def all_of(*writers: BatchFunction) -> BatchFunction:
    """Several sinks for one stream: the batch is decoded once and kept for all of them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def _writer(
    stream: DataFrame, checkpoint: str, once: bool, mode: str, name: str | None
) -> DataStreamWriter:
    writer = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGER)


def start_batches(
    stream: DataFrame,
    write: BatchFunction,
    checkpoint: str,
    once: bool = False,
    mode: str = "update",
    name: str | None = None,
) -> StreamingQuery:
    """Run ``write`` on every micro-batch; ``once`` drains what is there and stops."""
    return _writer(stream, checkpoint, once, mode, name).foreachBatch(write).start()


def start_console(
    stream: DataFrame, checkpoint: str, once: bool = False, mode: str = "update"
) -> StreamingQuery:
    """Echo the stream, untruncated."""
    writer = _writer(stream, checkpoint, once, mode, None)
    return writer.format("console").option("truncate", "false").start()


def start_quote_stream(
    messages: DataFrame, path: str, checkpoint: str, echo: bool = False, once: bool = False
) -> list[StreamingQuery]:
    """Messages to the keyed stream table, and to the console with ``echo``.

    Two sinks are two queries, each with its own checkpoint under ``checkpoint``.
    """
    quotes = decode_quotes(messages)
    queries = [start_batches(quotes, keyed_batch_writer(path), f"{checkpoint}/table", once)]
    if echo:
        queries.append(start_console(quotes, f"{checkpoint}/console", once))
    return queries


def run_to_end(query: StreamingQuery, timeout: int) -> None:
    """Wait for a ``once`` query; fail when it does not end in ``timeout`` seconds."""
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream still running after {timeout} s")
