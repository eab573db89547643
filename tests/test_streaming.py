import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quotemill import sinks, streaming
from quotemill.schemas import QUOTE_MESSAGE, stream_table_schema
from quotemill.scratch import delete_folder, land, scratch_path
from quotemill.streaming import sink
from workload import fixtures, queries

TIMEOUT = 120


def message(code, price=1.0, date="2024-01-02", **more):
    return json.dumps({"code": code, "date": date, "basicPrice": price, "change": 0.5, **more})


def batch(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def put(spark, path, texts):
    batch(spark, texts).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(path)


def test_decode_keeps_malformed_as_nulls(spark):
    texts = [message("A"), "garbage", message("B", "x"), None]
    got = streaming.decode_quotes(batch(spark, texts))
    assert got.schema == QUOTE_MESSAGE
    rows = [(r.code, r.date, r.basicPrice) for r in got.collect()]
    day = dt.datetime(2024, 1, 2)
    assert sorted(rows, key=repr) == sorted(
        [("A", day, 1.0), (None, None, None), ("B", day, None), (None, None, None)], key=repr
    )


def test_binary_values(spark):
    binary = batch(spark, [message("A")]).select(F.encode("value", "UTF-8").alias("value"))
    assert streaming.decode_quotes(binary).first().code == "A"


def test_split_malformed(spark):
    texts = [message("A"), "garbage", message("B", "x"), "{}", '{"code":"C"', None]
    good, bad = streaming.split_malformed(batch(spark, texts))
    assert [r.code for r in good.collect()] == ["A"]
    assert sorted(r.value for r in bad.collect()) == sorted(texts[1:5])


def test_split_parses_once(spark):
    good, bad = streaming.split_malformed(batch(spark, [message("A")]))
    for frame in (good, bad):
        text = frame._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("from_json") <= 2  # the generator and its own not-null filter


def test_encode_decode(spark, quotes):
    encoded = sinks.encode_messages(quotes, key="code")
    assert encoded.columns == ["key", "value"]
    decoded = streaming.decode_quotes(encoded).withColumn("date", F.col("date").cast("date"))
    assert decoded.exceptAll(quotes).isEmpty() and quotes.exceptAll(decoded).isEmpty()


def test_ids_continue_and_replay_changes_nothing(spark):
    source, target = scratch_path(spark, "in"), scratch_path(spark, "out")
    put(spark, source, [message("B"), message("A")])
    put(spark, source, [message("D"), message("C"), message("C")])
    decoded = streaming.decode_quotes(stream(spark, source))
    write = streaming.keyed_batch_writer(target, stream="s")
    query = streaming.start_batches(decoded, write, scratch_path(spark, "checkpoint"), once=True)
    streaming.run_to_end(query, TIMEOUT)
    stored = streaming.stream_table(spark, target)
    assert stored.drop("batch_id").columns == stream_table_schema().fieldNames()
    assert "changeCol" in stored.columns and "change" not in stored.columns
    before = sorted((r.batch_id, r.id, r.code) for r in stored.collect())
    assert [b[1] for b in before] == [1, 2, 3, 4, 5]

    for batch_id in (0, 1):
        codes = [b[2] for b in before if b[0] == batch_id]
        write(streaming.decode_quotes(batch(spark, [message(c) for c in codes])), batch_id)
    after = streaming.stream_table(spark, target)
    assert sorted((r.batch_id, r.id, r.code) for r in after.collect()) == before


def test_restart_reads_only_new_messages(spark):
    source, target = scratch_path(spark, "in"), scratch_path(spark, "out")
    checkpoint = scratch_path(spark, "checkpoint")
    for texts in ([message("A")], [message("B"), message("C")]):
        put(spark, source, texts)
        decoded = streaming.decode_quotes(stream(spark, source))
        query = streaming.start_batches(
            decoded, streaming.plain_batch_writer(target), checkpoint, once=True, mode="append"
        )
        streaming.run_to_end(query, TIMEOUT)
    got = streaming.read_batches(spark, target, QUOTE_MESSAGE)
    assert sorted((r.batch_id, r.code) for r in got.collect()) == [(0, "A"), (1, "B"), (1, "C")]


def test_two_queries_on_one_stream(spark):
    source, target = scratch_path(spark, "in"), scratch_path(spark, "out")
    put(spark, source, [message("A")])
    queries = streaming.start_quote_stream(
        stream(spark, source), target, scratch_path(spark, "checkpoint"), echo=True, once=True
    )
    assert len(queries) == 2
    for query in queries:
        streaming.run_to_end(query, TIMEOUT)
    assert streaming.stream_table(spark, target).count() == 1


def test_empty_batch_keeps_the_last_id(spark):
    target = scratch_path(spark, "out")
    write = streaming.keyed_batch_writer(target, stream="s")
    for batch_id, codes in enumerate((["A", "B"], [], ["C"])):
        write(streaming.decode_quotes(batch(spark, [message(c) for c in codes])), batch_id)
    got = streaming.stream_table(spark, target).collect()
    assert sorted((r.id, r.code) for r in got) == [(1, "A"), (2, "B"), (3, "C")]


def test_jdbc_sink_needs_its_driver(spark):
    write = streaming.jdbc_batch_writer("t", {"url": "jdbc:unknown://h/d", "driver": "no.such.Driver"})
    with pytest.raises(Exception, match="no.such.Driver"):
        write(streaming.decode_quotes(batch(spark, [message("A")])), 0)


def test_all_of_writes_every_sink(spark):
    one, two = scratch_path(spark, "one"), scratch_path(spark, "two")
    write = streaming.all_of(*(streaming.plain_batch_writer(path, stream="s") for path in (one, two)))
    write(streaming.decode_quotes(batch(spark, [message("A")])), 0)
    for path in (one, two):
        assert streaming.read_batches(spark, path, QUOTE_MESSAGE).count() == 1


def test_default_trigger_runs_until_stopped(spark):
    source, target = scratch_path(spark, "in"), scratch_path(spark, "out")
    put(spark, source, [message("A")])
    decoded = streaming.decode_quotes(stream(spark, source))
    query = streaming.start_batches(
        decoded, streaming.plain_batch_writer(target), scratch_path(spark, "checkpoint")
    )
    query.processAllAvailable()
    with pytest.raises(TimeoutError):
        streaming.run_to_end(query, 1)
    assert streaming.read_batches(spark, target, QUOTE_MESSAGE).count() == 1


def test_backfill(spark, quotes):
    codes = spark.createDataFrame([("U00001",), ("U00002",)], "Stock_Code string")
    assert streaming.backfill_messages(quotes, codes).isEmpty()  # the default span ends in 2023
    messages = streaming.backfill_messages(quotes, codes, "2024-01-01", "2024-01-31")
    want = quotes.where(F.col("code").isin("U00001", "U00002")).count()
    assert messages.count() == want
    assert {r.key for r in messages.collect()} == {"U00001", "U00002"}
    streaming.backfill(quotes, codes, "host:9092", "quotes", format="noop")


def run_once(spark, source, target, checkpoint):
    messages = stream(spark, source)
    for query in streaming.start_quote_stream(messages, target, checkpoint, once=True):
        streaming.run_to_end(query, TIMEOUT)


def ids(spark, target):
    return sorted((r.id, r.code) for r in streaming.stream_table(spark, target).collect())


def test_a_batch_needs_to_know_its_stream(spark):
    rows = streaming.decode_quotes(batch(spark, [message("A")]))
    for write in (streaming.keyed_batch_writer, streaming.plain_batch_writer):
        with pytest.raises(ValueError, match="which stream"):
            write(scratch_path(spark, "out"))(rows, 0)


def test_recreated_checkpoint_erases_nothing(spark):
    source, target, checkpoint = (scratch_path(spark, x) for x in ("in", "out", "checkpoint"))
    put(spark, source, [message("A"), message("B")])
    for _ in range(2):
        run_once(spark, source, target, checkpoint)
        delete_folder(spark, checkpoint)
    assert ids(spark, target) == [(1, "A"), (2, "B"), (3, "A"), (4, "B")]


def write_batches(spark, target, first, codes, stream="s"):
    write = streaming.keyed_batch_writer(target, stream=stream)
    for batch_id, code in enumerate(codes, first):
        write(streaming.decode_quotes(batch(spark, [message(code)])), batch_id)


def test_compaction_keeps_every_row_once(spark):
    target = scratch_path(spark, "out")
    write_batches(spark, target, 0, "ABCD")
    before = ids(spark, target)
    assert streaming.compact(spark, target) == 3
    assert ids(spark, target) == before  # the folders of the batches are still there, but not read
    write_batches(spark, target, 1, "XY")  # replays of compacted batches
    assert ids(spark, target) == before
    write_batches(spark, target, 3, "DEF")  # a replay of the open one, and new batches
    assert ids(spark, target) == [*before, (5, "E"), (6, "F")]
    assert streaming.compact(spark, target) == 2
    folders = spark.read.parquet(target).select("batch_id").distinct().collect()
    assert {r.batch_id for r in folders} == {3, 4, 5}  # the first three are deleted by now
    write_batches(spark, target, 6, "G")
    write_batches(spark, target, 0, "H", stream="other")
    assert ids(spark, target) == [*before, (5, "E"), (6, "F"), (7, "G"), (8, "H")]
    assert streaming.compact(spark, target, keep_open=0) == 3
    assert [i for i, _ in ids(spark, target)] == list(range(1, 9))
    write_batches(spark, target, 7, "I")
    assert ids(spark, target)[-1] == (9, "I")


def test_compaction_that_dies_changes_nothing(spark, monkeypatch):
    target = scratch_path(spark, "out")
    write_batches(spark, target, 0, "ABC")
    before = ids(spark, target)
    with monkeypatch.context() as patched:
        patched.setattr(sink.Manifest, "write", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            streaming.compact(spark, target)
    assert ids(spark, target) == before
    assert streaming.compact(spark, target) == 2
    assert ids(spark, target) == before
    assert streaming.compact(spark, target) == 0
    assert ids(spark, target) == before


def test_compacted_rows_lie_by_date(spark):
    target = scratch_path(spark, "out")
    write = streaming.keyed_batch_writer(target, stream="s")
    for batch_id in range(3):
        texts = [message("A", date=f"2024-01-0{d}") for d in (1, 2)]
        write(streaming.decode_quotes(batch(spark, texts)), batch_id)
    streaming.compact(spark, target)
    files = spark.read.parquet(f"{target}/_compacted").inputFiles()
    assert len({f.split("day=")[1].split("/")[0] for f in files}) == len(files) == 2


def test_routes_of_one_query(spark):
    source, target = scratch_path(spark, "in"), scratch_path(spark, "out")
    texts = [message("A"), "garbage", message("B", "x"), "{}", '{"code":"C"', None, "17"]
    put(spark, source, texts)
    checkpoint = scratch_path(spark, "checkpoint")
    query = streaming.start_routed_stream(stream(spark, source), target, checkpoint, once=True)
    streaming.run_to_end(query, TIMEOUT)
    quotes = streaming.read_route(spark, target)
    assert quotes.drop("batch_id").schema == QUOTE_MESSAGE and [r.code for r in quotes.collect()] == ["A"]
    broken = streaming.read_route(spark, target, streaming.BAD_JSON)
    assert sorted(r.message for r in broken.collect()) == ["garbage", '{"code":"C"']
    fields = streaming.read_route(spark, target, streaming.BAD_FIELD)
    assert sorted(r.message for r in fields.collect()) == sorted([message("B", "x"), "{}", "17"])
    assert "(route#" in broken._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_routes_parse_a_message_once(spark):
    routed = streaming.route_messages(batch(spark, [message("A")]))
    text = routed._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json") == 1


def test_jdbc_rows_carry_their_batch(spark):
    path = scratch_path(spark, "jdbc")
    write = streaming.jdbc_batch_writer("t", {"path": path}, batch_column="batch", stream="s", format="parquet")
    write(streaming.decode_quotes(batch(spark, [message("A")])), 7)
    stored = spark.read.parquet(path).first()
    assert stored.batch == "s/7" and stored.changeCol == 0.5


def one_file_of_events(spark, folder):
    rows = spark.range(400).selectExpr(
        "id as event_id", "timestamp'2024-01-01 10:00:00' + make_interval(0, 0, 0, cast(id % 5 as int)) as ts", "id % 7 as user_id",
        "'click' as event_type", "cast(id % 50 as double) as value", "concat('{\"k\":', id % 9, '}') as props",
    )
    rows.coalesce(1).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def files_of(path):
    return list(Path(path).glob("part-*.parquet"))


def test_topic_is_made_once_and_by_many_tasks(spark, tmp_path, monkeypatch):
    folder, topics = one_file_of_events(spark, tmp_path), []

    def remember(session, label="data"):
        topics.append(scratch_path(session, label))
        return topics[-1]

    monkeypatch.setattr(fixtures, "scratch_path", remember)
    stored = queries.stream_recreated_checkpoint(spark, folder)
    assert sorted(r.id for r in stored.select("id").collect()) == list(range(1, 801))
    assert len(topics) == 1 and len(files_of(topics[0])) > 1


def test_messages_of_both_halves_are_made_once_and_by_many_tasks(spark, tmp_path, monkeypatch):
    folder, landed = one_file_of_events(spark, tmp_path), {}

    def remember(df, label="landed", path=None):
        landed[label] = path or scratch_path(df.sparkSession, label)
        return land(df, label, landed[label])

    monkeypatch.setattr(queries, "land", remember)
    stored = queries.stream_compacted(spark, folder)
    assert stored.count() == 400 and stored.where("not ids_dense").isEmpty()
    assert len(files_of(landed["messages"])) > 1
