import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotemill import operators as op
from quotemill import sinks, sources, streaming
from quotemill.schemas import SYMBOLS
from quotemill.scratch import scratch_path


def put(folder, name, codes):
    lines = ["Stock_Code,Name_Company,Industry,Exchange,KLCPNY", *(f"{c},n,i,e,k" for c in codes)]
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def scan(spark, folder, ledger):
    rows, files = sources.read_new_shard_files(spark, str(folder), ledger, "*.csv", SYMBOLS)
    return sorted(r.Stock_Code for r in rows.collect()), files


def test_only_new_and_changed_files_are_read(spark, tmp_path):
    folder = tmp_path / "day"
    ledger = sources.FileLedger(spark, scratch_path(spark, "files"))
    put(folder, "stock_price_1.csv", ["A", "B"])
    put(folder, "other.txt", ["X"])
    for _ in range(2):  # not committed: still new
        got, files = scan(spark, folder, ledger)
        assert got == ["A", "B"]
    ledger.commit(files)
    assert scan(spark, folder, ledger)[0] == []
    put(folder, "stock_price_2.csv", ["C"])
    got, files = scan(spark, folder, ledger)
    assert got == ["C"] and files.count() == 1
    ledger.commit(files)
    put(folder, "stock_price_1.csv", ["A", "B", "D"])
    assert scan(spark, folder, ledger)[0] == ["A", "B", "D"]
    assert ledger.loaded().count() == 2


def test_list_order_holds_over_files_and_blocks(spark, tmp_path, conf):
    conf("spark.sql.files.maxPartitionBytes", "200")
    conf("spark.sql.files.openCostInBytes", "1")
    folder = tmp_path / "list"
    codes = [f"S{(i * 7919) % 1000:04d}" for i in range(300)]
    for n in range(3):
        put(folder, f"{n}.csv", codes[n * 100 : (n + 1) * 100])
    listed = sources.read_symbols_listed(spark, str(folder))
    assert sources.read_symbols(spark, str(folder)).rdd.getNumPartitions() > 10
    assert [r.Stock_Code for r in listed.orderBy("position").collect()] == codes
    assert [r.position for r in listed.orderBy("position").collect()] == list(range(300))
    assert sorted(r.Stock_Code for r in op.position_slice(listed, 25, 75).collect()) == sorted(codes[25:75])


def test_chunks_cover_the_span_once(spark):
    chunks = streaming.replay_chunks(spark, "2024-01-05", "2024-01-20", parts=2, days=5)
    assert [r["chunk"] for r in chunks] == list(range(8))
    days = [c["from_date"] + dt.timedelta(i) for c in chunks[::2] for i in range((c["to_date"] - c["from_date"]).days + 1)]
    assert days == [dt.date(2024, 1, 5) + dt.timedelta(i) for i in range(16)]


def test_replay_goes_on_where_it_died(spark, quotes):
    ledger, sent, alive = scratch_path(spark, "chunks"), [], [2, 1, 99]

    def publish(rows):
        if alive[0] == 0:
            raise ConnectionError
        alive[0] -= 1
        sent.extend(tuple(r) for r in rows.select("code", "date").collect())

    def run(**options):
        span = {"from_date": "2024-01-01", "to_date": "2024-01-31", "parts": 2, "days": 10} | options
        return streaming.resumable_backfill(quotes, None, ledger, publish, **span)

    for _ in range(2):
        with pytest.raises(ConnectionError):
            run()
        alive.pop(0)
    assert run() == 8 - 3
    assert run() == 0
    assert sorted(sent) == sorted(tuple(r) for r in quotes.select("code", "date").collect())
    with pytest.raises(ValueError, match="another span"):
        run(days=11)


def test_published_chunks_are_pruned_by_date(spark, quotes):
    path = scratch_path(spark, "q")
    quotes.write.partitionBy("date").parquet(path)
    plans = []
    streaming.resumable_backfill(
        spark.read.parquet(path), None, scratch_path(spark, "chunks"),
        lambda rows: plans.append(rows._jdf.queryExecution().executedPlan().toString()), "2024-01-05", "2024-01-06", days=1,
    )
    assert len(plans) == 2 and all("PartitionFilters: [isnotnull(date" in p for p in plans)


def test_messages_of_chunks_are_keyed(spark, quotes):
    topic = scratch_path(spark, "topic")

    def publish(rows):
        sinks.publish_messages(rows, "h:1", "t", key="code", options={"path": topic}, format="parquet")

    streaming.resumable_backfill(quotes, None, scratch_path(spark, "chunks"), publish, "2024-01-01", "2024-01-31")
    stored = spark.read.parquet(topic)
    assert stored.columns == ["key", "value"] and stored.count() == quotes.count()
    assert stored.where(F.get_json_object("value", "$.code") != F.col("key")).isEmpty()
