import datetime as dt
import json
import subprocess
import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import plan
from quotemill import operators as op
from quotemill import plans, sinks, sources
from quotemill.schemas import MEASURE_DIMS
from quotemill.scratch import land, scratch_path

DAY = dt.date(2024, 1, 2)


@pytest.fixture
def database(spark):
    name = f"reload_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name


def staged(spark, rows):
    """(code, date, time, price) as staging rows."""
    quotes = [
        {"code": c, "date": d, "time": f"{d} {t}", "floor": "HOSE", "type": "STOCK", "basicPrice": p, "close": p}
        for c, d, t, p in rows
    ]
    from quotemill.schemas import QUOTE

    return land(plans.transform_quotes(spark.createDataFrame(quotes, QUOTE)))


def stored(spark, database):
    """(code, date, price, key, date key) of every fact."""
    fact = plans.fact_rows(spark, database)
    price = spark.table(f"{database}.price_dim").select(F.col("price_id").alias("priceKey"), "stock_date", "basicPrice")
    rows = fact.join(price, "priceKey").collect()
    return sorted((r.code, r.stock_date, r.basicPrice, r.priceKey, r.dateKey) for r in rows)


def dims(spark, database):
    return {name: spark.table(f"{database}.{name}") for name in [*MEASURE_DIMS, "datetime_dim"]}


MONTH = ("2024-01-01", "2024-01-31")
ONE = ("2024-01-02", "2024-01-02")


def test_corrected_day_keeps_its_keys(spark, database):
    later = DAY + dt.timedelta(1)
    first = [("A", DAY, "10:00:00", 1.0), ("B", DAY, "10:00:00", 2.0), ("C", DAY, "10:00:00", 3.0), ("A", later, "10:00:00", 4.0)]
    plans.load_star(spark, staged(spark, first), database, padded=True, dates=MONTH)
    # A: time, B: gone, C: measures, D: new.
    again = [("A", DAY, "11:00:00", 1.0), ("C", DAY, "10:00:00", 9.0), ("D", DAY, "10:00:00", 5.0)]
    want = [
        ("A", DAY, 1.0, 1, 20240102110000), ("A", later, 4.0, 4, 20240103100000), ("C", DAY, 9.0, 3, 20240102100000),
        ("D", DAY, 5.0, 5, 20240102100000),
    ]
    for _ in range(2):
        plans.replace_star(spark, staged(spark, again), ONE, database, padded=True)
        assert stored(spark, database) == want
        assert op.fk_orphans(plans.fact_rows(spark, database), dims(spark, database)).isEmpty()
        assert spark.table(f"{database}.datetime_dim").count() == 3
    # A load after it continues behind the keys of the reload.
    plans.load_star(spark, staged(spark, [("E", later, "10:00:00", 6.0)]), database, padded=True, dates=MONTH)
    assert ("E", later, 6.0, 6, 20240103100000) in stored(spark, database)


def test_days_that_a_reload_no_longer_holds_are_gone(spark, database):
    days = [DAY + dt.timedelta(i) for i in range(3)]
    plans.load_star(spark, staged(spark, [("A", d, "10:00:00", 1.0) for d in days]), database, dates=MONTH)
    plans.replace_star(spark, staged(spark, [("A", days[0], "10:00:00", 2.0)]), ("2024-01-02", "2024-01-03"), database)
    assert [r[:4] for r in stored(spark, database)] == [("A", days[0], 2.0, 1), ("A", days[2], 1.0, 3)]
    for table in dims(spark, database).values():
        assert table.where(F.col("stock_date") == F.lit(days[1])).isEmpty()


@pytest.mark.parametrize("rows", [
    [("A", DAY, "10:00:00", 1.0), ("A", DAY, "11:00:00", 1.0)],
    [("A", DAY + dt.timedelta(1), "10:00:00", 1.0)],
])
def test_reload_refuses_what_it_cannot_replace(spark, database, rows):
    plans.load_star(spark, staged(spark, [("A", DAY, "10:00:00", 7.0)]), database, dates=MONTH)
    before = stored(spark, database)
    with pytest.raises(ValueError):
        plans.replace_star(spark, staged(spark, rows), ONE, database)
    assert stored(spark, database) == before


def test_null_codes_keep_their_key_and_have_no_fact(spark, database):
    rows = staged(spark, [(None, DAY, "10:00:00", 1.0), ("A", DAY, "10:00:00", 2.0)])
    for _ in range(2):
        plans.replace_star(spark, rows, ONE, database)
        keys = {r.code: r.price_id for r in spark.table(f"{database}.price_dim").collect()}
        assert keys == {None: 1, "A": 2}
    assert [r[0] for r in stored(spark, database)] == ["A"]


def test_other_dates_are_not_read(spark, database):
    """Files of other days are spoilt: neither a load nor a reload of a day opens them."""
    plans.load_star(spark, staged(spark, [("A", DAY, "10:00:00", 1.0)]), database, dates=ONE)
    spoilt = 0
    for name in [*MEASURE_DIMS, "datetime_dim", "fact_table"]:
        for file in spark.table(f"{database}.{name}").inputFiles():
            path = Path(file.removeprefix("file://"))
            path.write_bytes(b"spoilt")
            Path(path.parent, f".{path.name}.crc").unlink(missing_ok=True)
            spoilt += 1
    assert spoilt >= 7
    day = ("2024-01-05", "2024-01-05")
    rows = [("A", dt.date(2024, 1, 5), "10:00:00", 2.0)]
    plans.load_star(spark, staged(spark, rows), database, dates=day)
    plans.replace_star(spark, staged(spark, rows), day, database)
    keys = spark.table(f"{database}.price_dim").where(F.col("stock_date") == "2024-01-05").collect()
    assert [r.price_id for r in keys] == [2]


def test_keys_of_a_load_that_died_are_not_given_again(spark, database):
    table = sinks.create_if_absent(spark, f"{database}.t", sources.files.SYMBOLS)
    ledger = op.KeyLedger(spark, f"{database}.ledger")
    tables = {"t": (table.selectExpr("cast(null as bigint) k").limit(0), "k")}
    assert ledger.open("one", tables, 10) == {"t": 0}
    assert ledger.open("one", tables, 10) == {"t": 0}  # the same load again
    assert ledger.open("two", tables, 5) == {"t": 10}
    ledger.close("two", {"t": 10}, {"t": 12})
    assert ledger.open("three", tables, 1) == {"t": 12}
    ledger.close("three", {"t": 12}, {"t": None})
    assert ledger.open("four", tables, 1) == {"t": 12}


def test_ledger_begins_after_a_table_filled_before(spark, database):
    ledger = op.KeyLedger(spark, f"{database}.ledger")
    filled = spark.createDataFrame([(41,), (7,)], "k bigint")
    assert ledger.last_keys({"t": (filled, "k")}) == {"t": 41}


def test_replaced_partitions(spark, database):
    name = f"{database}.p"
    sinks.create_if_absent(spark, name, spark.createDataFrame([], "a int, d date").schema, partition_by=["d"])
    rows = spark.createDataFrame([(1, DAY), (2, DAY + dt.timedelta(1)), (3, None)], "a int, d date")
    sinks.append_table(rows, name)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    # Made of the table itself.
    twice = spark.table(name).where("a = 1").withColumn("a", F.col("a") * 10)
    sinks.replace_partitions(twice, name, [f"d = DATE'{DAY + dt.timedelta(1)}'"])
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(3, None), (10, DAY)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_quotes_in_a_path(spark, database):
    path = scratch_path(spark, "it's")
    sinks.create_if_absent(spark, f"{database}.q", sources.files.SYMBOLS, path)
    sinks.append_table(spark.createDataFrame([("A",) * 5], sources.files.SYMBOLS), f"{database}.q")
    assert spark.read.parquet(path).count() == 1


def read_day(spark, responses, codes, **options):
    frame = land(spark.createDataFrame(responses, "code string, payload string"))
    symbols = spark.createDataFrame([(c,) for c in codes], "Stock_Code string")
    return plans.read_day(frame, symbols, *MONTH, **options)


def payload(*dates, code="X"):
    return json.dumps({"data": [{"code": code, "date": str(d), "time": "15:00:00"} for d in dates]})


def test_reasons_for_a_void_load(spark):
    responses = [
        ("A", payload(DAY)), ("B", "timeout"), ("B", "timeout"), ("C", payload("01/2024", DAY)), ("D", None),
        ("E", payload(DAY)), ("other", "timeout"),
    ]
    quotes, rejects = read_day(spark, responses, ["A", "B", "C", "D", "E", "F"])
    assert quotes.isEmpty()
    want = [("B", "unreadable"), ("C", "undated"), ("D", "unreadable"), ("F", "absent")]
    assert sorted(tuple(r) for r in rejects.collect()) == want


def test_complete_load_has_no_rejects(spark):
    quotes, rejects = read_day(spark, [(c, payload(DAY, "2023-12-31", code=c)) for c in "ABC"], "ABC")
    assert rejects.isEmpty() and quotes.count() == 3
    quotes, rejects = read_day(spark, [], "ABC")
    assert quotes.isEmpty() and sorted(r.symbol for r in rejects.collect()) == ["A", "B", "C"]


def test_payloads_are_parsed_once_and_stay_where_they_are(spark):
    frame = land(spark.createDataFrame([("A", payload(DAY))], "code string, payload string"))
    text = plan(sources.response_records(frame, *MONTH))
    assert text.count("from_json") == 1 and "Exchange" not in text


def test_run_daily_replaces_and_reports(spark, database):
    def run(responses, **options):
        frame = spark.createDataFrame(responses, "code string, payload string")
        symbols = spark.createDataFrame([("A",)], "Stock_Code string")
        return plans.run_daily(spark, frame, symbols, *ONE, run_date="2024-01-02", database=database, **options)

    # One symbol: the first two shards are empty, so nothing is published.
    assert run([("A", "timeout")], replace=True).isEmpty()
    assert [tuple(r) for r in spark.table(f"{database}.load_rejects").collect()] == [("A", "unreadable")]


def test_entry_without_the_training_operators(tmp_path):
    """The queries import and register where the subpackage and its tests are not there."""
    root = Path(__file__).resolve().parents[1]
    code = f"""
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name == "quotemill.llm" or name.startswith("quotemill.llm."):
            raise ModuleNotFoundError(name)
import importlib.util
real = importlib.util.find_spec
importlib.util.find_spec = lambda name, package=None: None if name.startswith("quotemill.llm") else real(name, package)
sys.meta_path.insert(0, Hidden())
sys.path.insert(0, {str(root)!r})
import __spark_entry__ as e
assert set(e.queries()) == set(e.oracle_sql()), set(e.queries()) ^ set(e.oracle_sql())
assert not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in e.queries())
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert done.returncode == 0, done.stderr
