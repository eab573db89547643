import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import plan
from quotemill import operators as op
from quotemill.scratch import land, scratch_path


@pytest.fixture(scope="module")
def skewed(spark):
    """One symbol with a third of the rows, many exact copies, NULL symbols."""
    rng = random.Random(3)
    first = dt.date(2024, 1, 1)
    rows = [("HOT", first + dt.timedelta(rng.randrange(5)), float(rng.randrange(4))) for _ in range(2000)]
    rows += [
        (rng.choice(["A", "B", "C", None, "D"]), first + dt.timedelta(rng.randrange(40)), float(rng.randrange(300)))
        for _ in range(4000)
    ]
    return rows, spark.createDataFrame(rows, "code string, date date, price double").repartition(8)


def pages(rows, page, size):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    return Counter(
        row
        for group in groups.values()
        for row in sorted(group, key=lambda r: (r[1], r[2]))[size * (page - 1) : size * page]
    )


@pytest.mark.parametrize("page,size", [(1, 9990), (1, 900), (1, 1), (2, 500), (3, 700), (2, 9990)])
def test_price_page(skewed, page, size):
    rows, df = skewed
    got = Counter(tuple(r) for r in op.price_page(df, page, size).collect())
    assert got == pages(rows, page, size)


def test_price_page_arguments(skewed):
    with pytest.raises(ValueError):
        op.price_page(skewed[1], page=0)


def test_short_symbols_are_not_shuffled(skewed):
    assert "Exchange" not in plan(op.price_page(skewed[1].coalesce(1), 1, 9990).select("price")).replace(
        "Exchange RoundRobin", ""
    )


@pytest.mark.parametrize("ascending", [True, False])
def test_first_record(skewed, ascending):
    rows, df = skewed
    want = {}
    for row in sorted(rows, key=lambda r: ((r[1].toordinal() if ascending else -r[1].toordinal()), r[2])):
        want.setdefault(row[0], row)
    got = op.first_record(df, ascending=ascending).collect()
    assert {tuple(r) for r in got} == set(want.values())
    assert len(got) == len(want)


def test_first_record_limits_before_the_shuffle(skewed):
    text = plan(op.first_record(skewed[1]))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_price_range_reaches_the_scan(spark, quotes):
    stored = land(quotes)
    text = plan(op.price_range(stored, "2024-01-05", "2024-01-08", "U00001"))
    pushed = text[text.index("PushedFilters") :]
    assert "GreaterThanOrEqual(date,2024-01-05)" in pushed
    assert "LessThanOrEqual(date,2024-01-08)" in pushed
    assert "EqualTo(code,U00001)" in pushed


def test_price_range_is_closed(quotes):
    days = [r.date for r in op.price_range(quotes, "2024-01-05", "2024-01-06").select("date").distinct().collect()]
    assert sorted(days) == [dt.date(2024, 1, 5), dt.date(2024, 1, 6)]


def test_distinct_on_date_prunes_partitions(spark, quotes):
    path = scratch_path(spark, "by_date")
    quotes.write.partitionBy("date").parquet(path)
    text = plan(op.distinct_on_date(spark.read.parquet(path), "2024-01-15"))
    assert "PartitionFilters: [isnotnull(date" in text


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 1604])
def test_shards(spark, n):
    symbols = spark.range(n).select(F.format_string("S%05d", "id").alias("Stock_Code"))
    got = op.symbol_shards(op.symbol_positions(symbols)).collect()
    third = n // 3
    for row in got:
        want = 0 if row.position < third else 1 if row.position < 2 * third else 2
        assert (row.Stock_Code, row.shard) == (f"S{row.position:05d}", want)
    assert len(got) == n


def test_slice(spark):
    symbols = op.symbol_positions(spark.createDataFrame([(c,) for c in "dacb"], "Stock_Code string"))
    assert sorted(r.Stock_Code for r in op.position_slice(symbols, 1, 3).collect()) == ["b", "c"]


def test_missing_codes(spark):
    symbols = spark.createDataFrame([("A",), ("B",), ("C",)], "Stock_Code string")
    seen = spark.createDataFrame([("A",)] * 50 + [(None,)], "code string")
    assert sorted(r.Stock_Code for r in op.missing_codes(symbols, seen).collect()) == ["B", "C"]


def shard_rows(spark, shards):
    return spark.createDataFrame([(s, f"c{i}") for i, s in enumerate(shards)], "shard int, code string")


@pytest.mark.parametrize(
    "shards,complete", [([0, 1, 2, 2], True), ([0, 2], False), ([0, 1, None], False), ([], False)]
)
def test_gate(spark, shards, complete):
    got = op.publish_if_complete(shard_rows(spark, shards), range(3)).count()
    assert got == (len(shards) if complete else 0)


def test_gate_with_failures(spark):
    rows = shard_rows(spark, [0, 1, 2])
    failed = shard_rows(spark, [1])
    assert op.publish_if_complete(rows, range(3), failures=failed).count() == 0
    assert op.publish_if_complete(rows, range(3), failures=failed.limit(0)).count() == 3


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.5)], "b string, c double")
    got = {tuple(r) for r in op.union_shards([a, b]).select("a", "b", "c").collect()}
    assert got == {(1, "x", None), (None, "y", 2.5)}
    with pytest.raises(ValueError):
        op.union_shards([])
