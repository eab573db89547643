"""Checks of a load by summaries: equal to the checks of whole tables, and without reading them."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from conftest import plan
from pyspark.sql import functions as F

from quotemill import operators as op
from quotemill.schemas import FOREIGN_KEYS
from quotemill.scratch import scratch_path

DAY = dt.date(2024, 1, 1)


@pytest.fixture
def summaries(spark):
    name = f"summaries_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return op.KeySummaries(spark, f"{name}.key_summaries")


def keyed(spark, rows):
    """(key, days after the first day or None) as rows."""
    rows = [(k, None if d is None else DAY + dt.timedelta(d)) for k, d in rows]
    return spark.createDataFrame(rows, "k bigint, stock_date date")


def stored(spark, rows):
    path = scratch_path(spark, "stored")
    frame = keyed(spark, rows)
    frame.write.partitionBy("stock_date").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


OLD = [(None, 0), (1, 0), (2, 0), (2, 1), (32768, 1), (32769, 1), (-5, 2), (0, 2), (10**15, 3), (7, None), (8, 3), (8, 3)]
NEW = [(None, 4), (2, 4), (3, 4), (3, 5), (32769, 4), (-5, 4), (5, 4), (10**15, 5), (10**15 + 1, 5), (7, None), (0, 5)]


def test_primary_key_of_a_load(spark, summaries):
    table, new = stored(spark, OLD), keyed(spark, NEW)
    summaries.refresh("t", table, "k")
    got = op.pk_violations_of_load(new, table, "t", "k", summaries)
    loaded = {k for k, _ in NEW}
    whole = op.pk_violations(table.unionByName(new), "k").collect()
    assert sorted(map(str, got.collect())) == sorted(str(r) for r in whole if r["k"] in loaded)
    # 8 is used twice before the load; that is not the load's fault.
    assert 8 not in {r["k"] for r in got.collect()}


def test_only_partitions_in_conflict_are_read(spark, summaries):
    table = stored(spark, [(i, i // 10) for i in range(100)])
    summaries.refresh("t", table, "k")
    got = op.pk_violations_of_load(keyed(spark, [(33, 11), (34, 11), (1000, 11)]), table, "t", "k", summaries)
    assert sorted(map(tuple, got.collect())) == [(33, 2), (34, 2)]
    scan = [line for line in plan(got).splitlines() if "PartitionFilters" in line and "2024-01-04" in line]
    assert scan and "2024-01-05" not in scan[0]
    none = op.pk_violations_of_load(keyed(spark, [(500, 11)]), table, "t", "k", summaries)
    assert none.collect() == []


def test_holders_match_brute_force(spark, summaries):
    rows = [(i * 7919 % 200_003 - 1000, i % 5) for i in range(3000)]
    summaries.refresh("t", keyed(spark, rows), "k")
    asked = keyed(spark, [(k, 0) for k in range(-1200, 5000)])
    want = {(k, DAY + dt.timedelta(d)) for k, d in rows if -1200 <= k < 5000}
    assert {tuple(r) for r in summaries.holders("t", asked, "k").collect()} == want


def test_refresh_of_some_dates(spark, summaries):
    summaries.refresh("t", keyed(spark, [(1, 0), (2, 1), (3, 2), (4, None)]), "k")
    summaries.refresh("other", keyed(spark, [(1, 0)]), "k")
    # The second day now holds another key, the third nothing; rows without a date are gone.
    summaries.refresh("t", keyed(spark, [(5, 1)]), "k", ("2024-01-02", "2024-01-03"))

    def holds(name):
        asked = keyed(spark, [(k, 0) for k in range(10)])
        return sorted(r["k"] for r in summaries.holders(name, asked, "k").collect())

    assert holds("t") == [1, 5]
    assert holds("other") == [1]
    summaries.refresh("t", keyed(spark, []), "k")
    assert holds("t") == [] and holds("other") == [1]


def test_foreign_keys_of_a_load(spark, summaries):
    dims = {}
    for at, (table, key) in enumerate(FOREIGN_KEYS.values()):
        dims[table] = keyed(spark, [(i + 40_000 * at, i % 3) for i in range(50)]).withColumnRenamed("k", key)
    op.refresh_dimensions(summaries, dims)
    facts = spark.range(60).select(
        *(F.when(F.col("id") == 5, None).otherwise(F.col("id") + 40_000 * at).alias(c) for at, c in enumerate(FOREIGN_KEYS))
    )
    facts = facts.unionByName(facts.where("dateKey > 55"))
    got = op.fk_orphans_of_load(facts, summaries)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, op.fk_orphans(facts, dims).collect()))
    assert got.count() == 60
    assert op.fk_orphans_of_load(facts.limit(0), summaries).collect() == []
