import random

import pytest
from pyspark.sql import functions as F

from quotemill import operators as op
from quotemill.operators import numbering


def skewed(spark, n=9000):
    """A third of the rows are one exact copy, a third share symbol and date."""
    rng = random.Random(5)
    rows = [("HOT", 10, 1.0)] * (n // 3)
    rows += [("HOT", 11, float(rng.randrange(10**6))) for _ in range(n // 3)]
    rows += [
        (rng.choice(["A", "B", "HOT", None]), rng.randrange(30), float(rng.randrange(50)))
        for _ in range(n // 3)
    ]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "code string, day int, price double").repartition(8)


def ordered(rows, *at):
    def key(row):
        return [(row[i] is not None, row[i]) for i in at]

    return sorted(rows, key=key)


def test_positions_match_a_full_sort(spark):
    rows, df = skewed(spark)
    got = op.positions(df, ["day", "code"]).orderBy("position").collect()
    assert [r.position for r in got] == list(range(len(rows)))
    assert [(r.code, r.day, r.price) for r in got] == ordered(rows, 1, 0, 2)


def test_copies_are_spread_over_ranges(spark, monkeypatch, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    landed = []

    def remember(df, label="landed", path=None):
        result = land(df, label, path)
        landed.append((label, result))
        return result

    land = numbering.land
    monkeypatch.setattr(numbering, "land", remember)
    rows, df = skewed(spark)
    op.positions(df, ["day", "code"])
    ranges = dict(landed)["ranges"]
    sizes = [
        r["count"] for r in ranges.groupBy(F.shiftright("__place", 33)).count().collect()
    ]
    assert sum(sizes) == len(rows)
    assert len(sizes) == 8 and max(sizes) < len(rows) / 4


@pytest.mark.parametrize("n", [0, 1, 7])
def test_small_inputs(spark, n):
    df = spark.range(n).select(F.col("id").alias("a"))
    assert sorted(r.k for r in op.assign_keys(df, "k", ["a"]).collect()) == list(range(1, n + 1))


def test_keys_continue(spark):
    first = op.assign_keys(spark.range(5).toDF("a"), "k", ["a"])
    second = op.assign_keys(spark.range(3).toDF("a"), "k", ["a"], op.last_key(first, "k"))
    assert sorted(r.k for r in second.collect()) == [6, 7, 8]
    none = op.assign_keys(spark.range(0).toDF("a"), "k", ["a"])
    third = op.assign_keys(spark.range(2).toDF("a"), "k", ["a"], op.last_key(none, "k"))
    assert sorted(r.k for r in third.collect()) == [1, 2]


def test_landed_result_is_stable(spark):
    _, df = skewed(spark, 300)
    numbered = op.positions(df, ["day"])
    first = {tuple(r) for r in numbered.collect()}
    assert first == {tuple(r) for r in numbered.collect()}
