import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import final_plan, plan
from quotemill import operators as op
from quotemill import plans, sinks
from quotemill.schemas import FACT, MEASURE_DIMS, STAGING, star_schemas
from quotemill.scratch import land, scratch_path
from workload import fixtures


@pytest.fixture(scope="module")
def staging(spark, sf_dir):
    return land(plans.transform_quotes(fixtures.quotes_daily(spark, sf_dir)))


@pytest.fixture
def database(spark):
    name = f"star_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name


def counts(spark, database):
    return {name: spark.table(f"{database}.{name}").count() for name in star_schemas() if name != "full_data"}


def test_schemas(staging):
    dims = plans.dimensions(staging, land_input=False)
    for name, frame in dims.items():
        assert dict(frame.dtypes) == dict(
            (f.name, f.dataType.simpleString()) for f in star_schemas()[name]
        )
        assert frame.columns == star_schemas()[name].fieldNames()
    assert plans.fact_table(staging, dims).columns == FACT.fieldNames()


def test_keys_are_dense_and_shared(staging):
    dims = plans.dimensions(staging, land_input=False)
    for name, (key, _) in MEASURE_DIMS.items():
        low, high, n = dims[name].agg(F.min(key), F.max(key), F.count_distinct(key)).first()
        assert (low, high, n) == (1, 397, 397)
        alone = plans.measure_dim(staging, name)
        assert alone.exceptAll(dims[name]).isEmpty()


def test_readback_equals_staging(staging):
    dims = plans.dimensions(staging, padded=True, land_input=False)
    assert op.pk_violations(dims["datetime_dim"], "date_id").isEmpty()
    rebuilt = plans.star_readback(plans.fact_table(staging, dims), dims)
    assert rebuilt.columns == STAGING.fieldNames()
    assert rebuilt.exceptAll(staging).isEmpty() and staging.exceptAll(rebuilt).isEmpty()


def test_fact_plan(staging, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    staged = staging
    dims = {
        name: land(frame) for name, frame in plans.dimensions(staging, land_input=False).items()
    }
    text = plan(plans.fact_table(staged, dims))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert text.count("SortMergeJoin") == 6
    # Staging twice, the date dimension once, each measure dimension once.
    assert text.count("Exchange hashpartitioning") <= 8


def test_bucketed_tables_join_without_shuffle(spark, staging, database, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    dims = plans.dimensions(staging, land_input=False)
    by = ["code", "stock_date"]
    left = sinks.bucketed_table(staging, f"{database}.rows", by, 4)
    right = sinks.bucketed_table(dims["price_dim"], f"{database}.price", by, 4)
    joined = left.select("code", "stock_date", "floor").join(right, by)
    assert "Exchange" not in plan(joined).replace("ShuffleExchange", "Exchange")
    assert joined.count() == 397


def test_hot_update_time_is_split(spark, conf):
    """All symbols close at the same second: the date join is split, not one task."""
    n = 40000
    rows = spark.range(n).select(
        F.format_string("S%06d", F.col("id") % 20000).alias("code"),
        F.expr("date_add(DATE'2024-01-01', CAST(id DIV 20000 AS INT))").alias("stock_date"),
        F.when(F.col("id") % 3 < 2, "15:00:00").otherwise(
            F.format_string("10:%02d:%02d", F.col("id") % 60, (F.col("id") * 7) % 59)
        ).alias("time_update"),
        F.lit("X").alias("floor"), F.lit("STOCK").alias("typeStock"),
    )
    rows = land(rows.repartition(8))
    dates = land(
        rows.select("stock_date", "time_update").distinct().withColumn("date_id", F.xxhash64("*"))
    )
    dims = {"datetime_dim": dates}
    for name, (key, _) in MEASURE_DIMS.items():
        dims[name] = land(rows.select(F.xxhash64("code", "stock_date").alias(key), "code", "stock_date"))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    fact = plans.fact_table(rows, dims)
    text = final_plan(fact)
    assert "skew=true" in text
    assert fact.count() == n


def response(code, days, date=dt.date(2024, 1, 2), time="15:00:00"):
    records = [
        {"code": code, "date": str(date + dt.timedelta(i)), "time": time, "floor": "HOSE",
         "type": "STOCK", "open": 1.5 + i, "close": 2}
        for i in range(days)
    ]
    return code, json.dumps({"data": records})


def run(spark, database, responses, codes, **options):
    options.setdefault("first_by", ("code",))
    frame = spark.createDataFrame(responses, "code string, payload string")
    symbols = spark.createDataFrame([(c,) for c in codes], "Stock_Code string")
    return plans.run_daily(
        spark, frame, symbols, "2024-01-01", "2024-01-31", "2024-01-31", database, **options
    )


def test_daily_load_and_reload(spark, database):
    codes = ["A", "B", "C"]
    responses = [response(c, n) for c, n in zip(codes, [1, 2, 3])]
    fact = run(spark, database, responses, codes)
    assert sorted((r.code, r.priceKey) for r in fact.collect()) == [("A", 1), ("B", 2), ("C", 3)]
    assert spark.table(f"{database}.full_data").count() == 3
    once = counts(spark, database)
    run(spark, database, responses, codes)
    assert counts(spark, database) == once
    later = [response(c, 1, dt.date(2024, 1, 9)) for c in codes]
    fact = run(spark, database, later, codes)
    assert sorted(r.priceKey for r in fact.collect()) == [1, 2, 3, 4, 5, 6]
    dims = {name: spark.table(f"{database}.{name}") for name in [*MEASURE_DIMS, "datetime_dim"]}
    assert op.fk_orphans(fact, dims).isEmpty()
    for name, (key, _) in MEASURE_DIMS.items():
        assert op.pk_violations(dims[name], key).isEmpty()


def test_load_of_many_dates(spark, database):
    codes = ["A", "B", "C"]
    responses = [response(c, 4) for c in codes]
    fact = run(spark, database, responses, codes, first_by=("code", "date"))
    assert fact.count() == 12
    keys = [r.price_id for r in spark.table(f"{database}.price_dim").collect()]
    assert sorted(keys) == list(range(1, 13))


def test_existing_dates_are_pruned(spark, database):
    codes = ["A", "B", "C"]
    run(spark, database, [response(c, 3) for c in codes], codes, first_by=("code", "date"))
    dim = spark.table(f"{database}.price_dim").where(F.col("stock_date") == "2024-01-03")
    text = plan(dim)
    assert "PartitionFilters: [isnotnull(stock_date" in text
    assert len(spark.table(f"{database}.price_dim").inputFiles()) > len(dim.inputFiles())


def test_null_date_survives_a_reload(spark, database):
    base = plans.blank_staging(spark)
    row = spark.createDataFrame([("A", None, "X")], "code string, stock_date date, floor string")
    staging = land(base.unionByName(row, allowMissingColumns=True))
    for _ in range(2):
        plans.load_star(spark, staging, database, dates=("2024-01-01", "2024-01-31"))
    got = counts(spark, database)
    assert got["price_dim"] == 1 and got["datetime_dim"] == 1 and got["fact_table"] == 0


def test_reload_without_dedupe_multiplies(spark, database):
    codes = ["A", "B", "C"]
    responses = [response(c, 1) for c in codes]
    run(spark, database, responses, codes, dedupe=False)
    run(spark, database, responses, codes, dedupe=False)
    got = counts(spark, database)
    assert got["price_dim"] == 6 and got["datetime_dim"] == 2
    # 3 of the first load, then 2 dates x 2^5 dimension rows for each quote.
    assert got["fact_table"] == 3 + 3 * 2 * 32


@pytest.mark.parametrize("bad", ["not json", '{"data": []}', None, '{"error": 1}'])
def test_incomplete_day_loads_nothing(spark, database, bad):
    codes = ["A", "B", "C"]
    responses = [response("A", 1), response("B", 1), ("C", bad)]
    run(spark, database, responses, codes)
    assert set(counts(spark, database).values()) == {0}
    assert spark.table(f"{database}.full_data").count() == 0


def test_failed_response_beside_good_ones_voids_the_day(spark, database):
    codes = ["A", "B", "C", "D", "E", "F"]
    responses = [response(c, 1) for c in codes[:-1]] + [("F", "timeout")]
    run(spark, database, responses, codes)
    assert set(counts(spark, database).values()) == {0}


def test_append_new_rows_only(spark):
    def dim(rows):
        return spark.createDataFrame(rows, "code string, stock_date date, v double")

    day = dt.date(2024, 1, 1)
    loaded = op.assign_keys(dim([("A", day, 1.0), (None, day, 2.0)]), "k")
    fresh = op.append_new(dim([("A", day, 9.0), (None, day, 9.0), ("B", day, 3.0)]), loaded, "k")
    assert [tuple(r) for r in fresh.collect()] == [(3, "B", day, 3.0)]


def test_unmatched_quotes(spark, staging):
    dims = plans.dimensions(staging, land_input=False)
    assert op.unmatched_quotes(staging, dims).isEmpty()
    keyless = staging.limit(1).withColumn("code", F.lit(None).cast("string"))
    got = op.unmatched_quotes(staging.unionByName(keyless), dims).collect()
    assert sorted(r.reason for r in got) == sorted(MEASURE_DIMS)
    timeless = staging.limit(1).withColumn("time_update", F.lit(None).cast("string"))
    got = op.unmatched_quotes(staging.unionByName(timeless), dims).collect()
    assert [r.reason for r in got] == ["datetime_dim"]


def test_fk_orphans_counts_and_nulls(spark, staging):
    dims = plans.dimensions(staging, padded=True, land_input=False)
    fact = plans.fact_table(staging, dims)
    broken = fact.limit(2).withColumn("adKey", F.lit(-5).cast("bigint"))
    empty = fact.limit(1).withColumn("adKey", F.lit(None).cast("bigint"))
    got = op.fk_orphans(fact.unionByName(broken).unionByName(empty), dims).collect()
    assert [tuple(r) for r in got] == [("adKey", -5, 2)]


def test_pk_violations_finds_nulls(spark):
    frame = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k bigint")
    got = {tuple(r) for r in op.pk_violations(frame, "k").collect()}
    assert got == {(1, 2), (None, 1)}
