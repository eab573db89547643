"""Every registered query against its SQL, over the whole smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, queries
from workload.oracles import ORACLES
from workload.queries import QUERIES

import check_oracles as check

from conftest import SF_DIR


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    relation = duck.sql(ORACLES[name])
    types = {c: check.KINDS.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    assert dict(df.dtypes) == types
    got = check.rows_of(df.columns, df.collect())
    assert got == check.rows_of(relation.columns, relation.fetchall())


def test_entry(spark):
    assert entry(spark).count() == 397


def test_known_row_counts(spark):
    assert queries()["fact_reload_fanout"](spark, SF_DIR).count() == 12704
    assert queries()["datetime_dim"](spark, SF_DIR).count() == 397
    assert queries()["date_id_overflow"](spark, SF_DIR).count() == 364
    assert queries()["missing_codes"](spark, SF_DIR).count() == 135
