import os
import uuid

import pytest
from conftest import plan
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill import plans, sinks, sources
from quotemill.schemas import QUOTE, STAGING, SYMBOLS, star_schemas
from quotemill.scratch import land, scratch_base, scratch_path
from workload import fixtures


@pytest.fixture
def table(spark):
    database = f"io_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, database)}'")
    return f"{database}.t"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_scratch_follows_the_session(spark):
    assert scratch_base(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark) != scratch_path(spark)


def test_landed_files_have_no_checksum_files(spark):
    """A local checksum file costs one more helper process for each file that a task lands."""
    path = scratch_path(spark)
    assert land(spark.range(0, 10, 1, 3), path=path).count() == 10
    names = os.listdir(path.removeprefix("file://"))
    assert sum(n.endswith(".parquet") for n in names) == 3 and not [n for n in names if n.endswith(".crc")]


def test_scratch_without_setting(monkeypatch):
    class Session:
        class conf:
            settings = {"spark.master": "spark://host:7077"}

            @classmethod
            def get(cls, key, default=None):
                return cls.settings.get(key, default)

    with pytest.raises(ValueError):
        scratch_base(Session)
    Session.conf.settings = {"spark.master": "local[2]"}
    assert scratch_base(Session) == scratch_base(Session)


def test_envelopes(spark):
    payloads = [
        ("a", '{"data":[{"code":"A","date":"2024-01-02","open":1,"close":2.5}]}'),
        ("b", '{"data":[]}'),
        ("c", '{"data":[{"code":"C"},{"code":"C","open":"x"},{"code":"D","other":1}]}'),
        ("d", "oops"),
        ("e", None),
        ("f", '{"data":null}'),
        ("g", '{"data":[{"code":"G"}'),
    ]
    frame = spark.createDataFrame(payloads, "id string, payload string")
    exploded = sources.envelope_explode(frame, keep=("id",))
    assert exploded.columns == ["id", *QUOTE.fieldNames()]
    got = [(r.id, r.code, r.open) for r in exploded.collect()]
    assert sorted(got, key=repr) == [
        ("a", "A", 1.0), ("c", "C", None), ("c", "C", None), ("c", "D", None)
    ]
    status = {r.id: (r.status, r.n_records) for r in sources.response_status(frame).collect()}
    assert status == {
        "a": ("single", 1), "b": ("empty", 0), "c": ("multi", 3), "d": ("failed", None),
        "e": ("failed", None), "f": ("failed", None), "g": ("failed", None),
    }


def test_companies_inferred(spark):
    payloads = [('{"Data":[{"id":1,"name":"x"}]}',), ('{"Data":[{"id":2,"rate":0.5}]}',), ("no",)]
    frame = spark.createDataFrame(payloads, "payload string")
    got = sources.company_records(frame).select("id", "name", F.col("rate").cast("double"))
    assert rows(got) == [(1, "x", None), (2, None, 0.5)]


def test_html_cells(spark):
    html = (
        "<TABLE><tr><th>h</th></tr><tr><th>h</th></tr>"
        '<tr class="r"><td>1</td><td><b> AAA </b></td><td>Name</td></tr>\n'
        "<tr><td>2</td>\n<td>BBB</td><td></td><td>Tech</td><td>HNX</td><td>7</td><td>x</td></tr></TABLE>"
    )
    pages = spark.createDataFrame([(1, html), (2, "<p>none</p>"), (3, None)], "page_id int, html string")
    got = sources.table_rows(pages, keep=("page_id",)).collect()
    assert sorted(map(tuple, got)) == [
        (1, 3, "AAA", "Name", None, None, None),
        (1, 4, "BBB", "", "Tech", "HNX", "7"),
    ]
    assert sources.table_rows(pages, last=3).count() == 1
    links = spark.createDataFrame([('<a href="x"><a href="y">',)], "html string")
    got = sources.html_rows(links, 'href="([^"]*)"', "link").collect()
    assert [tuple(r) for r in got] == [(1, "x"), (2, "y")]


def test_nested_tables(spark):
    page = (
        "<script>'<table><tr><td>no</td></tr></table>'</script></table>"
        "<table><tr><td>a</td><td>x<table><tr><td>i1</td><td>i2</td></tr><tr><td>j1</td></tr></table>y</td><td>z</td></tr></table>"
        "<p>between</p><Table ><tr><th> b\n c </th></tr><tr><td><table><tr><td>k<table><tr><td>deep</td></tr></table></td></tr>"
    )
    shown = [(1, page), (2, "<p>none</p>"), (3, None), (4, ""), (5, "<table></table><tablet><tr><td>out</td></tr>")]
    pages = spark.createDataFrame(shown, "page_id int, html string")
    cells = {"c1": 1, "c2": 2, "c3": 3}

    def at(depth, **more):
        got = sources.nested_table_rows(pages, cells, keep=("page_id",), depth=depth, **more)
        return sorted(map(tuple, got.collect()))

    # The last tables of the page are never closed, so neither is the row that holds them.
    assert at(1) == [(1, 1, 1, "a", "x i1 i2 j1 y", "z"), (1, 2, 1, "b c", None, None)]
    assert at(2) == [
        (1, 1, 1, "i1", "i2", None), (1, 1, 2, "j1", None, None), (1, 2, 1, "k deep", None, None),
    ]
    assert at(2, first=2) == [(1, 1, 2, "j1", None, None)]
    assert at(3) == [(1, 1, 1, "deep", None, None)]
    assert at(4) == []


def test_nested_pages_shuffle_columns_and_tell_pieces_without_patterns(spark, sf_dir):
    """The text of a line is several times its columns; a pattern for each piece of a page costs more than its first characters."""
    pages = fixtures.nested_pages(spark, sf_dir)
    found = sources.nested_table_rows(pages, {"c": 1}, keep=("page_id",))
    grouped = [x for x in plan(pages).splitlines() if "Aggregate" in x]
    assert grouped and not any("<tr>" in x for x in grouped)
    assert "RLIKE" not in plan(found) and "translate(" not in plan(found)


def test_csv_quoting(spark):
    path = scratch_path(spark, "csv")
    listing = [("A", 'He said "no", then', None, None, "1"), ("B", "back\\slash", " pad ", "x", "2")]
    frame = spark.createDataFrame(listing, SYMBOLS)
    sinks.write_csv(frame, path)
    assert rows(sources.read_csv(spark, path, SYMBOLS)) == rows(frame)
    assert rows(sources.read_symbols(spark, path)) == [("A",), ("B",)]


def test_csv_header_is_checked_but_not_in_bulk(spark):
    path = scratch_path(spark, "csv")
    other = T.StructType([T.StructField("x", T.StringType()), T.StructField("y", T.IntegerType())])
    sinks.write_csv(spark.createDataFrame([("a", 1)], "n string, m int"), path)
    with pytest.raises(Exception, match="CSV header|CSV_HEADER"):
        sources.read_csv(spark, path, other).collect()
    assert rows(sources.bulk_load(spark, path, other)) == [("a", 1)]


def test_replace_is_idempotent(spark, table):
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for _ in range(2):
        got = sinks.replace_table(frame, table)
    assert rows(got) == [(1, "a"), (2, "b")]
    assert rows(sinks.replace_table(frame.limit(1), table)) == [(1, "a")]


def test_create_append_copy(spark, table):
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    assert sinks.create_if_absent(spark, table, schema).schema == schema
    swapped = spark.createDataFrame([("a", 1)], "v string, k int")
    sinks.append_table(swapped, table)
    assert rows(sinks.create_if_absent(spark, table, schema)) == [(1, "a")]
    renamed = spark.createDataFrame([(2, "b")], "x int, y string")
    assert rows(sinks.copy_table(renamed, table, ["k", "v"])) == [(1, "a"), (2, "b")]


def test_partitioned_table(spark, table):
    schema = star_schemas()["price_dim"]
    sinks.create_if_absent(spark, table, schema, partition_by=["stock_date"])
    text = spark.sql(f"DESCRIBE TABLE {table}").collect()
    assert any(r.col_name == "# Partition Information" for r in text)


def test_many_tables(spark):
    path = scratch_path(spark, "many")
    good = spark.range(3)
    bad = good.select("id", F.col("id").alias("id"))
    got = {r.table: (r.ok, r.error) for r in sinks.write_tables(spark, {"a": bad, "b": good}, path=path).collect()}
    assert got["b"] == (True, None)
    assert got["a"][0] is False and got["a"][1]
    assert spark.read.parquet(f"{path}/b").count() == 3


def test_sql(spark, quotes):
    sources.register_tables({"full_data": plans.transform_quotes(quotes)})
    named = sources.sql_query_named(spark, "SELECT code, count(*) FROM full_data GROUP BY code", ["c", "n"])
    assert named.columns == ["c", "n"]
    assert named.agg(F.sum("n")).first()[0] == quotes.count()
    assert sources.sql_query(spark, "SELECT * FROM full_data").columns == STAGING.fieldNames()


def test_connector_options(spark):
    """Remote systems are not started here; formats without a server stand in for them."""
    frame = spark.range(2)
    sinks.publish_messages(frame, "host:9092", "quotes", format="noop")
    sinks.publish_messages(frame, "host:9092", "quotes", key="id", format="noop")
    sinks.warehouse_append(frame, "d.t", {}, format="noop")
    stream = sources.topic_reader(spark, "host:9092", "quotes", format="rate").load()
    assert stream.isStreaming
    options = {"url": "jdbc:unknown://host/db", "driver": "no.such.Driver"}
    for action in (
        lambda: sources.jdbc_query(spark, "SELECT 1", options),
        lambda: sources.jdbc_table(spark, "t", options, "k", ("0", "9"), 4),
        lambda: sinks.jdbc_append(frame, "t", options),
    ):
        with pytest.raises(Exception, match="no.such.Driver"):
            action()
    with pytest.raises(ValueError):
        sources.jdbc_table(spark, "t", options, "k")
