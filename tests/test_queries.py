"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from lading.catalog import QUERIES

SF_DIR = os.environ.get("LADING_TEST_SF", "/root/testdata/sf0.001")
TABLES = ("customer", "documents", "events", "orders", "pages")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def _sorted(rows):
    def plain(value):
        return None if isinstance(value, float) and math.isnan(value) else value

    return sorted(tuple(repr(plain(v)) for v in row) for row in rows)


# Queries of the optional subpackage have their own tests in its folder.
NAMES = sorted(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, tables, name):
    frame = entry_point.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    rows = [tuple(r[c] for c in columns) for r in frame.collect()]
    sql = entry_point.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    result = tables.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in result.fetchall()]
    assert _sorted(rows) == _sorted(expected)


COUNTED_DIR = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(COUNTED_DIR), reason="test tables are not here")
def test_known_counts(spark):
    """The counts FIXTURES.md gives for sf0.01."""
    queries = entry_point.queries()

    def run(name):
        return queries[name](spark, COUNTED_DIR)

    assert {r.action: (r.objects, r.bytes) for r in run("sync_plan_counts").collect()} == {
        "skip_since": (240, 574264), "unchanged": (533, 1328267), "filtered": (34, 103928),
        "copy: missing": (76, 205404), "copy: etag": (75, 179985), "copy: size": (42, 80610),
        "delete: orphan": (250, 250)}
    assert run("acl_compare").filter("match").count() == 1258
    assert run("acl_compare_strict").filter("match").count() == 1078
    assert run("grantee_label").count() == 2188
    assert run("size_class").filter("class = 'large'").count() == 11976
    assert run("part_plan").count() == 466286
    assert run("inventory_latest").count() == 750


@pytest.mark.skipif(not os.path.isdir(COUNTED_DIR), reason="test tables are not here")
def test_whole_forms_read_long_bodies(spark):
    queries = entry_point.queries()
    long = spark.read.parquet(f"{COUNTED_DIR}/documents.parquet").filter("octet_length(text) > 20000")
    scanned = queries["content_scan_whole"](spark, COUNTED_DIR).filter("length > 20000")
    assert scanned.count() == long.count() > 0
    whole = queries["content_md5_join_whole"](spark, COUNTED_DIR)
    assert whole.count() > queries["content_md5_join"](spark, COUNTED_DIR).count()


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_no_oracle_without_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
