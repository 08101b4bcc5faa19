from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from oracle import connect, difference

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return connect(str(DATA))


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    query = entry_points.queries()[name]
    assert difference(spark, str(DATA), query, entry_points.oracle_sql()[name], con) is None


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns and frame.count() > 0


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_insert_ignore_with_two_keys_is_serial(spark):
    """The query without SQL, against a row-by-row replay of the same rows."""
    lines = spark.read.parquet(str(DATA / "lineitem.parquet")).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice"
    )
    orders, pairs, want = set(), set(), []
    for row in sorted(map(tuple, lines.distinct().collect())):
        order, part, supplier, *_ = row
        if order not in orders and (part, supplier) not in pairs:
            want.append(row)
            orders.add(order)
            pairs.add((part, supplier))
    got = entry_points.queries()["insert_ignore_keys"](spark, str(DATA))
    assert sorted(map(tuple, got.collect())) == want
