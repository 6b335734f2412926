"""Every registered query against its SQL on the smallest tables, and the entry points."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, FOLDER, entry.queries()[name], SQL[name]) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_is_the_flagship_query(spark):
    assert entry.entry(spark).columns == ["event_id", "section", "item", "special"]


def test_required_section_with_large_part_keys(spark, tmp_path):
    """A line of the next number comes first where part keys differ by more than a million."""
    lines = [(1, 1, 1_500_000, 7, "R"), (1, 2, 3, 8, "R"), (2, 1, 999_999, 9, "R"), (2, 2, 0, 10, "R"), (3, 1, 5, 11, "N")]
    schema = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string"
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = entry.queries()["required_section"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    assert {tuple(r) for r in got.collect()} == set(con.execute(SQL["required_section"]).fetchall()) == {(1, 8), (2, 9)}


def test_required_section_with_equal_keys_and_nulls(spark, tmp_path):
    """Of equal keys the line that is read first counts, whatever its supplier; lines with nulls do not count."""
    lines = [
        (1, 2, 5, 1, "R"), (1, 1, 5, 9, "R"), (1, 1, 5, 3, "R"), (2, None, 1, 7, "R"), (2, 1, 9, None, "R"), (2, 2, 1, 4, "R"),
        (3, 1, None, 5, "R"), (4, 1, 1, 2, "N"), (5, 1, 6, 2, "N"), (5, 1, 6, 8, "R"), (5, 1, 6, 4, "R"), (None, 1, 1, 1, "R"),
    ]
    schema = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string"
    spark.createDataFrame(lines, schema).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = entry.queries()["required_section"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute("SET threads = 1")
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    want = set(con.execute(SQL["required_section"]).fetchall())
    assert {tuple(r) for r in got.collect()} == want == {(1, 9), (2, 4), (3, None), (5, 8)}
