"""Every registered query against its SQL, on the whole tables of one scale."""

import os
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as contract  # noqa: E402
from bytesift.queries import ORACLES, QUERIES  # noqa: E402

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")
# The tables of the driver contract.
TABLES = """region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations""".split()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in con.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = [tuple(r[i] for i in order) for r in con.fetchall()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 40 and sum(r.n_matches for r in rows) > 0
