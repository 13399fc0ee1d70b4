"""Every registered query that has SQL gives the rows DuckDB gives for that SQL."""

import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as contract
from compare import canonical

FOLDER = Path("/root/testdata/sf0.001")
QUERIES, STATEMENTS = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    got = QUERIES[name](spark, str(FOLDER))
    ours = pd.DataFrame([tuple(r) for r in got.collect()], columns=got.columns, dtype=object)
    if name not in STATEMENTS:
        assert len(ours) > 0
        return
    cursor = duck.execute(STATEMENTS[name])
    theirs = pd.DataFrame(
        cursor.fetchall(), columns=[d[0] for d in cursor.description], dtype=object)
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)


def test_entry(spark):
    assert contract.entry(spark).count() == 10
