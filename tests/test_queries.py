"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def as_text(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(as_text(row[c]) for c in columns) for row in df.collect())
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted(tuple(as_text(row[i]) for i in places) for row in result.fetchall())


def test_entry_known_answer(spark):
    row = entry.entry(spark).first()
    assert (row["feature"], row["split"]) == ("l_tax", 0.075)
    assert (row["l0"], row["l1"], row["r0"], row["r1"]) == (3805, 1833, 227, 135)
    assert abs(row["gain_ratio"] - 0.0013560769) < 1e-9
