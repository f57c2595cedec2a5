"""Every registered query against its SQL oracle."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def test_tables_are_there():
    assert Path(FOLDER).is_dir(), "without the test tables no oracle is tested"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "-"
    return repr(float(value)) if isinstance(value, float) else str(value)


def as_rows(records):
    return sorted(tuple(map(plain, r)) for r in records)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = entry_point.queries()[name](spark, FOLDER)
    want = duck.execute(entry_point.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert as_rows(got.select(*[f"`{c}`" for c in columns]).collect()) == as_rows(want.fetchall())


def test_entry_has_rows(spark):
    frame = entry_point.entry(spark)
    assert frame.columns == ["word", "n"] and frame.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
