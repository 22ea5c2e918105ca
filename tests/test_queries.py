"""All registered queries against their SQL checks."""

import math

import duckdb
import pytest
from conftest import SF

from worktide.catalog import all_oracles, all_queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = sorted(all_oracles())


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return round(float(value), 9) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


def comparable(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = all_queries()[name](spark, SF)
    got = comparable(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(all_oracles()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == comparable(columns, result.fetchall())


def test_every_check_belongs_to_a_query():
    assert set(all_oracles()) <= set(all_queries())
