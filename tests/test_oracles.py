"""Every query with an oracle equals it on the smallest tables, by rows, columns and values."""

from __future__ import annotations

import math

import duckdb
import pytest

from ledgerspark.queries import ORACLES, QUERIES
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(x):
    if isinstance(x, bool) or x is None or isinstance(x, str):
        return x
    return None if isinstance(x, float) and math.isnan(x) else float(x)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    found = QUERIES[name](spark, SF)
    wanted = duck.execute(ORACLES[name])
    columns = [d[0] for d in wanted.description]
    assert sorted(found.columns) == sorted(columns)
    key = lambda row: tuple((v is None, str(v)) for v in row)
    a = sorted((tuple(plain(v) for v in r) for r in found.select(columns).collect()), key=key)
    b = sorted((tuple(plain(v) for v in r) for r in wanted.fetchall()), key=key)
    assert a == b


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
