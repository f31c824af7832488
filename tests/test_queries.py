"""Every query with a SQL counterpart against it, on the smallest tables."""

import datetime
import math
import os

import pytest

from tidecast.plans.oracles import ORACLES
from tidecast.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def sql():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def test_counterparts_name_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sql, name):
    result = QUERIES[name](spark, FOLDER)
    answer = sql.execute(ORACLES[name])
    names = [c[0] for c in answer.description]
    assert sorted(result.columns) == sorted(names)
    order = sorted(names)
    found = sorted(tuple(plain(r[c]) for c in order) for r in result.collect())
    places = [names.index(c) for c in order]
    expected = sorted(tuple(plain(r[i]) for i in places) for r in answer.fetchall())
    assert found == expected
