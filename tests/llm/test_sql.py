"""Queries of the subpackage with a SQL counterpart, on the smallest tables."""

import os

import pytest

from llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    result = QUERIES[name](spark, FOLDER)
    answer = connection.execute(ORACLES[name])
    names = [c[0] for c in answer.description]
    assert sorted(result.columns) == sorted(names)
    found = sorted((tuple(r) for r in result.select(names).collect()), key=repr)
    assert found == sorted(answer.fetchall(), key=repr)


def test_every_operator_has_its_query():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
