"""Every registered query against its SQL in another engine."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from weblytics.plans.oracle import all_oracles
from weblytics.plans.queries import all_queries


@pytest.fixture(scope="module")
def engine(sf_dir):
    connection = duckdb.connect()
    for name in os.listdir(sf_dir):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf_dir}/{name}'")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_each_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_sql(spark, sf_dir, engine, name):
    found = queries()[name](spark, sf_dir)
    expected = engine.execute(oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    rows = expected.fetchall()
    assert rows
    assert sorted(found.columns) == sorted(columns)
    assert canonical([tuple(r) for r in found.collect()], found.columns) == canonical(rows, columns)
    assert not any(isinstance(v, float) and math.isnan(v) for r in rows for v in r)


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows[0]["cnt"] >= rows[-1]["cnt"] > 0
