"""Every named query against its SQL counterpart, on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry_points
from trustgauge.operators import linear

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def as_set(columns, rows):
    order = sorted(columns)
    places = [columns.index(c) for c in order]
    return order, sorted(repr(tuple(plain(row[p]) for p in places)) for row in rows)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    result = entry_points.queries()[name](spark, SMALL)
    got = as_set(result.columns, result.collect())
    cursor = duck.execute(entry_points.oracle_sql()[name])
    assert got == as_set([d[0] for d in cursor.description], cursor.fetchall())
    assert got[1]


def test_entry_has_a_stable_schema(spark):
    board = entry_points.entry(spark)
    assert {r["method"] for r in board.collect()} == {"raw", "temperature_scaling"}
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_every_fit_without_a_smooth_optimum_is_compared(spark):
    found = entry_points.queries()["training_beats_constant"](spark, SMALL)
    assert {r["model"] for r in found.collect()} == {"linear_svm_tfidf", "bootstrap_ensemble", "embedding_mlp"}


def test_vectors_are_summed_without_a_dense_copy(spark):
    plan = entry_points.queries()["vectors"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan


def test_rows_of_the_ensemble_are_written_once(spark, monkeypatch):
    calls, write = [], linear.sample_rows
    monkeypatch.setattr(linear, "sample_rows", lambda *a: calls.append(a) or write(*a))
    found = entry_points.queries()["ensemble_stationarity"](spark, SMALL)
    assert len(calls) == 1
    assert [r["stationary"] for r in found.collect()] == [True] * 5
