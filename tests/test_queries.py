"""Every registered query against its SQL counterpart, and the shape of the plans."""

from __future__ import annotations

import glob
import os

import pytest

import __spark_entry__ as registry
from checks.oracle import ORACLE_SQL as ORACLES
from checks.queries import QUERIES

duckdb = pytest.importorskip("duckdb")

WITHOUT_ORACLE = {"classifier_metrics"}


@pytest.fixture(scope="module")
def tables(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        view = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{path}'")
    return connection


def normal(value):
    if value is None:
        return "null"
    return repr(float(value)) if isinstance(value, float) else str(value)


def test_registry_is_consistent():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_ORACLE and set(ORACLES) <= set(QUERIES)
    assert QUERIES.items() <= registry.queries().items() and ORACLES.items() <= registry.oracle_sql().items()


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_result_as_sql(spark, sf_dir, tables, key):
    df = QUERIES[key](spark, sf_dir)
    names = sorted(df.columns)
    found = sorted(tuple(normal(r[c]) for c in names) for r in df.collect())
    cursor = tables.execute(ORACLES[key])
    sql_names = [d[0] for d in cursor.description]
    assert sorted(sql_names) == names
    order = [sql_names.index(c) for c in names]
    expected = sorted(tuple(normal(row[i]) for i in order) for row in cursor.fetchall())
    assert found == expected
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "EvalPython" not in plan


def test_entry(spark):
    rows = registry.entry(spark).collect()
    assert len(rows) == 20 and rows[0].avg_risk_score >= rows[-1].avg_risk_score


def test_paths_of_the_summary(spark, sf_dir):
    assert {r.dataset for r in QUERIES["analysis_summary"](spark, sf_dir).collect()} == {
        "high_risk_transactions", "suspicious_cards", "geo_fraud_patterns"}


def test_classifier_reports_both_input_sets(spark, sf_dir):
    found = {(r.inputs, r.metric): r.value for r in QUERIES["classifier_metrics"](spark, sf_dir).collect()}
    assert len(found) == 10 and found[("all inputs", "roc_auc")] > 0.9
    assert all(0.0 <= v <= 1.0 for v in found.values())
