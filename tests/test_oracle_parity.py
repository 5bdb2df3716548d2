"""Every query with an oracle equals its DuckDB SQL at sf0.001 (rows, columns, exact values)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from driver_data import SF001
from riskmart import registry
from riskmart.oracle import reports_sql

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
# the library's own queries; the training-data operators have their tests beside them
LIBRARY = set(registry.queries())
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in LIBRARY}
QUERIES = {k: v for k, v in entry.queries().items() if k in LIBRARY}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    yield c
    c.close()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v.isoformat() if hasattr(v, "isoformat") else repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_is_registered_with_an_oracle_or_is_ml():
    missing = set(QUERIES) - set(ORACLE)
    assert missing <= {"model_metrics", "ml_linear_attribution", "ml_alert_metrics", "feature_importance",
                       "ml_batch_scores"}
    assert len(ORACLE) >= 56


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    s_cols, s_rows = df.columns, df.collect()
    rel = con.execute(ORACLE[name])
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)


ORDERED = [n for n, sql in reports_sql.REPORTS.items() if "ORDER BY" in sql.rpartition(")")[2]]


@pytest.mark.parametrize("name", ORDERED)
def test_report_rows_come_in_order(spark, con, name):
    df = QUERIES[name](spark, SF001)
    rel = con.execute(ORACLE[name])
    d_cols = [d[0] for d in rel.description]
    assert [tuple(_norm(r[c]) for c in d_cols) for r in df.collect()] == [
        tuple(_norm(v) for v in r) for r in rel.fetchall()]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "credit_score" in df.columns
