"""The driver contract, and oracle agreement on a fast subset at sf0.01."""

import datetime as dt
import decimal

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from medallion_ops.plans.catalog import QUERIES
from medallion_ops.sources.tables import TABLES

from .conftest import SF_ORACLE, SF_SMALL


def test_entry_runs_on_sf0001(spark):
    df = entry(spark)
    assert df.columns == ["month", "product_revenue"]
    assert df.count() > 0


def test_every_key_has_an_oracle():
    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(o)


def _norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return "NULL" if v is None else str(v)


def _sorted_rows(cols, records):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in idx) for r in records)


def _duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def duck():
    return _duck(SF_ORACLE)


@pytest.fixture(scope="module")
def duck_small():
    return _duck(SF_SMALL)


FAST_KEYS = ["silver_order_items", "dedup_latest", "dense_surrogate_key", "payments_collapsed",
             "payments_with_total", "silver_reviews", "dq_report", "quarantine_split", "dim_date",
             "window_ratio_to_max", "upsert_merge", "orphan_anti_join", "fn_date_parts"]


@pytest.mark.parametrize("key", FAST_KEYS)
def test_oracle_agrees(spark, duck, key):
    sdf = queries()[key](spark, SF_ORACLE)
    res = duck.execute(oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    assert _sorted_rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _sorted_rows(ocols, res.fetchall())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_every_key_agrees_with_its_oracle_at_sf0001(spark, duck_small, key):
    sdf = queries()[key](spark, SF_SMALL)
    # every query reads files: the given tables or stages Spark derived from them
    plan = sdf._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan or "Scan parquet" in plan or "Scan csv" in plan, key
    res = duck_small.execute(oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    assert _sorted_rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _sorted_rows(ocols, res.fetchall())
