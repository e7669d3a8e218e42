"""Every registered query against its SQL oracle (DuckDB), as the driver's gate does."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_ORACLE, SF_SMALL

TABLES = "region nation customer supplier part orders lineitem".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


def _oracle(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def con_small():
    return _oracle(SF_SMALL)


# The tables' own queries; those of optional subpackages are tested with them.
OWN = sorted(n[2:] for n in vars(E) if n.startswith("q_"))


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle_sf0001(spark, con_small, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    res = con_small.sql(E.oracle_sql()[name])
    orows, ocols = res.fetchall(), res.columns
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(rows, cols) == _digest(orows, ocols)


@pytest.mark.parametrize("name", ["gold_sales_by_region", "gold_top_products", "dataset_summary_metrics",
                                  "silver_metrics", "full_refresh"])
def test_fixture_numbers_sf001(spark, name):
    con = _oracle(SF_ORACLE)
    df = E.queries()[name](spark, SF_ORACLE)
    res = con.sql(E.oracle_sql()[name])
    assert _digest([tuple(r) for r in df.collect()], df.columns) == _digest(res.fetchall(), res.columns)


def test_expected_counts_sf001(spark):
    m = E.queries()["silver_metrics"](spark, SF_ORACLE).first().asDict()
    assert m == {"bronze_rows": 60000, "duplicates": 14212, "quality_drops": 2800, "silver_rows": 42988}
    s = E.queries()["dataset_summary_metrics"](spark, SF_ORACLE).first()
    assert (s["total_revenue"], s["total_orders"], s["avg_order_value"]) == (18647420204.06, 14148, 1314762.66)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["region", "year_month", "total_revenue", "order_count", "avg_order_value",
                          "unique_customers"]
    assert df.count() > 0
