"""Every registered query against its DuckDB statement (small scale factor):
row count, column names and an order-insensitive value hash must agree."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from forecourt.plans import catalog
from forecourt.sources.tables import TABLES
from tools.oracle_check import digest, norm

SF = "/root/testdata/sf0.001"
QUERIES = catalog.QUERIES  # the optional subpackage tests its own
ORACLE = catalog.ORACLE


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_oracle_is_independent():
    import inspect

    from forecourt.plans import duck_sql

    assert "from forecourt" not in inspect.getsource(duck_sql).replace("from __future__", "")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = [tuple(norm(r[c]) for c in cols) for r in sdf.collect()]
    rel = duck.execute(ORACLE[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(norm(r[i]) for i in idx) for r in rel.fetchall()]
    assert len(srows) == len(drows)
    assert digest(srows)[0] == digest(drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["month", "service_type_code"]
    assert df.count() > 0
