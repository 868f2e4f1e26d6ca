"""Queries with an SQL twin against DuckDB, and that all of them are registered."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from forecourt.llm.queries import ORACLE, QUERIES
from tools.oracle_check import digest, norm

SF = "/root/testdata/sf0.001"


def test_registered():
    names = E.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(ORACLE) <= set(QUERIES) <= set(names)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = QUERIES[name](spark, SF)
    cols = sorted(sdf.columns)
    rows = [tuple(norm(r[c]) for c in cols) for r in sdf.collect()]
    rel = con.execute(ORACLE[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    assert digest(rows) == digest([tuple(norm(r[names.index(c)]) for c in cols) for r in rel.fetchall()])
