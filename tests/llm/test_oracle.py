"""Queries with a SQL form against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from strata.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMOKE_SF
from tools.check_oracle import digest, family


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SMOKE_SF}/{t}.parquet')")
    out = QUERIES[name](spark, SMOKE_SF)
    rows = [tuple(r) for r in out.collect()]
    twin = con.sql(ORACLE_SQL[name])
    assert sorted(out.columns) == sorted(twin.columns)
    kinds = {c: family(str(t)) for c, t in zip(twin.columns, twin.types, strict=True)}
    assert {f.name: family(f.dataType.simpleString()) for f in out.schema.fields} == kinds
    assert digest(out.columns, rows) == digest(list(twin.columns), twin.fetchall())
