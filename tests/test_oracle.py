"""Every registered query against its SQL twin in DuckDB (sf0.001).

The driver runs the same comparison at sf0.01 (``tools/check_oracle.py``
reproduces it locally).
"""

from __future__ import annotations

import os

import duckdb
import pytest

from tools.check_oracle import digest, family

from __spark_entry__ import entry, oracle_sql, queries
from strata.plans.queries import QUERIES
from strata.sources.testdata import TABLES

from .conftest import SMOKE_SF

QUERY_NAMES = sorted(QUERIES)  # the optional operators have tests of their own


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SMOKE_SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERY_NAMES) <= set(oracle_sql()) <= set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["entity_id", "scoring_class", "is_active", "start_season", "end_season", "current_season"]
    assert df.count() > 0


@pytest.mark.parametrize("name", QUERY_NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = queries()[name](spark, SMOKE_SF)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    stypes = {f.name: family(f.dataType.simpleString()) for f in sdf.schema.fields}
    otypes = {c: family(str(t)) for c, t in zip(rel.columns, rel.types, strict=True)}
    assert stypes == otypes
    assert len(srows) == len(orows)
    assert digest(sdf.columns, srows) == digest(list(rel.columns), orows)
