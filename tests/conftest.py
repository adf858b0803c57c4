from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_SF = "/root/testdata/sf0.001"
CHECK_SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import checkpoint_root, get_session

    s = get_session(app="strata-tests", master="local[*]", shuffle_partitions=8)
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE_SF


def rows_of(df, *cols):
    """Sorted list of tuples of the given columns (all columns if none given)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())


def same_rows(a, b) -> bool:
    """Multiset equality of two DataFrames with the same columns."""
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
