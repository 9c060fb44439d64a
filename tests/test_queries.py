"""Every query of the core runs on the smallest tables and equals its SQL twin."""

from __future__ import annotations

import math
import numbers
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from queuescope.plans import oracle, problems, reference

DATA = Path("/root/testdata/sf0.001")
CORE = {**reference.QUERIES, **problems.QUERIES}

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the tables are not here")


def plain(x):
    if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float) and math.isnan(x):
        return None
    if isinstance(x, numbers.Integral):
        return int(x)
    if isinstance(x, numbers.Real):
        return int(x) if x == int(x) else float(f"{x:.9g}")
    return str(x)


def rows(frame):
    ordered = frame[sorted(frame.columns)]
    return sorted((tuple(map(plain, r)) for r in ordered.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(CORE))
def test_query(spark, connection, name):
    got = CORE[name](spark, str(DATA)).toPandas()
    if name in oracle.SQL:
        want = connection.execute(oracle.SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_entry_and_registration(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(CORE) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
