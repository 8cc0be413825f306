"""Every registered query vs its DuckDB oracle on the smallest driver scale (sf0.001)."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from trolley import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["part", "orders", "lineitem"]

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame, cols: list[str]) -> list[tuple]:
    return sorted((tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


KEYS = set(catalog.registry())
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in KEYS}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    got = E.queries()[key](spark, SF).toPandas()
    want = con.sql(ORACLE[key]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got, cols) == _rows(want, cols)


def test_every_key_has_oracle_or_is_documented():
    rows_only = KEYS - set(ORACLE)
    assert rows_only == set()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["department_name", "item_count", "reorder_count"]
    assert df.count() > 0
