"""exact_quantile equals DuckDB's quantile_cont on random, tied and tiny inputs, in both code paths."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trolley.functions.quantiles import exact_quantile, exact_quantiles


def _duck(vals, p):
    con = duckdb.connect()
    con.register("t", pd.DataFrame({"x": pd.Series(vals, dtype="float64")}))
    return con.sql(f"SELECT quantile_cont(x, {p}) FROM t").fetchall()[0][0]


@settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=st.lists(st.integers(0, 40).map(lambda i: i / 8), min_size=1, max_size=400),
       p=st.sampled_from([0.1, 0.25, 0.5, 0.75, 0.9]),
       accuracy=st.sampled_from([20, 100_000]))
def test_matches_duckdb(spark, vals, p, accuracy):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got, want = exact_quantile(df, "x", p, accuracy=accuracy).first()[0], _duck(vals, p)
    if p == 0.5:
        assert got == want  # medians: interpolation by 0.5 is exact in both engines
    else:
        assert got == pytest.approx(want, rel=1e-12, abs=1e-15)  # DuckDB fuses the multiply-add


def test_hot_value_and_empty(spark):
    vals = [7.0] * 3000 + [float(i) for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for p in (0.1, 0.5, 0.9):
        assert exact_quantile(df, "x", p, accuracy=100).first()[0] == _duck(vals, p)
    empty = spark.createDataFrame([], "x double")
    assert exact_quantile(empty, "x", 0.5).first()[0] is None


def test_many_quantiles_in_one_query(spark):
    # more scalar subqueries than the subquery thread pool (16): must not deadlock (no nesting)
    vals = [float(i % 97) for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    ps = [i / 25 for i in range(1, 25)]
    cols = [exact_quantile(df, "x", p, accuracy=50).scalar().alias(f"q{i}") for i, p in enumerate(ps)]
    got = list(spark.range(1).select(*cols).first())
    assert got == [_duck(vals, p) for p in ps]


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=st.lists(st.one_of(st.none(), st.integers(0, 60).map(lambda i: i / 4)), min_size=1, max_size=300),
       b=st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float)), min_size=1, max_size=300),
       accuracy=st.sampled_from([20, 10_000]), pick_rows=st.sampled_from([5, 1_000_000]))
def test_columns_together_equal_duckdb(spark, a, b, accuracy, pick_rows):
    n = max(len(a), len(b))
    rows = [(x, y) for x, y in zip(a + [None] * (n - len(a)), b + [None] * (n - len(b)))]
    df = spark.createDataFrame(rows, "a double, b double")
    ps = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, {"a": ps, "b": [0.5, 0.75]}, accuracy=accuracy, pick_rows=pick_rows)
    assert len(got) == 7
    for (c, p), v in got.items():
        want = _duck([r["ab".index(c)] for r in rows], p)
        assert v is None if want is None or want != want else v == pytest.approx(want, rel=1e-12, abs=1e-15)


def test_columns_together_narrow_a_large_table(spark):
    df = spark.range(200_000).selectExpr("(id * 7919) % 200000 AS a", "CAST(id % 11 AS DOUBLE) AS hot", "CAST(NULL AS INT) AS nothing")
    got = exact_quantiles(df, {"a": [0.25, 0.5], "hot": [0.5], "nothing": [0.5]}, accuracy=100, pick_rows=500)
    assert got == {("a", 0.25): 49_999.75, ("a", 0.5): 99_999.5, ("hot", 0.5): 5.0, ("nothing", 0.5): None}
