"""Pivot routing under a byte bound that would copy rows into many chunks: candidates in slices, no row copied."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import blocks
from tessera.operators import knn as N

from .test_search_paths import _brute, _frame


def _pairs(df, **kw):
    out = N.knn_pairs(df, df, N.KNNParams(k=3, exclude_self=True, block_rows=8, force_blocked=True, **kw.pop("params", {})), **kw)
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append((r["neighbor_id"], round(r["distance"], 6)))
    return out, got


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(21)
    x = rng.normal(size=(240, 6))
    x[40:60] = x[40]                                             # ties
    return x


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("default", [2000, 1 << 26])
def test_rows_are_not_copied_under_a_small_bound(spark, vectors, monkeypatch, default):
    monkeypatch.setattr(blocks, "DEFAULT_BROADCAST_BYTES", default)
    df = _frame(spark, vectors)
    out, got = _pairs(df, params={"pivots": 4, "broadcast_bytes": 1200, "aux_cols": ["name"]})
    assert got == _brute(vectors, vectors, 3, True)
    assert "CoGroup" not in _plan(out)                           # chunks of 8 rows, each met by some thirty others, before
    assert all(r["aux_name"] == f"name{r['neighbor_id']}" * 3 for r in out.collect())


def test_chunks_that_few_rows_are_copied_into_stay(spark, vectors):
    df = _frame(spark, vectors).drop("name")
    out, got = _pairs(df, params={"pivots": 4})
    assert got == _brute(vectors, vectors, 3, True) and "CoGroup" in _plan(out)


@pytest.mark.parametrize("dims,pivots,offset", [(2, 6, 1.7e9), (3, 5, 0.0)])
def test_pivots_that_rule_each_other_out(spark, dims, pivots, offset):
    rng = np.random.default_rng(22)
    x = offset + rng.uniform(0, 1000, size=(500, dims))
    df = _frame(spark, x).drop("name")
    for bound in (40 * (8 * dims + 64), 1 << 26):
        assert _pairs(df, params={"pivots": pivots, "broadcast_bytes": bound})[1] == _brute(x, x, 3, True)


def test_the_buffered_search_sees_the_same_pivots_either_way(spark, vectors):
    df = _frame(spark, vectors).drop("name")
    want = _pairs(df, tau=0.3, params={"pivots": 6, "exact": False})[1]
    out, got = _pairs(df, tau=0.3, params={"pivots": 6, "exact": False, "broadcast_bytes": 1200})
    assert got == want and got != _brute(vectors, vectors, 3, True)


def test_no_queries(spark, vectors):
    df = _frame(spark, vectors).drop("name")
    p = N.KNNParams(k=3, pivots=4, block_rows=8, broadcast_bytes=1200, force_blocked=True)
    assert N.knn_pairs(df.filter(F.col("id") < 0), df, p).count() == 0
