"""Pivot routing and leaves: exact everywhere, and little work where the data can be told apart."""

import numpy as np
import pytest

from tessera.operators import blocks
from tessera.operators import knn as N

from .test_search_paths import _brute, _frame

OPTS = dict(k=4, metric="l2", exclude_self=True, max_distance=None, min_positive=False)


def _both(x, q, qids, bound=None, leaf=30, **kw):
    opts, ids = {**OPTS, **kw}, np.arange(len(x))
    pivot = x[0]
    pd_ = blocks._distances(x, pivot[None, :])[:, 0]
    got = blocks._score_rings(q, qids, x, ids, pivot, pd_, leaf, opts, *([bound] if bound is not None else []))
    want = blocks._score_block(q, qids, x, ids, **opts)
    return got, want


@pytest.mark.parametrize("dims", [1, 2, 3, 12, 40])
@pytest.mark.parametrize("offset", [0.0, 1.7e9])
def test_leaves_find_what_a_full_search_finds(dims, offset):
    rng = np.random.default_rng(dims)
    x = offset + rng.normal(size=(3000, dims)) * 100
    x[:200] = x[0]                                               # copies
    x[200:600] = np.round(x[200:600], -1)                        # ties
    x[600:900] += 5000                                           # far from the rest
    q = np.r_[x[::7], offset + rng.normal(size=(50, dims)) * 3000]
    qids = np.r_[np.arange(3000)[::7], np.arange(9000, 9050)]
    for kw in ({}, {"max_distance": 40.0}, {"min_positive": True}, {"exclude_self": False}, {"k": 60}):
        got, want = _both(x, q, qids, **kw)
        assert all((a == b).all() for a, b in zip(got, want))


def test_rows_without_a_number_hide_no_others():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 2))
    x[::50, 0] = np.nan
    got, want = _both(x, x[:300], np.arange(300))
    assert all((a == b).all() for a, b in zip(got, want))


def test_leaves_look_at_few_pairs(monkeypatch):
    pairs, original = [], blocks.Search._tile

    def counted(self, rows, at, *rest):
        pairs.append(len(rows) * len(at))
        return original(self, rows, at, *rest)

    monkeypatch.setattr(blocks.Search, "_tile", counted)
    rng = np.random.default_rng(2)
    x = 1.7e9 + rng.uniform(0, 1000, size=(20_000, 2))
    opts, ids = OPTS, np.arange(20_000)
    pd_ = blocks._distances(x, x[:1])[:, 0]
    blocks._score_rings(x[:4000], ids[:4000], x, ids, x[0], pd_, 30, opts)
    assert sum(pairs) < 0.05 * 4000 * 20_000                     # rings alone: about a third


def test_few_pivots_are_visited_where_candidates_bound_the_distance():
    rng = np.random.default_rng(3)
    x = 1.7e9 + rng.uniform(0, 1000, size=(40_000, 2))
    tree = blocks.PivotTree(x[:16])
    at, dist = tree.nearest(x)
    count = np.bincount(at, minlength=16)
    radius = np.array([dist[at == j].max() for j in range(16)])
    rows, pids, bound = blocks._visits(x[:2000], np.arange(2000), tree, (count, radius), (x[:4096], np.arange(4096)), OPTS, None)
    d = blocks._distances(x[:2000], x)
    d[np.arange(2000), np.arange(2000)] = np.inf
    kth = np.sort(d, axis=1)[:, 3]
    assert (bound >= kth).all() and len(rows) < 2 * 2000         # by balls around the pivots alone: more than ten a row
    seen = set(zip(rows.tolist(), pids.tolist()))
    near = np.argwhere(d <= kth[:, None])
    assert all((int(a), int(at[b])) in seen for a, b in near)    # the pivots of all of the best are visited


@pytest.mark.parametrize("dims,pivots", [(2, 16), (2, 60), (5, 8)])
def test_routed_search_with_copies_and_equal_pivots(spark, dims, pivots):
    rng = np.random.default_rng(5)
    x = 1.7e9 + np.round(rng.normal(size=(400, dims)) * 3, 0) * 100   # many copies, so pivots fall on one another
    df = _frame(spark, x).drop("name")
    p = N.KNNParams(k=3, exclude_self=True, pivots=pivots, block_rows=40, force_blocked=True, sub_tree_leaf_size=8)
    got = {}
    for r in sorted(N.knn_pairs(df, df, p).collect(), key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append((r["neighbor_id"], round(r["distance"], 6)))
    assert got == _brute(x, x, 3, True)
