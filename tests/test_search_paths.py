"""The three ways of top-k search against plain numpy: slices, pivots anywhere in space, quotas, carried columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import blocks
from tessera.operators import knn as N
from tessera.operators import recommend as R


def _frame(spark, x, start=0):
    return spark.createDataFrame([(start + i, [float(a) for a in v], f"name{i}" * 3) for i, v in enumerate(x)], "id long, features array<double>, name string")


def _brute(x, y, k, exclude, first=0):
    d = np.sqrt(((x[:, None, :] - y[None, :, :]) ** 2).sum(-1))
    out = {}
    for i in range(len(x)):
        order = sorted((j for j in range(len(y)) if not exclude or i != j), key=lambda j: (round(d[i, j], 9), first + j))[:k]
        out[i] = [(first + j, round(float(d[i, j]), 6)) for j in order]
    return out


def _got(df, value="distance"):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["qid"], r["rank"])):
        out.setdefault(r["qid"], []).append((r["tid"], round(r[value], 6)))
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 6))
    x[40:60] = x[40]  # ties
    return x


@pytest.mark.parametrize("bound", [1000, 5000, 1 << 26])
def test_slices_match_brute_force_and_carry_columns(spark, vectors, bound):
    df = _frame(spark, vectors)
    out = blocks.top_k(df, df, 4, aux=["name"], exclude_self=True, broadcast_bytes=bound)
    assert _got(out) == _brute(vectors, vectors, 4, True)
    assert all(r["aux_name"] == f"name{r['tid']}" * 3 for r in out.collect())


def test_the_query_side_is_not_shuffled(spark, vectors):
    df = _frame(spark, vectors)
    for metric in ("l2", "dot"):
        plan = blocks.top_k(df, df, 4, metric=metric, broadcast_bytes=2000)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan and "MapInPandas" in plan


def test_carried_columns_count_towards_the_bound(spark, vectors):
    df = _frame(spark, vectors).withColumn("name", F.repeat("name", 1000))
    c = df.select(F.col("id").alias("_tid"), F.col("features").alias("_tv"))
    assert blocks._collect_if_small(c, 200_000) is not None
    assert blocks._collect_if_small(c.withColumn("aux_name", F.repeat(F.lit("x"), 20_000)), 200_000) is None


def test_inner_product_by_slices(spark, vectors):
    df = _frame(spark, vectors)
    want = vectors @ vectors.T
    got = _got(blocks.top_k(df, df, 3, metric="dot", broadcast_bytes=1500), "score")
    for i in range(len(vectors)):
        order = sorted(range(len(vectors)), key=lambda j: (-round(want[i, j], 9), j))[:3]
        assert [t for t, _ in got[i]] == order


@pytest.mark.parametrize("bound", [900, 1 << 26])
def test_quota_blocks_by_id_order(spark, vectors, bound):
    df = _frame(spark, vectors, 1000).withColumn("id", F.col("id") * 64)  # all ids fall on one remainder
    got = {(r["src"], r["dst"]) for r in R.recommend_for_all(df, df, 5, approximate=True, block_size=30, broadcast_bytes=bound).collect()}
    want = vectors @ vectors.T
    for i in range(len(vectors)):
        kept = []
        for a in range(0, 120, 30):
            kept += sorted(range(a, a + 30), key=lambda j: (-round(want[i, j], 9), j))[:2]  # ceil(5 * 30 / 120)
        best = sorted(kept, key=lambda j: (-round(want[i, j], 9), j))[:5]
        assert {((1000 + i) * 64, (1000 + j) * 64) for j in best} == {p for p in got if p[0] == (1000 + i) * 64}


@pytest.mark.parametrize("offset", [0.0, 1e8, 1.7e9, 1e12])
@pytest.mark.parametrize("pivots", [16, 90])
def test_pivot_routing_far_from_the_origin(spark, offset, pivots):
    rng = np.random.default_rng(4)
    x = offset + rng.normal(size=(300, 2)) * (1.0 if offset < 1e11 else 1000.0)
    df = _frame(spark, x).drop("name")
    p = N.KNNParams(k=3, exclude_self=True, pivots=pivots, block_rows=40, force_blocked=True)
    got = {}
    for r in sorted(N.knn_pairs(df, df, p).collect(), key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append((r["neighbor_id"], round(r["distance"], 6)))
    assert got == _brute(x, x, 3, True)


def test_pivot_tree_rules_out_most_pivots():
    rng = np.random.default_rng(6)
    x = 1.7e9 + rng.uniform(0, 1000, size=(2000, 2))
    tree = blocks.PivotTree(x[:1500])
    at, dist = tree.nearest(x)
    d = blocks._distances(x, tree.pivots)
    assert (at == d.argmin(axis=1)).all() and (dist == d.min(axis=1)).all()
    count, radius = np.ones(1500, int), np.full(1500, 5.0)
    bound = tree.kth_bound(x, count, radius, 3, at)
    assert (bound >= np.sort(d, axis=1)[:, 2]).all()
    rows, pivots = tree.within(x, bound, radius, count)
    seen = set(zip(rows.tolist(), pivots.tolist()))
    need = np.argwhere(d - 5.0 <= bound[:, None])
    assert all((int(a), int(b)) in seen for a, b in need)
    assert len(rows) < 0.05 * d.size


def test_empty_sides(spark, vectors):
    df = _frame(spark, vectors)
    for kw in ({}, {"force_blocked": True}, {"force_blocked": True, "pivots": 4}):
        assert blocks.top_k(df, df.limit(0), 3, **kw).count() == 0
        assert blocks.top_k(df.limit(0), df, 3, **kw).count() == 0
    assert R.recommend_for_all(df, df.limit(0), 3, approximate=True).count() == 0


def test_scoring_holds_no_matrix_of_all_pairs():
    import tracemalloc
    rng = np.random.default_rng(8)
    x, ids = rng.normal(size=(20_000, 3)), np.arange(20_000)
    opts = dict(k=3, exclude_self=True, max_distance=None, min_positive=False)
    for metric, quota in (("l2", {}), ("dot", {}), ("dot", {"quota": (ids // 64, 3, 20_000)})):
        tracemalloc.start()
        r, ci, v = blocks._score_block(x[:2000], ids[:2000], x, ids, metric=metric, **quota, **opts)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(r) == 6000 and peak < 150e6   # the matrix alone has 320 MB
    pivot = x.mean(0)
    pd_ = np.sqrt(((x - pivot) ** 2).sum(1))
    got = blocks._score_rings(x[:2000], ids[:2000], x, ids, pivot, pd_, 30, dict(opts, metric="l2"))
    want = blocks._score_block(x[:2000], ids[:2000], x, ids, metric="l2", **opts)
    assert all((a == b).all() for a, b in zip(got, want))


def test_rows_are_copied_into_few_groups_of_a_pivot():
    most = 58_000
    for rows in (1_000, 12_800, 100_000):
        assert blocks._chunks(rows, 2, 128, most) <= 2
        assert blocks._chunks(rows, 16, 128, most) <= 16
    assert blocks._chunks(1_000_000, 2, 128, most) == 18   # the byte bound goes first
    assert blocks._chunks(100, 2, 128, most) == 1
