"""Invariants and brute-force comparisons for the iterative / approximate operators."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import dbscan as D
from tessera.operators import fm as FM
from tessera.operators import knn as N
from tessera.operators import louvain as L
from tessera.operators import patterns as Q
from tessera.operators import recommend as R
from tessera.plans import inputs as I

SMALL = "/root/testdata/sf0.001"


def _brute_dbscan(pts, eps, min_pts):
    ids = [p[0] for p in pts]
    xy = np.array([[p[1], p[2]] for p in pts])
    d = np.sqrt(((xy[:, None, :] - xy[None, :, :]) ** 2).sum(-1))
    nb = d <= eps
    core = nb.sum(1) >= min_pts
    n = len(pts)
    label = [None] * n
    for i in sorted(range(n), key=lambda i: ids[i]):
        if not core[i] or label[i] is not None:
            continue
        stack, comp = [i], []
        label[i] = -1
        while stack:
            j = stack.pop()
            comp.append(j)
            for k in np.nonzero(nb[j] & core)[0]:
                if label[k] is None:
                    label[k] = -1
                    stack.append(k)
        cid = min(ids[j] for j in comp)
        for j in comp:
            label[j] = cid
    out = {}
    for i in range(n):
        if core[i]:
            out[ids[i]] = ("core", label[i])
        else:
            cands = [(round(d[i, j], 9), label[j]) for j in range(n) if core[j] and nb[i, j]]
            out[ids[i]] = ("border", min(cands)[1]) if cands else ("noise", None)
    return out


@pytest.mark.parametrize("block_rows", [2048, 4])
def test_dbscan_matches_brute_force(spark, block_rows):
    pts = I.points(spark, SMALL)
    rows = [tuple(r) for r in pts.collect()]
    for eps, mp in [(0.03, 5), (0.05, 4)]:
        want = _brute_dbscan(rows, eps, mp)
        got = {r["id"]: (r["flag"], r["cluster"]) for r in D.dbscan(pts, eps, mp, block_rows=block_rows).collect()}
        assert got == want


def test_dbscan_one_row_per_point_with_duplicates(spark):
    df = spark.createDataFrame([(i, 0.0, 0.0) for i in range(6)] + [(10, 5.0, 5.0)], "id long, x double, y double")
    out = D.dbscan(df, 0.1, 3).collect()
    assert len(out) == 7 and len({r["id"] for r in out}) == 7
    assert {r["id"]: r["flag"] for r in out}[10] == "noise"


def test_even_split_invariants(spark):
    pts = I.points(spark, "/root/testdata/sf0.01")
    regions = D.even_split(pts, 0.03, 100).collect()
    assert sum(r["n"] for r in regions) == pts.count()
    for r in regions:
        assert r["n"] > 0
        wide = (r["x2"] - r["x1"]) / 0.06 > 2 + 1e-9 or (r["y2"] - r["y1"]) / 0.06 > 2 + 1e-9
        assert r["n"] <= 100 or not wide


def test_knn_blocked_equals_broadcast_and_approx_recall(spark):
    pts = I.points(spark, "/root/testdata/sf0.01").select("id", F.array("x", "y").alias("features"))
    exact = N.knn_pairs(pts, pts, N.KNNParams(k=5, exclude_self=True))
    blocked = N.knn_pairs(pts, pts, N.KNNParams(k=5, exclude_self=True, pivots=16, block_rows=64,
                                                  force_blocked=True))
    key = lambda df: sorted((r["id"], r["neighbor_id"], round(r["distance"], 9)) for r in df.collect())
    assert key(exact) == key(blocked)
    approx = N.knn_pairs(pts, pts, N.KNNParams(k=5, exclude_self=True, pivots=16, exact=False, block_rows=64,
                                                 force_blocked=True), tau=0.02)
    e = {(r["id"], r["neighbor_id"]) for r in exact.collect()}
    a = {(r["id"], r["neighbor_id"]) for r in approx.collect()}
    assert len(e & a) / len(e) > 0.8


def test_knn_radius_removes_all_gives_null_prediction(spark):
    v = I.vectors(spark, SMALL)
    out = N.knn_regress(v.select("id", "features"), v, N.KNNParams(k=3, exclude_self=True, max_distance=1e-6))
    assert out.filter(F.col("prediction").isNotNull()).count() == 0
    j = N.knn_join(v.select("id", "features"), v, N.KNNParams(k=3, exclude_self=True, max_distance=1e-6))
    assert j.filter(F.size("neighbors") > 0).count() == 0 and j.count() == v.count()


def test_recommend_quota_never_below_one(spark):
    f = I.vectors(spark, SMALL).select("id", F.col("features").cast("array<float>").alias("features"))
    out = R.recommend_for_all(f, f, 1, approximate=True, block_size=8)
    assert out.groupBy("src").count().filter("count != 1").count() == 0


def test_louvain_compression_keeps_weight_and_modularity(spark):
    g = I.knn_graph(spark, SMALL).select("src", "dst", F.lit(1).cast("long").alias("weight"))
    v = I.graph_vertices(spark, SMALL)
    st, e = L.initial_state(v, g)
    m = L.total_weight(st)
    q, st1, _ = L.louvain_level(st, e, 1, 1)
    qu = L.modularity(st1, e, m, clipped=False)
    st2, e2 = L.compress(st1, e)
    assert L.total_weight(st2) == m
    # on the compressed graph every community is one vertex
    assert L.modularity(st2, e2, m, clipped=False) == pytest.approx(qu, abs=1e-12)


def test_fm_training_lowers_loss(spark):
    rows = I.regression_rows(spark, SMALL).select("label", F.array("x0", "x1", "x2", "x3").alias("features"))
    h1, h2 = [], []
    FM.train_sgd(rows, task=1, iterations=10, step=0.5, history=h1)
    assert h1[-1][1] < h1[0][1]
    FM.train_lbfgs(rows, task=1, iterations=5, history=h2)
    assert h2[-1][1] < h2[0][1]


def test_fm_save_load_round_trip(spark, tmp_path):
    m = FM.init_model(4, 3, 0, seed=4, min_target=0.0, max_target=2.0)
    FM.save_model(spark, m, str(tmp_path / "fm"))
    back = FM.load_model(spark, str(tmp_path / "fm"))
    assert np.allclose(back.v, m.v) and back.task == 0 and back.max_target == 2.0


def test_frequent_itemsets_brute_force(spark):
    b = I.baskets(spark, SMALL)
    baskets = [set(r["items"]) for r in b.collect()]
    min_count = 8
    counts = {}
    for s in baskets:
        for k in (1, 2, 3, 4):
            for c in itertools.combinations(sorted(s), k):
                counts[c] = counts.get(c, 0) + 1
    want = {c: n for c, n in counts.items() if n >= min_count}
    got = {tuple(r["items"]): r["freq"] for r in Q.frequent_itemsets(b, min_count).collect()}
    assert got == want


def test_dbscan_far_coordinates(spark):
    """Cells whose numbers exceed 32 bits keep apart, and epoch-sized coordinates do not overflow."""
    from tessera.operators.dbscan import dbscan
    far = [(1, 0.0, 0.0), (2, 0.0, 1.5e9), (3, 0.0, -1.5e9), (4, 0.35, 1.5e9 * 1.0001),
           (5, 1.7e9, 1.7e9), (6, 1.7e9 + 0.25, 1.7e9), (7, 1.7e9 + 0.5, 1.7e9)]
    got = {r["id"]: (r["flag"], r["cluster"]) for r in
           dbscan(spark.createDataFrame(far, "id long, x double, y double"), 0.5, 2).collect()}
    assert all(got[i] == ("noise", None) for i in (1, 2, 3, 4))
    assert all(got[i] == ("core", 5) for i in (5, 6, 7))


def test_shortest_paths_zero_and_negative_weights(spark):
    import pytest
    from tessera.operators.graph import shortest_paths
    v = spark.createDataFrame([(i,) for i in range(1, 6)], "id long")
    e = spark.createDataFrame([(5, 2, 1.0), (5, 3, 1.0), (2, 3, 0.0), (3, 2, 0.0), (3, 4, 0.0), (4, 3, 0.0)],
                              "src long, dst long, weight double")
    got = {r["id"]: (r["distance"], r["predecessor"]) for r in shortest_paths(v, e, 5).collect()}
    assert got == {1: (None, None), 2: (1.0, 5), 3: (1.0, 5), 4: (1.0, 3), 5: (0.0, None)}
    with pytest.raises(ValueError):
        shortest_paths(v, spark.createDataFrame([(1, 2, -1.0)], "src long, dst long, weight double"), 1)


def test_precision_leaves_rows_without_score(spark):
    from tessera.operators.evaluate import precision_by_threshold
    df = spark.createDataFrame([(0.5, 1.0), (None, 1.0), (0.2, 0.0)], "score double, label double")
    got = {r["threshold"]: (r["predicted"], r["precision"]) for r in precision_by_threshold(df).collect()}
    assert got == {0.5: (1, 1.0), 0.2: (2, 0.5)}


def test_fm_model_keeps_its_switches(spark, tmp_path):
    import numpy as np
    from tessera.operators import fm
    m = fm.FMModel(1.0, np.ones(3), np.ones((3, 2)), 1, use_bias=False, use_linear=False)
    fm.save_model(spark, m, str(tmp_path / "m"))
    r = fm.load_model(spark, str(tmp_path / "m"))
    assert (r.use_bias, r.use_linear, r.min_target, r.max_target) == (False, False, m.min_target, m.max_target)


def test_folder_label_with_blank(spark, tmp_path):
    from tessera.sources.files import read_labelled_by_folder
    d = tmp_path / "a b+c"
    d.mkdir()
    (d / "x.txt").write_text("hello")
    for binary in (False, True):
        assert [r["label"] for r in read_labelled_by_folder(spark, str(tmp_path), binary).collect()] == ["a b+c"]
