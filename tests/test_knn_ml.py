"""The estimator surface: Vector columns, tree sizes that set the plan, tau search, persistence inside a Pipeline."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.operators import blocks
from tessera.operators import knn as N
from tessera.operators.knn_ml import KNN, KNNClassificationModel, KNNClassifier, KNNModel, KNNRegression


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 3))
    rows = [(i, *[float(a) for a in v], float(i % 3), float(i % 4)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label double, w double")


def _vec(df):
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


def _arr(df):
    return df.withColumn("features", F.array("a", "b", "c"))


def _ids(df):
    return {r["id"]: ([n["id"] for n in r["neighbors"]], [round(d, 9) for d in r["distances"]]) for r in df.collect()}


def test_vectors_and_arrays_agree_on_every_path(table):
    want = _ids(KNN().setK(4).fit(_arr(table)).transform(_arr(table)))
    for est in (KNN().setK(4), KNN().setK(4).setBroadcastBytes(1000), KNN().setK(4).setBroadcastBytes(1000).setPivots(0),
                KNN().setK(4).setBroadcastBytes(1000).setTopTreeSize(60).setTopTreeLeafSize(3).setSubTreeLeafSize(4)):
        assert _ids(est.fit(_vec(table)).transform(_vec(table))) == want
        assert _ids(est.fit(_vec(table)).transform(_arr(table))) == want


def test_tree_sizes_drive_the_plan(table, monkeypatch):
    seen = []
    monkeypatch.setattr(blocks, "top_k", lambda *a, **kw: seen.append((kw["pivots"], kw["leaf_rows"])) or (_ for _ in ()).throw(KeyError("stop")))
    for est in (KNN().setTopTreeSize(100).setTopTreeLeafSize(7).setSubTreeLeafSize(9), KNN().setPivots(0)):
        with pytest.raises(KeyError):
            est.fit(_arr(table)).transform(_arr(table))
    assert seen == [(15, 9), (0, 30)]


def test_tau_search_finds_most_neighbours(table):
    exact = _ids(KNN().setK(3).fit(_arr(table)).transform(_arr(table)))
    est = KNN().setK(3).setBalanceThreshold(0.7).setBufferSize(0.5).setBroadcastBytes(1000).setTopTreeSize(40).setTopTreeLeafSize(5)
    model = est.fit(_arr(table))
    assert model.tau == 0.5
    near = _ids(model.transform(_arr(table)))
    assert sum(len(set(exact[i][0]) & set(near[i][0])) for i in exact) > 0.8 * 3 * len(exact)


def test_persistence_alone_and_in_a_pipeline(table, tmp_path):
    est = KNNClassifier().setK(5).setWeightCol("w").setExcludeSelf(True)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"), est])
    pipe.save(str(tmp_path / "pipe"))
    model = Pipeline.load(str(tmp_path / "pipe")).fit(table)
    model.save(str(tmp_path / "model"))
    back = PipelineModel.load(str(tmp_path / "model"))
    key = lambda df: sorted((r["id"], r["prediction"], tuple(r["probability"])) for r in df.collect())
    assert key(back.transform(table)) == key(model.transform(table))
    assert isinstance(back.stages[1], KNNClassificationModel) and back.stages[1].num_classes == 3
    assert back.stages[1].uid == est.uid and back.stages[1].getOrDefault("k") == 5
    reg = KNNRegression().setK(2).fit(_arr(table))
    reg.write().overwrite().save(str(tmp_path / "reg"))
    with pytest.raises(ValueError):
        KNNModel.load(str(tmp_path / "reg"))


def test_rings_hold_every_near_candidate():
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(size=(400, 2)), 1)  # many equal distances
    ids = np.arange(400)
    pivot = x[0]
    pd_ = blocks._distances(x, pivot[None, :])[:, 0]
    for kw in ({}, {"max_distance": 0.3}, {"exclude_self": True}):
        opts = dict(k=5, metric="l2", exclude_self=False, max_distance=None, min_positive=False) | kw
        a = blocks._score_rings(x, ids, x, ids, pivot, pd_, 16, opts)
        b = blocks._score_block(x, ids, x, ids, **opts)
        assert all((p == q).all() for p, q in zip(a, b))


def test_parameters_of_the_search():
    p = N.KNNParams(pivots=-1, top_tree_size=10, top_tree_leaf_size=4)
    assert p.pivot_count() == 3 and N.KNNParams(pivots=6).pivot_count() == 6
