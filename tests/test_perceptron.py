"""The perceptron learns what Spark's own learns, from packed rows that every evaluation reads whole."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import jobs as J
from tessera.operators import perceptron as P

X, LAYERS = ["a", "b"], [2, 4, 3, 3]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(0, 1280, 1, 1).select("id", F.rand(1).alias("a"), (F.rand(2) * 2).alias("b"))   # ten full blocks of Spark's
    return df.withColumn("label", F.when(F.col("a") + F.col("b") > 1.7, 2).when(F.col("a") > F.col("b"), 1).otherwise(0)).localCheckpoint()


def _plain(w, x, y):
    """Loss of every row, one by one."""
    out = []
    for v, k in zip(x, y):
        at = 0
        for j, (i, o) in enumerate(zip(LAYERS, LAYERS[1:])):
            v = w[at:at + i * o].reshape(i, o).T @ v + w[at + i * o:at + i * o + o]
            at += i * o + o
            v = 1 / (1 + np.exp(-v)) if j < len(LAYERS) - 2 else v
        out.append(np.log(np.exp(v).sum()) - v[int(k)])
    return out


def test_weights_are_those_of_sparks_perceptron(rows):
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    for iters in (0, 15):
        theirs = MultilayerPerceptronClassifier(layers=LAYERS, maxIter=iters, seed=3).fit(J._vec(rows, X))
        ours = J.mlp(rows, X, LAYERS, iters=iters, seed=3)
        assert np.allclose(theirs.weights.toArray(), ours.weights.toArray(), atol=1e-8)
        pick = lambda m: m.transform(J._vec(rows, X)).orderBy("id").select("prediction").collect()
        assert pick(theirs) == pick(ours)


def test_loss_and_gradient_of_all_rows_however_packed(spark, rows, monkeypatch):
    pdf, w = rows.toPandas(), np.random.default_rng(1).normal(size=12 + 15 + 12)
    mean = lambda v: np.mean(_plain(v, pdf[X].to_numpy(), pdf["label"]))
    slope = [(mean(w + e) - mean(w - e)) / 2e-5 for e in np.eye(len(w)) * 1e-5]
    for df, most in ((rows, 5000), (rows.repartition(7), 33), (rows.repartition(3).union(rows.limit(0)), 1)):
        monkeypatch.setattr(P, "ROWS", most)
        packed = P._packed(df, X, "label", 3)
        loss, g = P._objective(packed, w, LAYERS)
        assert np.isclose(loss, mean(w)) and np.allclose(g, slope, atol=1e-7)
        P.release(packed)


def test_fit_reads_packed_rows_and_leaves_nothing(spark, rows, monkeypatch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, real = spark.conf.get(key), [], P._objective
    monkeypatch.setattr(P, "_objective", lambda t, w, layers: seen.append((t, t.columns)) or real(t, w, layers))
    J.mlp(rows, X, LAYERS, iters=3)
    assert len(seen) >= 4 and all(c == ["x", "y"] for _, c in seen) and spark.conf.get(key) == before
    assert not os.path.exists(seen[0][0]._tessera_path.replace("file:", ""))


def test_bad_rows_are_refused(spark, rows):
    base = rows.select("a", "b", F.col("label").cast("double").alias("label"))
    for bad in ((None, 1.0, 1.0), (float("nan"), 1.0, 1.0), (float("inf"), 1.0, 1.0), (1.0, 1.0, None), (1.0, 1.0, 3.0), (1.0, 1.0, -1.0), (1.0, 1.0, 0.5)):
        with pytest.raises(Exception, match="a feature is|a label is"):
            J.mlp(base.unionByName(spark.createDataFrame([bad], "a double, b double, label double")), X, LAYERS, iters=1)
    with pytest.raises(ValueError, match="no training rows"):
        J.mlp(base.limit(0), X, LAYERS, iters=1)


def test_search_reaches_a_minimum_or_gives_up():
    def valley(v):
        a, b = v
        return (1 - a) ** 2 + 100 * (b - a * a) ** 2, np.array([-2 * (1 - a) - 400 * a * (b - a * a), 200 * (b - a * a)])
    assert np.allclose(P.lbfgs(valley, np.array([-1.2, 1.0]), 200, 1e-12), [1, 1], atol=1e-5)
    start = np.array([1.0, 2.0])
    assert (P.lbfgs(lambda v: (float(v @ v), -2 * v), start, 50, 1e-6) == start).all()   # no step goes down
    assert (P.lbfgs(lambda v: (0.0, np.zeros(2)), start, 50, 1e-6) == start).all()
