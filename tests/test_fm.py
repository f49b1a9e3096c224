"""Factorization machines on dense, sparse and ml Vector rows: values against plain numpy, and training invariants."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from tessera.operators import fm

N, K = 2500, 3


def _plain(m, x):
    p = (m.w0 if m.use_bias else 0.0) + (x @ m.w if m.use_linear else 0.0)
    return p + 0.5 * ((x @ m.v) ** 2 - (x * x) @ (m.v * m.v)).sum(1)


@pytest.fixture(scope="module")
def wide(spark):
    """Rows of a few active entries among N, as struct and as Vector, and their dense matrix."""
    rng = np.random.default_rng(3)
    x, rows = np.zeros((60, N)), []
    for r in range(60):
        at = np.sort(rng.choice(N, r % 5, replace=False))
        x[r, at] = rng.normal(size=len(at))
        val = [float(v) for v in x[r, at]]
        rows.append((r, (N, at.tolist(), val), Vectors.sparse(N, at.tolist(), val), float(rng.random() < 0.5)))
    schema = "id long, s struct<size:int,indices:array<int>,values:array<double>>"
    a = spark.createDataFrame([r[:2] for r in rows], schema)
    b = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows], ["id", "v", "label"])
    return a.join(b, "id").repartition(3).cache(), x, np.array([r[3] for r in rows])


def _model(task, **kw):
    rng = np.random.default_rng(5)
    return fm.FMModel(0.2, rng.normal(size=N), rng.normal(size=(N, K)), task, -0.5, 1.5, **kw)


@pytest.mark.parametrize("task,kw", [(0, {}), (1, {}), (1, {"use_bias": False, "use_linear": False})])
def test_scores_of_sparse_and_vector_rows(spark, wide, task, kw):
    df, x, _ = wide
    m = _model(task, **kw)
    p = _plain(m, x)
    want = np.clip(p, -0.5, 1.5) if task == 0 else 1 / (1 + np.exp(-p))
    table = fm.weight_table(spark, m)
    for col in ("s", "v"):
        for out in (fm.predict(df, m, col), fm.predict_by_join(df, table, m, col, id_col="id"), fm.predict_by_join(df, table, m, col)):
            got = {r["id"]: r["prediction"] for r in out.collect()}
            assert np.allclose([got[i] for i in range(60)], want)


def test_gradient_of_wide_rows(wide):
    df, x, label = wide
    for task in (0, 1):
        m = _model(task)
        p = _plain(m, x)
        y = label if task == 0 else 2 * label - 1
        mult = np.clip(p, -0.5, 1.5) - y if task == 0 else -y / (1 + np.exp(y * p))
        gv = (x * mult[:, None]).T @ (x @ m.v) - m.v * ((x * x).T @ mult)[:, None]
        want = np.concatenate([[mult.sum()], x.T @ mult, gv.ravel()])
        for col in ("s", "v"):
            g, loss, n = fm.gradient(df, m, col)
            assert n == 60 and np.allclose(g, want)
            assert np.isclose(loss, (mult ** 2).sum() if task == 0 else np.logaddexp(0, -y * p).sum())


def test_two_levels_of_partial_sums(spark, wide, monkeypatch):
    df, x, label = wide
    m = _model(1)
    a = fm.gradient(df, m, "s")
    monkeypatch.setattr(fm, "FAN_IN", 1)
    monkeypatch.setattr(fm, "BLOCK", 64)
    b = fm.gradient(df.repartition(7), m, "s")
    assert np.allclose(a[0], b[0]) and np.isclose(a[1], b[1]) and a[2] == b[2]


def test_mixed_and_bad_rows(spark):
    m = fm.FMModel(0.5, np.array([1.0, 2.0]), np.array([[1.0], [3.0]]), 0)
    df = spark.createDataFrame([(1, Vectors.dense(1.0, 1.0), 1.0), (2, Vectors.sparse(2, [1], [1.0]), 0.0), (3, None, 0.0),
                                (4, Vectors.sparse(2, [], []), 0.0)], ["id", "f", "label"])
    got = {r["id"]: r["prediction"] for r in fm.predict(df, m, "f").collect()}
    assert got == {1: 6.5, 2: 2.5, 3: None, 4: 0.5}
    assert fm.gradient(df, m, "f")[2] == 3
    with pytest.raises(ValueError):
        fm.train_sgd(df, 0, features="f", iterations=1)
    with pytest.raises(Exception, match="outside"):
        fm.predict(spark.createDataFrame([(Vectors.sparse(9, [7], [1.0]),)], ["f"]), m, "f").collect()


def test_switched_off_parts_stay_zero_and_loss_falls(wide):
    df, _, _ = wide
    for train in (fm.train_sgd, fm.train_lbfgs):
        hist = []
        m = train(df, 1, 2, iterations=4, features="s", dim=(False, False), reg=(0.0, 0.0, 0.01), history=hist)
        assert m.w0 == 0 and not m.w.any() and not m.use_bias and not m.use_linear
        assert hist[-1][1] <= hist[0][1]
        m = train(df, 1, 2, iterations=4, features="s", dim=(True, False), history=hist)
        assert m.w0 != 0 and not m.w.any()


def test_separate_penalties(wide):
    df, _, _ = wide
    free = fm.train_lbfgs(df, 1, 2, iterations=6, features="s")
    tied = fm.train_lbfgs(df, 1, 2, iterations=6, features="s", reg=(0.0, 50.0, 0.0))
    assert np.abs(tied.w).max() < 0.1 * np.abs(free.w).max()


def test_adagrad_does_not_depend_on_arrow_batches(spark, wide):
    df, _, _ = wide
    hist, out = [], []
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    try:
        for size in ("10000", "3"):
            spark.conf.set(key, size)
            out.append(fm.train_parallel_adagrad(df.coalesce(1).sortWithinPartitions("id"), 2, rounds=4, passes=2, features="s",
                                                 partitions=3, batch_rows=4, history=hist if size == "3" else None))
    finally:
        spark.conf.set(key, old)
    assert np.allclose(out[0], out[1], atol=1e-12)
    assert hist[-1][1] < hist[0][1]
    tied = fm.train_parallel_adagrad(df, 2, rounds=4, passes=2, features="s", partitions=3, reg=10.0)
    used = np.abs(out[0]) != 0
    assert np.abs(tied[used]).mean() < np.abs(out[0][used]).mean()


def test_training_passes_read_packed_rows(spark, wide, monkeypatch):
    df, model = wide[0], _model(1)
    rows = fm._prepared(df, 1, "s", "label")
    want = fm._gradient(rows, model)
    monkeypatch.setattr(fm, "PACKED_BYTES", 500)   # several messages a batch
    packed = fm._packed(rows)
    assert packed.columns == ["packed"] and packed.count() > 1
    got = fm._gradient(packed, model)
    assert np.allclose(got[0], want[0]) and np.isclose(got[1], want[1]) and got[2] == want[2]
    seen, real = [], fm._gradient
    monkeypatch.setattr(fm, "_gradient", lambda r, m: seen.append(r.columns) or real(r, m))
    fm.train_lbfgs(df, 1, 2, iterations=2, features="s")
    assert seen and all(c == ["packed"] for c in seen)
