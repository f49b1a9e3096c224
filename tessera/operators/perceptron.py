"""Multilayer perceptron (M12): sigmoid hidden units, softmax output, cross-entropy, L-BFGS over all rows.

Training rows are written once, packed; every evaluation reads all of them and
each task adds its rows' loss and gradient up in numpy, so only sums of the
model's size leave a task.  The network, its first weights, the search and its
end are those of ``MultilayerPerceptronClassifier``, whose model is returned;
the loss is the mean over the rows (Spark: over its blocks of rows, so rows
of a block that is not full count for more).
"""

from __future__ import annotations

import math
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, release

ROWS = 5000             # most training rows in one packed row: their activations stay in a core's cache
GROUP_BYTES = 16 << 20  # row group of the packed table: what a task holds of it, and the unit it is dealt by
MESSAGES = 32           # packed rows that a worker gets at a time
CORRECTIONS = 10        # steps that L-BFGS remembers
RECENT = 20             # losses among which the search looks for progress
TRIES = 10              # evaluations of each part of a line search


def _packed(train: DataFrame, cols: list[str], label: str, classes: int) -> DataFrame:
    """All rows, written as ``x`` (doubles, one feature after the other) and ``y`` (class numbers) of up to ``ROWS`` rows."""
    n, most = len(cols), ROWS

    def run(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            x = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(n)])
            y = b.column(n).to_numpy(zero_copy_only=False)
            if not np.isfinite(x).all():
                raise ValueError("a feature is null, NaN or infinite")
            if not ((y >= 0) & (y < classes) & (y == np.floor(y))).all():
                raise ValueError(f"a label is not one of 0 to {classes - 1}")
            parts = np.array_split(np.arange(len(y)), -(-len(y) // most))
            yield pa.RecordBatch.from_arrays([pa.array([x[:, p[0]:p[-1] + 1].tobytes() for p in parts], pa.binary()),
                                              pa.array([y[p].astype(np.int32).tobytes() for p in parts], pa.binary())], ["x", "y"])

    nums = train.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)], F.col(label).cast("double").alias("y"))
    return cut_lineage(nums.mapInArrow(run, "x binary, y binary"), **{"parquet.block.size": str(GROUP_BYTES)})


@contextmanager
def _few_at_a_time(spark):
    """Packed rows go to the workers by ``MESSAGES``: by Spark's 10,000 they come in messages of 64 MB, which takes longer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(MESSAGES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _layers(weights: np.ndarray, layers: list[int]):
    """(matrix, bias) of each layer, as Spark lays them out in one vector."""
    at = 0
    for i, o in zip(layers, layers[1:]):
        yield weights[at:at + i * o].reshape(i, o).T, weights[at + i * o:at + i * o + o, None]
        at += i * o + o


def _row_sums(weights: np.ndarray, layers: list[int], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradient and loss summed over rows: ``x`` (features x rows), ``y`` the classes."""
    net, n = list(_layers(weights, layers)), len(y)
    values = [x]
    full = []   # activations of the hidden layers and a row of ones, which stands for the bias
    for w, bias in net[:-1]:
        full.append(np.empty((len(w) + 1, n)))
        full[-1][-1] = 1.0
        z = full[-1][:-1]
        np.matmul(-w, values[-1], out=z)
        z -= bias
        with np.errstate(over="ignore"):   # exp(-z) = inf is a unit at 0
            np.exp(z, out=z)
        z += 1.0
        np.reciprocal(z, out=z)
        values.append(z)
    d = net[-1][0] @ values[-1]
    d += net[-1][1]
    d -= d.max(0)
    loss = -d.ravel().take(y * np.int64(n) + np.arange(n)).sum()
    np.exp(d, out=d)
    total = d.sum(0)
    loss += np.log(total).sum()
    d *= np.reciprocal(total)
    d -= y == np.arange(len(d), dtype=y.dtype)[:, None]
    parts = []
    for (w, _), v, v1 in zip(net[:0:-1], values[:0:-1], full[::-1]):
        parts.append((v1 @ d.T).ravel())
        d = w.T @ d
        d *= v
        np.subtract(1.0, v, out=v)
        d *= v
    parts += [d.sum(1), (x @ d.T).ravel()]
    return np.concatenate(parts[::-1]), float(loss)


def _objective(packed: DataFrame, weights: np.ndarray, layers: list[int]) -> tuple[float, np.ndarray]:
    """Mean loss and its gradient over all rows: one pass."""

    def run(batches):
        total = np.zeros(len(weights) + 2)   # the gradient, the loss and the row count
        for b in batches:
            for xs, ys in zip(b.column(0), b.column(1)):
                y = np.frombuffer(ys.as_buffer(), np.int32)
                g, loss = _row_sums(weights, layers, np.frombuffer(xs.as_buffer(), np.float64).reshape(layers[0], len(y)), y)
                total[:-2] += g
                total[-2] += loss
                total[-1] += len(y)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["i", "part"])

    # one sum per task and weight, added up in ascending order whatever task ends first
    parts = packed.mapInArrow(run, "i int, part double").groupBy("i").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    total = np.zeros(len(weights) + 2)
    for r in parts.select("i", F.aggregate("parts", F.lit(0.0), lambda a, p: a + p).alias("s")).collect():
        total[r["i"]] = r["s"]
    if not total[-1]:
        raise ValueError("no training rows")
    return float(total[-2] / total[-1]), total[:-2] / total[-1]


# L-BFGS ------------------------------------------------------------------------
class _NoStep(Exception):
    pass


def _direction(g: np.ndarray, steps: list) -> np.ndarray:
    """Two-loop recursion over the (step, change of gradient) pairs, newest last."""
    d, alphas = g.copy(), []
    if steps and not steps[-1][0] @ steps[-1][1] >= 0:
        raise _NoStep
    for s, y in reversed(steps):
        alphas.append((s @ d) / (s @ y))
        d -= alphas[-1] * y
    if steps:
        s, y = steps[-1]
        d *= (s @ y) / (y @ y)
    for (s, y), a in zip(steps, reversed(alphas)):
        d += s * (a - (y @ d) / (s @ y))
    if not np.isfinite(d).all():
        raise _NoStep
    return -d


def _between(a: tuple, b: tuple) -> float:
    """Cubic interpolation between (t, loss, slope) points, at least a tenth away from both."""
    (lt, lf, ls), (rt, rf, rs) = sorted((a, b))
    d1 = ls + rs - 3 * (lf - rf) / (lt - rt)
    square = d1 * d1 - ls * rs
    t = (lt + rt) / 2
    if square >= 0 and rs - ls + 2 * math.sqrt(square) != 0:
        d2 = math.sqrt(square)
        t = rt - (rt - lt) * (rs + d2 - d1) / (rs - ls + 2 * d2)
    return min(max(t, lt + 0.1 * (rt - lt)), lt + 0.9 * (rt - lt))


def _line_search(at, f: float, slope: float, t: float) -> float:
    """A step that meets the strong Wolfe conditions; the last one evaluated. ``at(t)`` gives (t, loss, slope)."""
    if not slope <= 0:
        raise _NoStep
    low = (0.0, f, slope)
    bracket = None
    for i in range(TRIES):
        c = at(t)
        if not math.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > f + 1e-4 * t * slope or (c[1] >= low[1] and i > 0):
            bracket = low, c
        elif abs(c[2]) <= 0.9 * abs(slope):
            return t
        elif c[2] >= 0:
            bracket = c, low
        if bracket:
            break
        low = c
        t *= 1.5
    if not bracket:
        raise _NoStep
    low, high = bracket
    for _ in range(TRIES):
        c = at(_between(low, high))
        if c[1] > f + 1e-4 * c[0] * slope or c[1] >= low[1]:
            high = c
            continue
        if abs(c[2]) <= 0.9 * abs(slope):
            return c[0]
        if c[2] * (high[0] - low[0]) >= 0:
            high = low
        low = c
    raise _NoStep


def lbfgs(objective, x: np.ndarray, iters: int, tol: float) -> np.ndarray:
    """Minimum of ``objective(x) -> (loss, gradient)``: ends after ``iters`` steps, without progress of ``tol`` times the first loss
    over ``RECENT`` steps, at a flat point, or where two searches in a row find no step (the second forgets the steps before)."""
    f, g = objective(x)
    first, recent, steps, failed, done = f, [math.inf], [], False, 0
    while done < iters and not (len(recent) > 1 and abs(f - max(recent)) <= tol * abs(first)) and np.linalg.norm(g) > max(tol * f, 1e-8):
        last = None

        def along(t):
            nonlocal last
            point = x + t * d
            last = (point, *objective(point))
            return t, last[1], float(last[2] @ d)

        try:
            d = _direction(g, steps)
            t = _line_search(along, f, float(g @ d), 1.0 / float(np.linalg.norm(d)) if done == 0 else 1.0)
            if t * np.linalg.norm(g) < 1e-10:
                raise _NoStep
        except _NoStep:
            if failed:
                break
            failed, steps = True, []
            continue
        failed = False
        nx, nf, ng = last
        steps = [*steps, (nx - x, ng - g)][-CORRECTIONS:]
        x, f, g = nx, nf, ng
        recent = [*recent, f][-RECENT:]
        done += 1
    return x


def train(rows: DataFrame, cols: list[str], layers: list[int], label: str = "label", iters: int = 100, tol: float = 1e-6, seed: int = 1234):
    """Spark's perceptron model with weights fitted to all ``rows``; a missing feature or a label that is no class is an error."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.linalg import Vectors
    # one row, which no iteration looks at: a fit that only takes weights
    row = rows.sparkSession.createDataFrame([(0.0, Vectors.dense([0.0] * len(cols)))], [label, "features"])

    def model(**weights):
        return MultilayerPerceptronClassifier(layers=layers, labelCol=label, maxIter=0, seed=seed, **weights).fit(row)

    start = model().weights.toArray()
    packed = _packed(rows, cols, label, layers[-1])
    try:
        with _few_at_a_time(rows.sparkSession):
            fitted = lbfgs(lambda w: _objective(packed, w, layers), start, iters, tol)
    finally:
        release(packed)
    return model(initialWeights=Vectors.dense(fitted))
