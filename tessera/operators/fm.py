"""Factorization machines.

Rows carry ``label`` and ``features``: an ``array<double>`` (dense), an ml
``Vector`` (dense or sparse) or a struct ``size, indices, values``.  All three
become one form inside Spark (:func:`active`), of which only the active entries
are worked on, so a row of a million one-hot columns costs its handful of ones.

The model (intercept, n linear weights, n x k factors) is sent to the tasks
once per pass as a broadcast and never becomes part of an expression.  Each
task adds its rows' gradients up in one buffer and hands on the touched blocks
of it; blocks are summed in two levels of groups of bounded size, and only the
summed model-sized vector reaches the driver.  Models beyond the broadcast
bound are scored by a join with a table of weights (:func:`predict_by_join`).

Training reads its rows from a table written once, packed for the full passes of
SGD and L-BFGS; rows without features or label are refused.  Switched-off parts (bias, linear) stay 0.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clip, logistic, recode_pm1
from ..session import DEFAULT_BROADCAST_BYTES, cut_lineage, release

PACKED_BYTES = 2 << 20    # training rows in one packed row
BLOCK = 4096              # weights in one row of a partial sum
FAN_IN = 64               # partial sums of one block added up in one group of the first level
PART_ENTRIES = 2_000_000  # active entries that one AdaGrad group holds
ACTIVE = "struct<size:int,indices:array<int>,values:array<double>>"


@dataclass
class FMModel:
    w0: float
    w: np.ndarray            # (n,)
    v: np.ndarray            # (n, k)
    task: int                # 0 regression, 1 classification
    min_target: float = -math.inf
    max_target: float = math.inf
    use_bias: bool = True
    use_linear: bool = True

    @property
    def num_features(self) -> int:
        return self.v.shape[0]

    @property
    def num_factors(self) -> int:
        return self.v.shape[1]

    def flat(self) -> np.ndarray:
        return np.concatenate([[self.w0], self.w, self.v.ravel()])

    @classmethod
    def from_flat(cls, theta, n, k, **kw) -> "FMModel":
        return cls(float(theta[0]), np.asarray(theta[1:1 + n]), np.asarray(theta[1 + n:]).reshape(n, k), **kw)

    def moved(self, theta) -> "FMModel":
        """The same model at other weights."""
        n = self.num_features
        return replace(self, w0=float(theta[0]), w=np.asarray(theta[1:1 + n]), v=np.asarray(theta[1 + n:]).reshape(self.v.shape))

    def switches(self) -> np.ndarray:
        """1 for every weight in use, 0 for the switched-off ones."""
        n = self.num_features
        return np.concatenate([[float(self.use_bias)], np.full(n, float(self.use_linear)), np.ones(self.v.size)])

    def penalty(self, reg) -> np.ndarray:
        """L2 strength of every weight, from (bias, linear, factors)."""
        n = self.num_features
        return np.concatenate([[reg[0]], np.full(n, float(reg[1])), np.full(self.v.size, float(reg[2]))])


# rows --------------------------------------------------------------------------
def active(df: DataFrame, features: str = "features") -> Column:
    """``size, indices, values`` of a features column; values without indices are all entries in order (a dense row).

    Dense rows get an empty array and not null: columns of null arrays reach Python ten times more slowly.
    """
    kind = df.schema[features].dataType
    name = kind.typeName()
    x = F.col(features)
    none = F.array().cast("array<int>")
    if name == "array":
        out = F.struct(F.size(x).alias("size"), none.alias("indices"), x.cast("array<double>").alias("values"))
    elif name == "struct":
        out = F.struct(x["size"].cast("int").alias("size"), F.coalesce(x["indices"].cast("array<int>"), none).alias("indices"), x["values"].cast("array<double>").alias("values"))
    elif kind.simpleString() == "vector":
        v = F.unwrap_udt(x)
        sparse = v["type"] == 0
        out = F.struct(F.when(sparse, v["size"]).otherwise(F.size(v["values"])).alias("size"),
                       F.when(sparse, v["indices"]).otherwise(none).alias("indices"), v["values"].alias("values"))
    else:
        raise TypeError(f"features must be array<double>, an ml Vector or struct<size, indices, values>, not {kind.simpleString()}")
    return F.when(x.isNotNull(), out)


class Block:
    """Some rows: a matrix if all are dense and of one size, else the row, index and value of every active entry."""

    def __init__(self, column: pa.StructArray, n: int):
        self.rows = len(column)
        values, indices = column.field("values"), column.field("indices")
        off = values.offsets.to_numpy().astype(np.int64)
        val = values.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]] if len(values.values) else np.zeros(0)
        count = np.diff(off)
        self.x = None
        ioff = indices.offsets.to_numpy().astype(np.int64)
        given = np.diff(ioff) > 0
        if not given.any() and (count == n).all():
            self.x = val.reshape(self.rows, n)
            return
        self.row = np.repeat(np.arange(self.rows), count)
        self.val = val
        first = np.repeat(off[:-1] - off[0], count)
        self.idx = np.arange(len(val)) - first
        if given.any():
            flat = indices.values.to_numpy(zero_copy_only=False)
            if (np.diff(ioff)[given] != count[given]).any():
                raise ValueError("a row has not as many indices as values")
            at = given[self.row]
            self.idx[at] = flat[(np.arange(len(val)) - first + np.repeat(ioff[:-1], count))[at]]
        if len(self.idx) and (self.idx.min() < 0 or self.idx.max() >= n):
            raise ValueError(f"feature index outside 0..{n - 1}")

    def take(self, rows: np.ndarray) -> "Block":
        out = Block.__new__(Block)
        out.rows = len(rows)
        out.x = None if self.x is None else self.x[rows]
        if self.x is None:
            start = np.searchsorted(self.row, rows)
            size = np.searchsorted(self.row, rows, "right") - start
            at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
            out.row, out.idx, out.val = np.repeat(np.arange(len(rows)), size), self.idx[at], self.val[at]
        return out

    def _sum(self, entries: np.ndarray) -> np.ndarray:
        if entries.ndim == 1:
            return np.bincount(self.row, weights=entries, minlength=self.rows)
        return np.stack([np.bincount(self.row, weights=e, minlength=self.rows) for e in entries.T], axis=1)

    def sums(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """sum_i v_if x_i per row and factor, and the pairwise part of the score."""
        if self.x is not None:
            s = self.x @ v
            return s, 0.5 * (s * s - (self.x * self.x) @ (v * v)).sum(1)
        d = self.val[:, None] * v[self.idx]
        s = self._sum(d)
        return s, 0.5 * (s * s - self._sum(d * d)).sum(1)

    def linear(self, w: np.ndarray) -> np.ndarray:
        return self.x @ w if self.x is not None else self._sum(self.val * w[self.idx])

    def score(self, m: FMModel) -> np.ndarray:
        """The raw score of every row; dense rows add their features up one after the other, as the formula stands."""
        base = m.w0 if m.use_bias else 0.0
        if self.x is None:
            p = self.sums(m.v)[1]
            return base + (self.linear(m.w) if m.use_linear else 0.0) + p
        x = np.ascontiguousarray(self.x.T)
        p = np.add.reduce(x * m.w[:, None], axis=0, initial=base) if m.use_linear else np.full(self.rows, base)
        for f in range(m.num_factors):
            v = m.v[:, f][:, None]
            s = np.add.reduce(x * v, axis=0)
            p = p + 0.5 * (s * s - np.add.reduce(x * x * v ** 2, axis=0))
        return p

    def touched(self) -> np.ndarray:
        return np.arange(self.x.shape[1]) if self.x is not None else np.unique(self.idx)

    def gradients(self, mult: np.ndarray, s: np.ndarray, v: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the linear weights and factors of the features ``at`` (all that are touched)."""
        if self.x is not None:
            x = self.x
            return x.T @ mult, (x * mult[:, None]).T @ s - v * ((x * x).T @ mult)[:, None]
        where = np.searchsorted(at, self.idx)
        add = lambda e: np.bincount(where, weights=e, minlength=len(at))
        m = mult[self.row] * self.val
        pull = np.stack([add(m * s[self.row, f]) for f in range(v.shape[1])], axis=1)
        return add(m), pull - v[at] * add(m * self.val)[:, None]


def _struct(batch: pa.RecordBatch, i: int) -> pa.StructArray:
    c = batch.column(i)
    return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c


# M1 ----------------------------------------------------------------------------
def raw_score(df: DataFrame, model: FMModel, features: str = "features") -> Column:
    """w0 + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]; null for a row without features."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        m = shared.value
        known = column.is_valid()
        out = np.full(len(column), np.nan)
        mask = known.to_numpy(zero_copy_only=False)
        out[mask] = Block(column.filter(known), m.num_features).score(m)
        return pa.array(out, mask=~mask)

    return score(active(df, features))


def _targets(p: Column, model: FMModel) -> Column:
    return clip(p, model.min_target, model.max_target) if model.task == 0 else logistic(p)


def predict(df: DataFrame, model: FMModel, features: str = "features", out: str = "prediction",
            broadcast_bytes: int = 8 * DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Task 0: raw score clipped to [min, max]; task 1: logistic of the raw score."""
    if 8 * (1 + model.w.size + model.v.size) > broadcast_bytes:
        raise ValueError("the model exceeds the broadcast bound; write it as a table of weights and use predict_by_join")
    scored = df.withColumn(out, raw_score(df, model, features))
    return scored.withColumn(out, F.when(F.col(out).isNotNull(), _targets(F.col(out), model)))


def weight_table(spark, model: FMModel) -> DataFrame:
    """``idx, w, v``: one row per feature."""
    rows = [(i, float(w), [float(x) for x in v]) for i, (w, v) in enumerate(zip(model.w, model.v))]
    return spark.createDataFrame(rows, "idx int, w double, v array<double>")


def predict_by_join(df: DataFrame, weights: DataFrame, model: FMModel, features: str = "features", out: str = "prediction",
                    id_col: str | None = None) -> DataFrame:
    """``predict`` with the linear weights and factors in a table ``idx, w, v``; ``model`` gives the rest (its w and v are not read).

    Every active entry meets its feature's row; sums per row come together by
    ``id_col`` (unique, not null) or else by a row number, for which the rows
    are written once.  Partial sums are taken before that shuffle.
    """
    columns = df.columns
    if id_col is None:
        id_col = "_number"
        df = cut_lineage(df.withColumn(id_col, F.monotonically_increasing_id()))
    k = model.num_factors
    x = active(df, features)
    entry = F.when(F.size(x["indices"]) == 0, F.sequence(F.lit(0), F.size(x["values"]) - 1)).otherwise(x["indices"])
    pairs = F.arrays_zip(entry.alias("idx"), x["values"].alias("x"))
    entries = df.filter(x.isNotNull() & (F.size(x["values"]) > 0)).select(F.col(id_col).alias("_row"), F.explode(pairs).alias("e")) \
        .select("_row", F.col("e.idx").alias("_idx"), F.col("e.x").alias("_x"))
    joined = entries.join(weights, F.col("_idx") == F.col("idx"))
    sums = [F.sum(F.col("w") * F.col("_x")).alias("_lin")]
    for f in range(k):
        d = F.col("v")[f] * F.col("_x")
        sums += [F.sum(d).alias(f"_s{f}"), F.sum(d * d).alias(f"_q{f}")]
    per = joined.groupBy("_row").agg(*sums)
    zero = F.lit(0.0)
    raw = F.lit(float(model.w0) if model.use_bias else 0.0) + (F.coalesce("_lin", zero) if model.use_linear else zero)
    for f in range(k):
        s, q = F.coalesce(f"_s{f}", zero), F.coalesce(f"_q{f}", zero)
        raw = raw + 0.5 * (s * s - q)
    joined = df.join(per, F.col(id_col) == F.col("_row"), "left")
    return joined.withColumn(out, F.when(F.col(features).isNotNull(), _targets(raw, model))).select(*columns, out)


# partial sums ------------------------------------------------------------------
def _blocks(flat: np.ndarray, slot: int, size: int):
    """The blocks of ``size`` weights that are not all 0, as rows ``slot, block, part``."""
    parts = [(b, flat[b * size:(b + 1) * size]) for b in range(-(-len(flat) // size))]
    parts = [(b, p) for b, p in parts if p.any()]
    return pa.RecordBatch.from_arrays([pa.array([slot] * len(parts), pa.int32()), pa.array([b for b, _ in parts], pa.int32()),
                                       pa.array([p.tolist() for _, p in parts], pa.list_(pa.float64()))], ["slot", "block", "part"])


PARTIAL = "slot int, block int, part array<double>"


def _add_up(partials: DataFrame, length: int) -> np.ndarray:
    """Sum of partial vectors: by (slot, block), then by block; the model-sized sum is collected."""

    def add(group: pa.Table) -> pa.Table:
        part = group["part"].combine_chunks()
        part = part.chunk(0) if isinstance(part, pa.ChunkedArray) else part
        total = part.flatten().to_numpy().reshape(len(group), -1).sum(0)
        return pa.table([group["slot"].slice(0, 1), group["block"].slice(0, 1), pa.array([total.tolist()], pa.list_(pa.float64()))],
                        names=["slot", "block", "part"])

    first = partials.groupBy("slot", "block").applyInArrow(add, PARTIAL)
    second = first.withColumn("slot", F.lit(0)).groupBy("slot", "block").applyInArrow(add, PARTIAL)
    out = np.zeros(length)
    for r in second.select("block", "part").collect():  # one row per BLOCK weights
        out[r["block"] * BLOCK:r["block"] * BLOCK + len(r["part"])] = r["part"]
    return out


# M2 ----------------------------------------------------------------------------
def _prepared(df: DataFrame, task: int, features: str, label: str) -> DataFrame:
    y = recode_pm1(label) if task == 1 else F.col(label).cast("double")
    return df.select(active(df, features).alias("x"), y.alias("y"))


def _packed(rows: DataFrame) -> DataFrame:
    """The rows ``x, y`` as Arrow messages of about ``PACKED_BYTES``, written: passes over them convert no nested values again."""
    most = PACKED_BYTES

    def run(batches):
        for b in batches:
            step = max(1, b.num_rows * most // max(b.nbytes, 1))
            for a in range(0, b.num_rows, step):
                part, sink = b.slice(a, step), pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, b.schema) as out:
                    out.write_batch(part)
                yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["packed"])

    return cut_lineage(rows.select("x", "y").mapInArrow(run, "packed binary"))


def _unpacked(batches):
    """The batches ``x, y`` of a table of rows, packed or not."""
    for b in batches:
        if b.schema.names != ["packed"]:
            yield b
            continue
        for message in b.column(0):
            with pa.ipc.open_stream(message.as_buffer()) as rows:
                yield from rows


def _gradient(rows: DataFrame, model: FMModel) -> tuple[np.ndarray, float, int]:
    n, k = model.v.shape
    length = 1 + n + n * k
    size, fan_in = BLOCK, FAN_IN
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        from pyspark import TaskContext
        m = shared.value
        total = np.zeros(length + 2)   # the gradient, the loss and the row count
        gw, gv = total[1:1 + n], total[1 + n:length].reshape(n, k)
        for b in _unpacked(batches):
            if b.num_rows == 0:
                continue
            block, y = Block(_struct(b, 0), n), b.column(1).to_numpy(zero_copy_only=False)
            s, p = block.sums(m.v)
            if m.use_linear:
                p = p + block.linear(m.w)
            if m.use_bias:
                p = p + m.w0
            if m.task == 0:
                mult = np.clip(p, m.min_target, m.max_target) - y
                total[length] += (mult * mult).sum()
            else:
                z = y * p
                mult = -y * (1.0 - 1.0 / (1.0 + np.exp(-z)))
                total[length] += np.logaddexp(0.0, -z).sum()
            total[length + 1] += len(y)
            at = block.touched()
            a, c = block.gradients(mult, s, m.v, at)
            if m.use_bias:
                total[0] += mult.sum()
            if m.use_linear:
                gw[at] += a
            gv[at] += c
        yield _blocks(total, TaskContext.get().partitionId() // fan_in, size)

    total = _add_up(rows.mapInArrow(run, PARTIAL), length + 2)
    return total[:length], float(total[length]), int(round(total[length + 1]))


def gradient(df: DataFrame, model: FMModel, features: str = "features", label: str = "label") -> tuple:
    """Sum of per-row gradients and of the loss over the table, and the row count.

    Task 1 recodes labels to -1/1 (F8) and reports log loss; task 0 uses p - y
    and squared error of the clipped prediction.  Rows without features or
    label are not counted.
    """
    rows = _prepared(df, model.task, features, label)
    return _gradient(rows.filter("x is not null and y is not null"), model)


def gradient_table(df: DataFrame, model: FMModel, features="features", label="label") -> DataFrame:
    """Same sums as a DataFrame ``name, value`` (w0, w_i, v_i_f, loss, count)."""
    g, loss, n = gradient(df, model, features, label)
    nf, k = model.v.shape
    names = ["w0"] + [f"w_{i}" for i in range(nf)] + [f"v_{i}_{f}" for i in range(nf) for f in range(k)]
    rows = list(zip(names, map(float, g))) + [("loss", loss), ("count", float(n))]
    return df.sparkSession.createDataFrame(rows, "name string, value double")


def init_model(n: int, k: int, task: int, std: float = 0.1, seed: int = 0, **kw) -> FMModel:
    rng = np.random.default_rng(seed)
    return FMModel(0.0, np.zeros(n), rng.normal(0.0, std, size=(n, k)), task, **kw)


def _training_rows(df: DataFrame, task: int, features: str, label: str):
    """(rows written once, feature count, smallest and largest label)."""
    rows = cut_lineage(_prepared(df, task, features, label))
    s = rows.agg(F.count(F.lit(1)).alias("all"), F.count(F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), 1)).alias("good"),
                 F.max("x.size").alias("n"), F.min("y").alias("lo"), F.max("y").alias("hi")).first()
    if s["all"] != s["good"]:
        release(rows)
        raise ValueError(f"{s['all'] - s['good']} training rows have no features or no label")
    if not s["all"]:
        release(rows)
        raise ValueError("no training rows")
    return rows, int(s["n"]), float(s["lo"]), float(s["hi"])


def _start(model, n, num_factors, task, init_std, seed, lo, hi, dim) -> FMModel:
    if model is not None:
        return model
    kw = {"min_target": lo, "max_target": hi} if task == 0 else {}
    return init_model(n, num_factors, task, init_std, seed, use_bias=dim[0], use_linear=dim[1], **kw)


# M3 ----------------------------------------------------------------------------
def train_sgd(df: DataFrame, task: int, num_factors: int = 4, iterations: int = 100, step: float = 0.15,
              batch_fraction: float = 1.0, reg=(0.0, 0.0, 0.0), init_std: float = 0.1, seed: int = 0,
              features: str = "features", label: str = "label", history: list | None = None,
              dim: tuple[bool, bool] = (True, True), model: FMModel | None = None) -> FMModel:
    """Mini-batch SGD: step / sqrt(iter), separate L2 for bias, linear and factors (``reg``), bias and linear part
    switchable (``dim``); starts from ``model`` if given."""
    rows, n, lo, hi = _training_rows(df, task, features, label)
    m = _start(model, n, num_factors, task, init_std, seed, lo, hi, dim)
    if batch_fraction >= 1.0 and iterations > 1:
        plain, rows = rows, _packed(rows)
        release(plain)
    for it in range(1, iterations + 1):
        batch = rows if batch_fraction >= 1.0 else rows.sample(False, batch_fraction, seed + it)
        g, loss, cnt = _gradient(batch, m)
        if cnt == 0:
            continue
        if history is not None:
            history.append((it, float(loss / cnt)))
        theta = m.flat()
        m = m.moved(theta - step / math.sqrt(it) * (g / cnt + m.penalty(reg) * theta) * m.switches())
    release(rows)
    return m


# M4 ----------------------------------------------------------------------------
def train_lbfgs(df: DataFrame, task: int, num_factors: int = 4, iterations: int = 20, corrections: int = 10,
                reg=(0.0, 0.0, 0.0), init_std: float = 0.1, seed: int = 0, features: str = "features",
                label: str = "label", history: list | None = None, dim: tuple[bool, bool] = (True, True),
                model: FMModel | None = None) -> FMModel:
    """L-BFGS on the full-table objective (one distributed pass per evaluation);
    the two-loop recursion runs on the driver over the model-sized vectors.
    ``reg`` is the L2 of bias, linear part and factors; ``dim`` as in :func:`train_sgd`."""
    rows, n, lo, hi = _training_rows(df, task, features, label)
    m0 = _start(model, n, num_factors, task, init_std, seed, lo, hi, dim)
    plain, rows = rows, _packed(rows)
    release(plain)
    on, penalty = m0.switches(), m0.penalty(reg)

    def objective(th):
        g, loss, cnt = _gradient(rows, m0.moved(th))
        return loss / cnt + 0.5 * float((penalty * th) @ th), (g / cnt + penalty * th) * on

    th = m0.flat() * on
    f, g = objective(th)
    S, Y = [], []
    for it in range(iterations):
        q = g.copy()
        alphas = []
        for s, y in reversed(list(zip(S, Y))):
            a = (s @ q) / (y @ s)
            alphas.append(a)
            q -= a * y
        if S:
            q *= (S[-1] @ Y[-1]) / (Y[-1] @ Y[-1])
        for (s, y), a in zip(zip(S, Y), reversed(alphas)):
            b = (y @ q) / (y @ s)
            q += s * (a - b)
        d = -q
        t = 1.0
        while True:
            nt = th + t * d
            nf_, ng = objective(nt)
            if nf_ <= f + 1e-4 * t * (g @ d) or t < 1e-8:
                break
            t *= 0.5
        s, y = nt - th, ng - g
        th, f, g = nt, nf_, ng
        if history is not None:
            history.append((it + 1, float(f)))
        if y @ s > 1e-12:
            S.append(s)
            Y.append(y)
            if len(S) > corrections:
                S.pop(0)
                Y.pop(0)
        if np.linalg.norm(g) < 1e-9:
            break
    release(rows)
    return m0.moved(th)


# M5 ----------------------------------------------------------------------------
def _adagrad(block: Block, y: np.ndarray, v: np.ndarray, passes: int, step: float, reg: float, batch_rows: int, rng) -> np.ndarray:
    """AdaGrad passes over one group's rows in mini-batches; every pass in another order."""
    v = v.copy()
    g2 = np.ones_like(v)
    for _ in range(passes):
        order = rng.permutation(block.rows)
        for a in range(0, block.rows, batch_rows):
            rows = np.sort(order[a:a + batch_rows])
            some, ys = block.take(rows), y[rows]
            s, p = some.sums(v)
            mult = -ys / (1.0 + np.exp(np.clip(ys * p, -700, 700))) / len(rows)
            at = some.touched()
            g = some.gradients(mult, s, v, at)[1] + reg * v[at]
            g2[at] += g * g
            v[at] -= step * g / np.sqrt(g2[at])
    return v


def train_parallel_adagrad(df: DataFrame, num_factors: int = 4, rounds: int = 5, passes: int = 1,
                           step: float = 0.1, init_std: float = 0.1, seed: int = 0,
                           features: str = "features", label: str = "label", reg: float = 0.0,
                           batch_rows: int = 32, partitions: int | None = None, history: list | None = None) -> np.ndarray:
    """Factors only (no bias / linear), labels recoded to -1/1.

    The rows are dealt into groups by row number, as many as keep a group
    below ``PART_ENTRIES`` active entries (or ``partitions``).  Each round every
    group runs AdaGrad ``passes`` over all its rows from the common factors, in
    mini-batches, and the groups' factors are averaged.  Order and mini-batches
    depend on the row numbers alone, not on how Spark cuts the rows into batches.
    """
    rows = cut_lineage(_prepared(df, 1, features, label).withColumn("row", F.monotonically_increasing_id()))
    s = rows.agg(F.count(F.lit(1)).alias("all"), F.count(F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), 1)).alias("good"),
                 F.max("x.size").alias("n"), F.sum(F.size("x.values")).alias("entries")).first()
    if not s["all"] or s["all"] != s["good"]:
        release(rows)
        raise ValueError(f"{s['all'] - s['good']} of {s['all']} training rows have no features or no label")
    n, spark = int(s["n"]), df.sparkSession
    parts = partitions or max(1, math.ceil(s["entries"] / PART_ENTRIES), min(8, s["all"] // 1000))
    parts = min(parts, s["all"])
    # row numbers have gaps between the writing tasks; the hash deals them evenly
    dealt = rows.withColumn("slot", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
    groups = dealt.select("slot").distinct().count()
    v = np.random.default_rng(seed).normal(0.0, init_std, size=(n, num_factors))

    size, fan_in = BLOCK, FAN_IN

    def trainer(it: int, shared):
        def run(group: pa.Table) -> pa.Table:
            group = group.sort_by("row").combine_chunks()
            slot = group["slot"][0].as_py()
            start = shared.value
            end = _adagrad(Block(group["x"].chunk(0), n), group["y"].to_numpy(), start, passes, step, reg, batch_rows,
                           np.random.default_rng([seed, it, slot]))
            return pa.Table.from_batches([_blocks((end - start).ravel(), slot // fan_in, size)])
        return run

    for it in range(rounds):
        run = trainer(it, spark.sparkContext.broadcast(v))
        if history is not None:
            m = FMModel(0.0, np.zeros(n), v, 1, use_bias=False, use_linear=False)
            history.append((it, _gradient(rows.select("x", "y"), m)[1] / s["all"]))
        v = v + _add_up(dealt.groupBy("slot").applyInArrow(run, PARTIAL), n * num_factors).reshape(v.shape) / groups
    if history is not None:
        m = FMModel(0.0, np.zeros(n), v, 1, use_bias=False, use_linear=False)
        history.append((rounds, _gradient(rows.select("x", "y"), m)[1] / s["all"]))
    release(rows)
    return v


# S10 ---------------------------------------------------------------------------
FORMAT_VERSION = "1.1"


def save_model(spark, model: FMModel, path: str) -> None:
    """Metadata JSON (class, version, sizes, range, task) + one-row parquet."""
    meta = {"class": "FMModel", "version": FORMAT_VERSION, "numFeatures": model.num_features,
            "numFactors": model.num_factors, "task": model.task,
            "min": model.min_target if math.isfinite(model.min_target) else None,
            "max": model.max_target if math.isfinite(model.max_target) else None,
            "useBias": model.use_bias, "useLinear": model.use_linear}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
    row = (float(model.w0), [float(x) for x in model.w], [float(x) for x in model.v.ravel()])
    spark.createDataFrame([row], "intercept double, weights array<double>, factors array<double>") \
         .coalesce(1).write.mode("overwrite").parquet(f"{path}/data")


def load_model(spark, path: str) -> FMModel:
    meta = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    if meta.get("class") != "FMModel" or meta.get("version") != FORMAT_VERSION:
        raise ValueError(f"not a saved FM model of version {FORMAT_VERSION}: {meta}")
    d = spark.read.parquet(f"{path}/data").first()
    n, k = int(meta["numFeatures"]), int(meta["numFactors"])
    if len(d["weights"]) != n or len(d["factors"]) != n * k:
        raise ValueError("saved FM data does not match its metadata sizes")
    return FMModel(d["intercept"], np.array(d["weights"]), np.array(d["factors"]).reshape(n, k),
                   int(meta["task"]), -math.inf if meta["min"] is None else meta["min"],
                   math.inf if meta["max"] is None else meta["max"],
                   use_bias=meta["useBias"], use_linear=meta["useLinear"])
