"""Projection, filtering, sampling and feature preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_bounded, cut_lineage
from .ordered import row_ranks

# Fibonacci hashing constant: frac(id * PHI) is a deterministic uniform-ish
# value in [0, 1) that any SQL engine computes identically on doubles.
PHI = 0.6180339887498949


def unit_hash(id_col, seed: int = 0) -> Column:
    """Deterministic value in [0, 1) from an integer id (seeded)."""
    v = (F.col(id_col).cast("double") + F.lit(float(seed) * 7919.0)) * F.lit(PHI)
    return v - F.floor(v)


def filter_sql(df: DataFrame, condition: str) -> DataFrame:
    """Filter by SQL predicate text."""
    return df.filter(condition)


def with_constant(df: DataFrame, name: str, value, cols: list[str] | None = None) -> DataFrame:
    """Add a literal column and select / reorder."""
    out = df.withColumn(name, F.lit(value))
    return out.select(*(cols or out.columns))


def first_n_formula(columns: list[str], target: str, n: int) -> str:
    """``target ~ a + b + ...`` from the first ``n`` columns, target excluded."""
    feats = [c for c in columns[:n] if c != target]
    if not feats:
        raise ValueError("no feature columns among the first n")
    return f"{target} ~ " + " + ".join(feats)


def hash_split(df: DataFrame, id_col: str, weights: list[float], seed: int = 0,
               out: str = "split") -> DataFrame:
    """Deterministic split by id hash: adds ``out`` = index of the part (P5 twin)."""
    total = float(sum(weights))
    u = unit_hash(id_col, seed)
    expr = F.lit(len(weights) - 1)
    acc = 0.0
    bounds = []
    for w in weights[:-1]:
        acc += w / total
        bounds.append(acc)
    for i in reversed(range(len(bounds))):
        expr = F.when(u < F.lit(bounds[i]), F.lit(i)).otherwise(expr)
    return df.withColumn(out, expr)


def random_split(df: DataFrame, weights: list[float], seed: int = 123) -> list[DataFrame]:
    """Spark's seeded random split (P5)."""
    return df.randomSplit(weights, seed)


def sample_sizes(df: DataFrame, id_col: str, sizes: list[int], total: int | None = None,
                 seed: int = 0) -> DataFrame:
    """Several samples of target sizes in one pass.

    Each row is kept for size m when its hash value is < m / total; the
    explode makes one output row per (size, kept row) with no extra scan.
    """
    n = total if total is not None else df.count()
    u = unit_hash(id_col, seed)
    fr = F.explode(F.array(*[F.struct(F.lit(m).alias("size"), F.lit(min(1.0, m / max(n, 1))).alias("fraction"))
                             for m in sizes])).alias("s")
    return (df.select("*", fr).filter(u < F.col("s.fraction"))
              .select(F.col("s.size").alias("sample_size"), *df.columns))


def sample_fraction(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample without replacement (P6, mini-batches)."""
    return df.sample(False, fraction, seed)


def dense_index(df: DataFrame, order_col: str, out: str = "row_index") -> DataFrame:
    """0-based position of each row in ``order_col`` order, computed distributed.

    Rows of equal keys stand in any order.  Range-partitioned, never a window
    over the whole table.
    """
    return row_ranks(df, [F.col(order_col).asc()], out)


def with_row_id(df: DataFrame, id_col: str | None = None, out: str = "row_id") -> DataFrame:
    """Stable row identity: an existing key column, else a materialised generated id."""
    if id_col is not None:
        return df.withColumn(out, F.col(id_col))
    # monotonically_increasing_id is only stable once materialised.
    return cut_lineage(df.withColumn(out, F.monotonically_increasing_id()))


def assemble_array(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Columns -> one array<double> column (P9, array form of the vector assembler)."""
    return df.withColumn(out, F.array(*[F.col(c).cast("double") for c in cols]))


def to_ml_vector(df: DataFrame, col: str = "features", out: str | None = None) -> DataFrame:
    """array<double> -> ml Vector, only at the pyspark.ml border."""
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out or col, array_to_vector(F.col(col)))


def formula_encode(df: DataFrame, formula: str, features: str = "features", label: str = "label"):
    """RFormula fit + transform (P10); returns (model, transformed)."""
    from pyspark.ml.feature import RFormula
    model = RFormula(formula=formula, featuresCol=features, labelCol=label).fit(df)
    return model, model.transform(df)


def label_index_table(df: DataFrame, col: str) -> DataFrame:
    """Frequency-ordered index of the distinct values of ``col``.

    Order: count descending, value ascending; index 0-based.  The table has
    one row per distinct label; however many they are, no task orders them all.
    """
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("freq"))
    ranked = row_ranks(counts, [F.col("freq").desc(), F.col("value").asc()], "label_index")
    return ranked.withColumn("label_index", F.col("label_index").cast("double"))


def index_labels(df: DataFrame, col: str, out: str = "label_index") -> DataFrame:
    table = label_index_table(df, col).select(F.col("value").alias(col), F.col("label_index").alias(out))
    return df.join(broadcast_if_bounded(table), col, "left")


def labels_from_index(df: DataFrame, index_col: str, table: DataFrame, out: str = "label_value") -> DataFrame:
    """Inverse of :func:`index_labels`."""
    t = table.select(F.col("label_index").alias(index_col), F.col("value").alias(out))
    return df.join(broadcast_if_bounded(t), index_col, "left")


def scale_fixed(df: DataFrame, cols: list[str], lo: float, hi: float) -> DataFrame:
    """Map a fixed range [lo, hi] onto [0, 1] (P12, e.g. 0-255 pixels)."""
    out = df
    for c in cols:
        out = out.withColumn(c, (F.col(c) - F.lit(lo)) / F.lit(hi - lo))
    return out


def min_max_scale(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Scale each column to [0, 1] with min/max fitted on ``fit_on``.

    The fit is one aggregate row (2 numbers per column) turned into literals.
    """
    src = fit_on if fit_on is not None else df
    row = src.agg(*[F.min(c).alias(f"mn_{c}") for c in cols], *[F.max(c).alias(f"mx_{c}") for c in cols]).first()
    out = df
    for c in cols:
        mn, mx = row[f"mn_{c}"], row[f"mx_{c}"]
        span = (mx - mn) if mx is not None and mn is not None else None
        expr = F.lit(0.0) if not span else (F.col(c) - F.lit(mn)) / F.lit(span)
        out = out.withColumn(c, expr)
    return out


def distinct_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Distinct rows or keys."""
    return df.dropDuplicates(cols) if cols else df.distinct()


def class_count_from_metadata(df: DataFrame, col: str) -> int | None:
    """Number of classes from ML attribute metadata: binary 2, nominal n, else None."""
    meta = df.schema[col].metadata.get("ml_attr")
    if not meta:
        return None
    kind = meta.get("type")
    if kind == "binary":
        return 2
    if kind == "nominal":
        if "num_vals" in meta:
            return int(meta["num_vals"])
        vals = meta.get("vals")
        return len(vals) if vals is not None else None
    return None
