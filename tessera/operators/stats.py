"""Aggregations, summaries and ordering."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import cell_index, invalid_label


def grid_cell_counts(points: DataFrame, size: float, x: str = "x", y: str = "y") -> DataFrame:
    """Number of points per grid cell of side ``size`` (A1)."""
    return points.groupBy(cell_index(x, size).alias("cx"), cell_index(y, size).alias("cy")) \
                 .agg(F.count(F.lit(1)).alias("n"))


def frequent_items(baskets: DataFrame, min_count: int, items: str = "items") -> DataFrame:
    """Count per item over baskets, keep count >= min_count (A2 / Q1).

    Partial aggregation happens map-side; no order is promised (A13 sorts).
    """
    return (baskets.select(F.explode(items).alias("item"))
            .groupBy("item").agg(F.count(F.lit(1)).alias("freq"))
            .filter(F.col("freq") >= min_count))


def feature_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per-column count, mean, sample variance and std (A3), one row per feature."""
    stacked = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), F.col(c).cast("double").alias("v"))
                                            for i, c in enumerate(cols)])).alias("s")).select("s.*")
    return _summary(stacked)


def array_feature_summary(df: DataFrame, col: str = "features") -> DataFrame:
    """Same summary for an array<double> column: one row per array position (A3)."""
    stacked = df.select(F.posexplode(col).alias("feature", "v"))
    return _summary(stacked)


def _summary(stacked: DataFrame) -> DataFrame:
    return stacked.groupBy("feature").agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"),
        F.var_samp("v").alias("variance"), F.stddev_samp("v").alias("std"))


def label_histogram(df: DataFrame, label: str = "label", weight: str | None = None) -> DataFrame:
    """Weighted histogram of integer class labels (A4).

    Rows with weight 0 are ignored; negative weight raises; fractional or
    negative labels are left out here (see :func:`invalid_label_count`).
    Classes run 0..max with missing classes filled with zeros.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    checked = df.select(F.col(label).cast("double").alias("label"),
                        F.when(w < 0, F.raise_error(F.lit("instance weight has to be >= 0"))).otherwise(w).alias("w"))
    valid = checked.filter((F.col("w") != 0) & ~invalid_label("label"))
    per = valid.groupBy(F.col("label").cast("int").alias("cls")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("w").alias("weight_sum"))
    top = per.agg(F.max("cls")).first()[0]
    all_cls = df.sparkSession.range(0 if top is None else top + 1).select(F.col("id").cast("int").alias("cls"))
    return (all_cls.join(per, "cls", "left")
            .select("cls", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
                    F.coalesce("weight_sum", F.lit(0.0)).alias("weight_sum")))


def invalid_label_count(df: DataFrame, label: str = "label", weight: str | None = None) -> DataFrame:
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    return df.filter((w != 0) & invalid_label(label)).agg(F.count(F.lit(1)).alias("invalid"))


def min_max(df: DataFrame, col: str) -> DataFrame:
    """Minimum and maximum of a column (A5)."""
    return df.agg(F.min(col).alias("min_value"), F.max(col).alias("max_value"))


def sum_by_key(df: DataFrame, keys: list[str], value: str, out: str = "total") -> DataFrame:
    """Sum per key."""
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def top_k_per_key(df: DataFrame, key: str, k: int, order: list, out: str = "rank") -> DataFrame:
    """k best rows per key (A9): ``row_number() <= k`` so Spark plans a
    WindowGroupLimit that drops rows before the shuffle sort."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)


def degrees(edges: DataFrame, src: str = "src", dst: str = "dst", weight: str | None = None) -> DataFrame:
    """In-degree (count of edges ending at the vertex) and weighted degree (A10).

    The weighted degree sums weights over both ends of every edge.
    """
    w = F.col(weight) if weight else F.lit(1)
    indeg = edges.groupBy(F.col(dst).alias("id")).agg(F.count(F.lit(1)).alias("in_degree"))
    both = edges.select(F.col(src).alias("id"), w.alias("w")).unionByName(
        edges.select(F.col(dst).alias("id"), w.alias("w")))
    wdeg = both.groupBy("id").agg(F.sum("w").alias("weighted_degree"))
    return wdeg.join(indeg, "id", "left").fillna(0, ["in_degree"])


def loglog_tau(stats: DataFrame, total: int, n: str = "n", r: str = "r") -> DataFrame:
    """Buffer size from (sample size N, mean nearest distance R) rows.

    Fit ln R = a + b ln N by least squares; tau = exp(a + b ln total) / sqrt(-1/b).
    When b > 0 or the fit is undefined, fall back to the largest R.
    """
    lt = math.log(total)
    # identical (N, R) pairs (sizes at or above the table size) count once
    stats = stats.select(n, r).distinct()
    fit = stats.agg(F.regr_slope(F.log(r), F.log(n)).alias("b"),
                    F.regr_intercept(F.log(r), F.log(n)).alias("a"),
                    F.max(r).alias("r_max"))
    b, a = F.col("b"), F.col("a")
    tau = F.when(b.isNull() | F.isnan(b) | (b >= 0), F.col("r_max")) \
           .otherwise(F.exp(a + b * F.lit(lt)) / F.sqrt(-1.0 / b))
    return fit.select("a", "b", tau.alias("tau"))


def top_rows(df: DataFrame, n: int, order: list) -> DataFrame:
    """Global sort + limit (A13): planned as TakeOrderedAndProject (per-task top-n, then merge)."""
    return df.orderBy(*order).limit(n)


def bag_union(*dfs: DataFrame) -> DataFrame:
    """Union keeping duplicates, matched by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out
