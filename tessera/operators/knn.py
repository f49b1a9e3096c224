"""k-nearest-neighbour join, classifier and regressor."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import DEFAULT_BROADCAST_BYTES
from . import blocks
from .stats import invalid_label_count, label_histogram, loglog_tau
from .features import unit_hash


@dataclass
class KNNParams:
    """Search parameters (N8).  The tree sizes of the tree-based original drive the pivot-routed search: its top tree
    becomes ``top_tree_size / top_tree_leaf_size`` pivots, the leaves of its sub-trees become leaves of
    ``sub_tree_leaf_size`` candidates around a pivot."""
    k: int = 5
    features_col: str = "features"
    id_col: str = "id"
    label_col: str = "label"
    weight_col: str | None = None
    aux_cols: list[str] = field(default_factory=list)
    max_distance: float | None = None          # N3: radius cap, default infinity
    top_tree_size: int = 1000                 # with the leaf size: number of pivots where ``pivots`` is negative
    top_tree_leaf_size: int = 10
    sub_tree_leaf_size: int = 30              # candidates in a leaf around a pivot
    buffer_size: float = -1.0                 # < 0: estimate tau (N7) when balance > 0
    balance_threshold: float = 0.7
    pivots: int = 0                           # 0 = no routing (exact, by slices); < 0 = from the tree sizes
    exact: bool = True                        # exact bound routing vs tau buffer
    block_rows: int = 4096
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES
    seed: int = 7
    exclude_self: bool = False
    force_blocked: bool = False               # skip the broadcast path (tests / benchmarks)

    def pivot_count(self) -> int:
        return self.pivots if self.pivots >= 0 else -(-self.top_tree_size // max(1, self.top_tree_leaf_size))


def knn_pairs(query: DataFrame, train: DataFrame, p: KNNParams, tau: float | None = None) -> DataFrame:
    """N1 / N2 / N3 long form: ``id, neighbor_id, distance, rank, aux_*``."""
    aux = list(dict.fromkeys(p.aux_cols))
    res = blocks.top_k(query, train, p.k, qid=p.id_col, tid=p.id_col, qvec=p.features_col,
                       tvec=p.features_col, metric="l2", aux=aux, exclude_self=p.exclude_self,
                       max_distance=p.max_distance, pivots=p.pivot_count(),
                       tau=None if p.exact else tau, block_rows=p.block_rows, leaf_rows=p.sub_tree_leaf_size,
                       broadcast_bytes=p.broadcast_bytes, seed=p.seed,
                       force_blocked=p.force_blocked)
    return res.withColumnRenamed("qid", p.id_col).withColumnRenamed("tid", "neighbor_id")


def knn_join(query: DataFrame, train: DataFrame, p: KNNParams, tau: float | None = None) -> DataFrame:
    """N4 + J1: every query row with ``neighbors`` (array of structs ordered by
    distance) and ``distances``; rows with no neighbour get empty arrays."""
    pairs = knn_pairs(query, train, p, tau)
    aux_struct = [F.col(f"aux_{a}").alias(a) for a in p.aux_cols]
    nb = pairs.groupBy(p.id_col).agg(
        F.array_sort(F.collect_list(F.struct("rank", F.col("neighbor_id").alias("id"), "distance",
                                             *aux_struct))).alias("_nb"))
    nb = nb.select(p.id_col,
                   F.transform("_nb", lambda s: s.dropFields("rank", "distance")).alias("neighbors"),
                   F.transform("_nb", lambda s: s["distance"]).alias("distances"))
    out = query.join(nb, p.id_col, "left")
    empty_n = F.array().cast(nb.schema["neighbors"].dataType)
    return (out.withColumn("neighbors", F.coalesce("neighbors", empty_n))
               .withColumn("distances", F.coalesce("distances", F.array().cast("array<double>"))))


def knn_classify(query: DataFrame, train: DataFrame, p: KNNParams, num_classes: int | None = None,
                 tau: float | None = None) -> DataFrame:
    """Votes per class (weight or 1) among the k neighbours; prediction is
    the class with most votes (ties -> smallest class); probability = votes /
    total over classes 0..n-1.  Labels must be class indices (A4 checks)."""
    bad = invalid_label_count(train, p.label_col, p.weight_col).first()["invalid"]
    if bad:
        raise ValueError(f"{bad} training rows have a label that is no class index")
    if num_classes is None:
        h = label_histogram(train, p.label_col, p.weight_col)
        num_classes = int(h.agg(F.max("cls")).first()[0]) + 1
    aux = [p.label_col] + ([p.weight_col] if p.weight_col else [])
    q = KNNParams(**{**p.__dict__, "aux_cols": aux})
    pairs = knn_pairs(query, train, q, tau)
    w = F.col(f"aux_{p.weight_col}") if p.weight_col else F.lit(1.0)
    votes = pairs.groupBy(p.id_col, F.col(f"aux_{p.label_col}").cast("int").alias("cls")).agg(
        F.sum(w).alias("votes"))
    win = Window.partitionBy(p.id_col).orderBy(F.col("votes").desc(), F.col("cls").asc())
    ranked = votes.withColumn("_r", F.row_number().over(win))
    per = ranked.groupBy(p.id_col).agg(
        F.max(F.when(F.col("_r") == 1, F.col("cls"))).cast("double").alias("prediction"),
        F.sum("votes").alias("_total"),
        F.map_from_entries(F.collect_list(F.struct("cls", "votes"))).alias("_v"))
    prob = F.transform(F.sequence(F.lit(0), F.lit(num_classes - 1)),
                       lambda i: F.coalesce(F.col("_v")[i], F.lit(0.0)) / F.nullif(F.col("_total"), F.lit(0.0)))
    per = per.select(p.id_col, "prediction", prob.alias("probability"),
                     F.transform(F.sequence(F.lit(0), F.lit(num_classes - 1)),
                                 lambda i: F.coalesce(F.col("_v")[i], F.lit(0.0))).alias("raw"))
    return query.join(per, p.id_col, "left")


def knn_regress(query: DataFrame, train: DataFrame, p: KNNParams, tau: float | None = None) -> DataFrame:
    """Weighted mean of neighbour labels; null when no neighbour is left."""
    aux = [p.label_col] + ([p.weight_col] if p.weight_col else [])
    q = KNNParams(**{**p.__dict__, "aux_cols": aux})
    pairs = knn_pairs(query, train, q, tau)
    w = F.col(f"aux_{p.weight_col}") if p.weight_col else F.lit(1.0)
    y = F.col(f"aux_{p.label_col}").cast("double")
    per = pairs.groupBy(p.id_col).agg((F.sum(w * y) / F.nullif(F.sum(w), F.lit(0.0))).alias("prediction"))
    return query.join(per, p.id_col, "left")


def avg_nearest_distance(df: DataFrame, sizes: list[int], p: KNNParams, total: int | None = None) -> DataFrame:
    """For each sample size N, the mean over sampled points of the
    smallest positive distance to another sampled point.  Samples are
    deterministic by id hash (each the first ones of one hash order)."""
    n = total if total is not None else df.count()
    u = unit_hash(p.id_col, p.seed)
    out = None
    for m in sizes:
        s = df.filter(u < F.lit(min(1.0, m / max(n, 1))))
        nn = blocks.top_k(s, s, 1, qid=p.id_col, tid=p.id_col, qvec=p.features_col, tvec=p.features_col,
                          metric="l2", min_positive=True, block_rows=p.block_rows,
                          broadcast_bytes=p.broadcast_bytes, seed=p.seed)
        part = nn.agg(F.count(F.lit(1)).alias("n_points"), F.avg("distance").alias("r")) \
                 .select(F.lit(m).alias("sample_size"), "n_points", "r")
        out = part if out is None else out.unionByName(part)
    return out


def estimate_tau(train: DataFrame, p: KNNParams, sizes: list[int] | None = None) -> DataFrame:
    """Tau from sample sizes 100..1000 (step 100) via the log-log fit."""
    n = train.count()
    sizes = sizes or list(range(100, 1001, 100))
    stats = avg_nearest_distance(train, sizes, p, n)
    return loglog_tau(stats.withColumnRenamed("n_points", "n"), n, n="n", r="r")
