"""Top-N recommendation from factor tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import DEFAULT_BROADCAST_BYTES
from . import blocks
from .ordered import row_ranks


def recommend_for_all(src: DataFrame, dst: DataFrame, num: int, *, src_id: str = "id",
                      dst_id: str = "id", features: str = "features", approximate: bool = False,
                      block_size: int = 4096, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                      force_blocked: bool = False) -> DataFrame:
    """Long form ``src, dst, rating, rank``: the ``num`` best dst rows per src row
    by dot product (R1 / R2).  With ``approximate`` (R3) dst falls in blocks of
    ``block_size`` rows in id order and each block keeps only
    ``ceil(num * block size / |dst|)`` candidates per src before the final top-N."""
    if approximate:
        n_dst = dst.count()
        blocked = row_ranks(dst.select(dst_id, features), [F.col(dst_id).asc()], "_block_no")
        blocked = blocked.withColumn("_block_no", F.expr(f"_block_no div {int(block_size)}"))
        res = blocks.top_k(src, blocked, num, qid=src_id, tid=dst_id, qvec=features, tvec=features,
                           metric="dot", block_rows=block_size, chunk_by_id="_block_no",
                           chunk_quota=(num, n_dst), broadcast_bytes=broadcast_bytes)
    else:
        res = blocks.top_k(src, dst, num, qid=src_id, tid=dst_id, qvec=features, tvec=features,
                           metric="dot", block_rows=block_size, broadcast_bytes=broadcast_bytes,
                           force_blocked=force_blocked)
    return res.select(F.col("qid").alias("src"), F.col("tid").alias("dst"),
                      F.col("score").alias("rating"), "rank")


def nest(long: DataFrame, src_col: str = "user", dst_col: str = "item") -> DataFrame:
    """``src, recommendations: array<struct<dst, rating>>`` ordered by rank (bounded by N)."""
    agg = long.groupBy("src").agg(F.array_sort(F.collect_list(F.struct("rank", "dst", "rating"))).alias("r"))
    return agg.select(F.col("src").alias(src_col),
                      F.transform("r", lambda s: F.struct(s["dst"].alias(dst_col),
                                                          s["rating"].cast("float").alias("rating"))).alias("recommendations"))


def recommend_for_all_users(users: DataFrame, items: DataFrame, num: int, **kw) -> DataFrame:
    return nest(recommend_for_all(users, items, num, **kw), "user", "item")


def recommend_for_all_items(users: DataFrame, items: DataFrame, num: int, **kw) -> DataFrame:
    return nest(recommend_for_all(items, users, num, **kw), "item", "user")


def tune_partitions(factors: DataFrame, partitions: int, key: str = "id") -> DataFrame:
    """Hash-partition the query side of the search on its id.  The search maps over these rows and never
    shuffles them, so this number of partitions is the number of the tasks of its first pass, which is the only one as
    long as the candidates fit the default broadcast bound, in however many slices."""
    return factors.repartition(partitions, key)
