"""Frequent patterns over baskets (Q1-Q3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_bounded, cut_lineage, release
from .ordered import row_ranks
from .stats import frequent_items


def item_ranks(baskets: DataFrame, min_count: int, items: str = "items") -> DataFrame:
    """Frequent items with their rank (0 = most frequent; ties by item)."""
    f = frequent_items(baskets, min_count, items)
    return row_ranks(f, [F.col("freq").desc(), F.col("item").asc()]).withColumn("rank", F.col("rank").cast("int"))


def conditional_transactions(baskets: DataFrame, min_count: int, partitions: int,
                             basket: str = "basket", items: str = "items") -> DataFrame:
    """Q2: each basket's frequent items as sorted ranks; for every target
    partition (rank mod ``partitions``) the prefix ending at the last item of
    that partition.  Output ``basket, part, prefix array<int>``."""
    ranks = item_ranks(baskets, min_count, items).select(F.col("item"), "rank")
    ex = baskets.select(basket, F.explode(items).alias("item")).join(broadcast_if_bounded(ranks), "item")
    per = ex.groupBy(basket).agg(F.array_sort(F.collect_set("rank")).alias("ranks"))
    idx = F.sequence(F.lit(0), F.size("ranks") - 1)
    parts = F.transform(F.sequence(F.lit(0), F.lit(partitions - 1)), lambda p: F.struct(
        p.alias("part"),
        F.array_max(F.filter(idx, lambda i: F.pmod(F.col("ranks")[i], F.lit(partitions)) == p)).alias("last")))
    out = per.select(basket, "ranks", F.explode(parts).alias("s")).filter(F.col("s.last").isNotNull())
    return out.select(basket, F.col("s.part").alias("part"),
                      F.slice("ranks", F.lit(1), F.col("s.last") + 1).alias("prefix"))


def frequent_itemsets(baskets: DataFrame, min_count: int, items: str = "items",
                      num_partitions: int | None = None) -> DataFrame:
    """Q3: all itemsets appearing in at least ``min_count`` baskets, with counts.

    Spark's parallel FP-growth does the work; baskets are de-duplicated
    first (repeats are rejected by it).  minSupport is passed as
    (minCount - 0.5) / n because the count threshold is a ceiling.
    """
    from pyspark.ml.fpm import FPGrowth
    # written once: the count and FP-growth's passes read the same table
    data = cut_lineage(baskets.select(F.array_distinct(items).alias("items")))
    n = data.count()
    fp = FPGrowth(itemsCol="items", minSupport=(min_count - 0.5) / max(n, 1), minConfidence=0.0)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    found = cut_lineage(fp.fit(data).freqItemsets)
    release(data)
    return found.select(F.array_sort("items").alias("items"), F.col("freq").cast("long").alias("freq"))
