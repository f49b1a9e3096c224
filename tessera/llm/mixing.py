"""Mixing sources to target weights, in DataFrame expressions only.

Every document gets a hash-random key (md5 of its id).  Within a source the
documents are taken in key order until the source's word budget is spent; a
budget above the source's size repeats the source in whole epochs first.  The
place of the cut is found from distributed prefix sums: word counts are
summed per source and key range, the running sums over the ranges show the
range that holds the cut, and only that range is sorted row by row.  Each
document's share then follows from its own key and its source's cut, so no
source, however hot, meets in one task and no text is shuffled.

Defined cases: a null text has size 0 and takes nothing; a null source is a
source of its own, last in order; a null id counts as the empty id; rows with
equal ids have equal keys and share a cut that falls on them in proportion to
their sizes; with no words at all every target is 0; an empty table gives an
empty result; other columns are kept by ``mix`` and not read by ``shares``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_bounded, cut_lineage
from .common import documents

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
ROWS_PER_RANGE = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target: shares of the total by weight, none above ``max_epochs`` times its source.

    One row per source.  A common level (target = level * weight) is raised
    as sources reach their caps in the order cap / weight; the level that
    spends the whole total is the highest of the candidate levels.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    position = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (position + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(max_epochs))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    behind = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("level", (F.sum("source_size").over(every) - before) / behind)
    return s.withColumn("level", F.max("level").over(every)) \
            .select("source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def cuts(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source_size, target, epochs, cut_key, cut_words (taken among the rows of the cut key), cut_size."""
    n = sized.count()
    ranges = 1 << max(4, math.ceil(math.log2(max(n, 1) / ROWS_PER_RANGE + 1)))
    r = (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * ranges).bitwiseAND(F.lit((ranges << 32) - 1))
    ranged = sized.withColumn("range", F.shiftright(r, 32))
    sums = cut_lineage(ranged.groupBy("source", "range").agg(F.sum("size").alias("w")))
    goal = targets(sums.groupBy("source").agg(F.sum("w").alias("source_size")), weights, max_epochs)
    budget = F.round("target").cast("long")
    goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(0)) \
               .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    goal = cut_lineage(goal)
    along = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = sums.withColumn("upto", F.sum("w").over(along))
    small = broadcast_if_bounded(goal.withColumnRenamed("source", "s"))
    at = held.join(small, F.col("source").eqNullSafe(F.col("s"))) \
             .filter("upto - w <= rest and rest < upto") \
             .select(F.col("s"), F.col("range").alias("cut_range"), (F.col("rest") - F.col("upto") + F.col("w")).alias("left"))
    at = broadcast_if_bounded(cut_lineage(at))
    inside = ranged.join(at, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("cut_range"))) \
                   .groupBy("s", "key").agg(F.sum("size").alias("w"), F.max("left").alias("left"))
    keyed = Window.partitionBy("s").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = inside.withColumn("upto", F.sum("w").over(keyed)).filter("upto - w <= left and left < upto") \
                .select("s", F.col("key").alias("cut_key"), (F.col("left") - F.col("upto") + F.col("w")).alias("cut_words"),
                        F.col("w").alias("cut_size"))
    return goal.join(cut, goal["source"].eqNullSafe(cut["s"]), "left").drop("s", "rest")


def _taken() -> Column:
    part = F.when(F.col("key") < F.col("cut_key"), F.col("size")) \
            .when(F.col("key") == F.col("cut_key"), F.expr("(cut_words * size) div cut_size")).otherwise(0)
    return (F.col("epochs") * F.col("size") + part).cast("long")


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       words_in(F.col("text")).alias("size"), random_key(F.col("doc_id")).alias("key"))


def shares(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (words of this document in the mix, repeats counted)."""
    sized = cut_lineage(_sized(docs))
    small = broadcast_if_bounded(cut_lineage(cuts(sized, weights, max_epochs)).withColumnRenamed("source", "s"))
    return sized.join(small, F.col("source").eqNullSafe(F.col("s"))) \
                .select("doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target",
                        _taken().alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The rows of the mix with the columns of ``docs``: a document stands as often as it is taken whole;
    the one on which a source's cut falls stands once more if at least half of it is taken (pipeline stage)."""
    sized = cut_lineage(_sized(docs))
    small = broadcast_if_bounded(cut_lineage(cuts(sized, weights, max_epochs)).withColumnRenamed("source", "s")
                                 .select(F.struct("*").alias("_cut")))
    # all columns of the documents travel in one struct, so none can clash with the operator's own
    rows = docs.select(F.struct("*").alias("_row"))
    rows = rows.withColumn("size", words_in(F.col("_row.text"))).withColumn("key", random_key(F.col("_row.doc_id"))) \
               .withColumn("_s", F.col("_row.source").cast("string"))
    out = rows.join(small, F.col("_s").eqNullSafe(F.col("_cut.s"))).select("_row", "size", "key", "_cut.*")
    copies = F.when(F.col("size") > 0, F.round(_taken() / F.col("size"))).otherwise(0).cast("int")
    return out.withColumn("_n", copies).filter("_n > 0") \
              .select("_row", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy")).select("_row.*")


def op6_mixing(spark, sf_dir) -> DataFrame:
    return shares(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source")


ORACLE_SQL = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
                  md5(coalesce(doc_id::varchar, '')) as key from documents),
s as (select source, sum(size)::bigint as source_size from d group by 1),
w as (select *, 3.0 * source_size as cap,
             (case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end)::double as weight from s),
l as (select *, (sum(source_size) over () - coalesce(sum(cap) over (order by cap / weight, source nulls last
                   rows between unbounded preceding and 1 preceding), 0))::double
                / sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as level from w),
t as (select source, source_size, least(cap::double, max(level) over () * weight) as target from l),
b as (select *, case when source_size > 0 then round(target)::bigint // source_size else 0 end as epochs,
             round(target)::bigint - case when source_size > 0 then round(target)::bigint // source_size else 0 end * source_size as rest from t),
r as (select d.*, sum(size) over (partition by source order by key) as upto, sum(size) over (partition by source, key) as g from d)
select doc_id, size, source_size, target, r.source,
       (epochs * size + case when upto <= rest then size when upto - g <= rest and g > 0 then ((rest - (upto - g)) * size) // g else 0 end)::bigint as taken
from r join b on r.source is not distinct from b.source"""
