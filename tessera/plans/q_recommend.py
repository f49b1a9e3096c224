"""Recommendation analyses (R1-R4): every embedding as user and as item."""

from pyspark.sql import functions as F

from ..operators import recommend as R
from . import inputs as I
from .catalog import register

NUM = 10
BLOCK = 64

_SCORES_SQL = f"""
with v as ({I.VECTORS_SQL}),
s as (select a.id as src, b.id as dst, list_inner_product(a.features, b.features) as rating
      from v a join v b on true)
"""


def _long(df):
    return df.select("src", "dst", F.round("rating", 6).alias("rating"), F.col("rank").cast("bigint").alias("rank"))


def _factors(spark, sf_dir):
    v = I.vectors(spark, sf_dir)
    return v.select("id", F.col("features").cast("array<float>").alias("features"))


@register("r1_top_items_per_user", _SCORES_SQL + f"""
select src, dst, round(rating, 6) as rating, rank from (
  select *, row_number() over (partition by src order by round(rating, 9) desc, dst) as rank from s)
where rank <= {NUM}
""")
def r1_top_items_per_user(spark, sf_dir):
    f = _factors(spark, sf_dir)
    return _long(R.recommend_for_all(f, f, NUM))


@register("r2_top_users_per_item_blocked", _SCORES_SQL + f"""
select dst as src, src as dst, round(rating, 6) as rating, rank from (
  select *, row_number() over (partition by dst order by round(rating, 9) desc, src) as rank from s)
where rank <= {NUM}
""")
def r2_top_users_per_item_blocked(spark, sf_dir):
    f = _factors(spark, sf_dir)
    return _long(R.recommend_for_all(f, f, NUM, block_size=BLOCK, force_blocked=True))


@register("r1_nested_recommendations", _SCORES_SQL + f"""
select src as user, list(dst order by rank) as items, list(round(rating, 4) order by rank) as ratings from (
  select *, row_number() over (partition by src order by round(rating, 9) desc, dst) as rank from s)
where rank <= {NUM} group by src
""")
def r1_nested_recommendations(spark, sf_dir):
    f = _factors(spark, sf_dir)
    n = R.recommend_for_all_users(f, f, NUM)
    return n.select("user", F.transform("recommendations", lambda s: s["item"]).alias("items"),
                    F.transform("recommendations", lambda s: F.round(s["rating"].cast("double"), 4)).alias("ratings"))


@register("r3_approx_top_n_block_quota", _SCORES_SQL + f""",
n as (select count(*) as total from v),
p as (select total from n),
no as (select id, (row_number() over (order by id) - 1) // {BLOCK} as blk from v),
blk as (select s.*, no.blk from s join no on no.id = s.dst),
bsz as (select blk, count(*) / (select total from n) as bsize from blk group by blk),
q as (select blk.*, row_number() over (partition by src, blk.blk order by round(rating, 9) desc, dst) as br,
             ({NUM} * bsz.bsize + p.total - 1) // p.total as quota
      from blk join bsz using (blk), p)
select src, dst, round(rating, 6) as rating, rank from (
  select *, row_number() over (partition by src order by round(rating, 9) desc, dst) as rank from q where br <= quota)
where rank <= {NUM}
""")
def r3_approx_top_n_block_quota(spark, sf_dir):
    f = _factors(spark, sf_dir)
    return _long(R.recommend_for_all(f, f, NUM, approximate=True, block_size=BLOCK))


@register("r4_partition_tuning", _SCORES_SQL + f"""
select src, dst, round(rating, 6) as rating, rank from (
  select *, row_number() over (partition by src order by round(rating, 9) desc, dst) as rank from s)
where rank <= {NUM}
""")
def r4_partition_tuning(spark, sf_dir):
    f = R.tune_partitions(_factors(spark, sf_dir), 4)
    return _long(R.recommend_for_all(f, f, NUM, block_size=BLOCK, force_blocked=True))


@register("s12_als_factor_tables")
def s12_als_factor_tables(spark, sf_dir):
    """Factor tables of a fitted ALS model (implicit purchase counts of brands
    per customer over all orders), then top-N brands per customer."""
    from pyspark.ml.recommendation import ALS
    from ..sources.files import factor_tables
    li = I.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    o = I.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    pa = I.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    from ..operators.features import index_labels
    pa = index_labels(pa, "p_brand", "brand_index")
    counts = (li.join(o, "l_orderkey").join(pa, "l_partkey")
              .groupBy(F.col("o_custkey").cast("int").alias("user"), F.col("brand_index").cast("int").alias("item"))
              .agg(F.count(F.lit(1)).cast("float").alias("rating")))
    model = ALS(rank=8, maxIter=5, implicitPrefs=True, seed=7, userCol="user", itemCol="item",
                ratingCol="rating", coldStartStrategy="drop").fit(counts)
    users, items = factor_tables(model)
    return _long(R.recommend_for_all(users, items, 3))
