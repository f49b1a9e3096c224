"""Aggregation and ordering analyses."""

from pyspark.sql import functions as F

from ..operators import stats as A
from . import inputs as I
from .catalog import register

MIN_COUNT = 60


@register("a1_grid_cell_counts", f"""
with p as ({I.POINTS_SQL})
select cast(floor(x / 0.06) as bigint) as cx, cast(floor(y / 0.06) as bigint) as cy, count(*) as n
from p group by 1, 2
""")
def a1_grid_cell_counts(spark, sf_dir):
    return A.grid_cell_counts(I.points(spark, sf_dir), 0.06)


@register("a2_frequent_items", f"""
with b as ({I.BASKET_ITEMS_SQL})
select item, count(*) as freq from b group by item having count(*) >= {MIN_COUNT}
""")
def a2_frequent_items(spark, sf_dir):
    return A.frequent_items(I.baskets(spark, sf_dir), MIN_COUNT)


@register("a3_feature_summary", f"""
with v as ({I.VECTORS_SQL}),
e as (select unnest(features) as x, unnest(generate_series(0, len(features) - 1)) as pos from v)
select cast(pos as int) as feature, count(x) as n, round(avg(x), 6) as mean,
       round(var_samp(x), 6) as variance, round(stddev_samp(x), 6) as std
from e group by pos
""")
def a3_feature_summary(spark, sf_dir):
    s = A.array_feature_summary(I.vectors(spark, sf_dir))
    return s.select("feature", "n", *[F.round(c, 6).alias(c) for c in ("mean", "variance", "std")])


@register("a3_column_summary", """
with s as (select 0 as feature, l_quantity as v from lineitem union all select 1, l_extendedprice from lineitem
           union all select 2, l_discount from lineitem union all select 3, l_tax from lineitem)
select feature, count(v) as n, round(avg(v), 6) as mean, round(var_samp(v), 6) as variance,
       round(stddev_samp(v), 6) as std from s group by feature
""")
def a3_column_summary(spark, sf_dir):
    s = A.feature_summary(I.table(spark, sf_dir, "lineitem"), I.REGRESSION_FEATURES)
    return s.select("feature", "n", *[F.round(c, 6).alias(c) for c in ("mean", "variance", "std")])


_HIST_SRC = "select l_linenumber - 1 as label, l_discount * 100 as weight from lineitem"


@register("a4_weighted_label_histogram", f"""
with s as ({_HIST_SRC}),
v as (select cast(label as int) as cls, count(*) as n, sum(weight) as weight_sum from s
      where weight <> 0 and not (label <> floor(label) or label < 0) group by 1),
c as (select unnest(generate_series(0, (select max(cls) from v))) as cls)
select cast(c.cls as int) as cls, cast(coalesce(n, 0) as bigint) as n, round(coalesce(weight_sum, 0.0), 6) as weight_sum
from c left join v using (cls)
""")
def a4_weighted_label_histogram(spark, sf_dir):
    li = I.table(spark, sf_dir, "lineitem").select((F.col("l_linenumber") - 1).alias("label"),
                                                    (F.col("l_discount") * 100).alias("weight"))
    h = A.label_histogram(li, "label", "weight")
    return h.select("cls", "n", F.round("weight_sum", 6).alias("weight_sum"))


@register("a4_invalid_label_count", """
select count(*) as invalid from events where value <> 0 and ((value / 10 - 20) <> floor(value / 10 - 20) or value / 10 - 20 < 0)
""")
def a4_invalid_label_count(spark, sf_dir):
    ev = I.table(spark, sf_dir, "events").select((F.col("value") / 10 - 20).alias("label"), F.col("value").alias("w"))
    return A.invalid_label_count(ev, "label", "w")


@register("a5_min_max_label", """
select min(l_extendedprice) as min_value, max(l_extendedprice) as max_value from lineitem
""")
def a5_min_max_label(spark, sf_dir):
    return A.min_max(I.table(spark, sf_dir, "lineitem"), "l_extendedprice")


@register("a6_sum_by_key", """
select l_suppkey, round(sum(l_extendedprice), 6) as total from lineitem group by l_suppkey
""")
def a6_sum_by_key(spark, sf_dir):
    s = A.sum_by_key(I.table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice")
    return s.select("l_suppkey", F.round("total", 6).alias("total"))


@register("a9_top_k_per_key", """
select l_suppkey, l_orderkey, l_linenumber, l_extendedprice, rank from (
  select l_suppkey, l_orderkey, l_linenumber, l_extendedprice,
         row_number() over (partition by l_suppkey order by l_extendedprice desc, l_orderkey, l_linenumber) as rank
  from lineitem) where rank <= 3
""")
def a9_top_k_per_key(spark, sf_dir):
    li = I.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    r = A.top_k_per_key(li, "l_suppkey", 3, [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber"])
    return r.withColumn("rank", F.col("rank").cast("bigint"))


@register("a13_sort_limit_first", f"""
with b as ({I.BASKET_ITEMS_SQL})
select item, count(*) as freq from b group by item order by freq desc, item limit 10
""")
def a13_sort_limit_first(spark, sf_dir):
    items = A.frequent_items(I.baskets(spark, sf_dir), 1)
    return A.top_rows(items, 10, [F.col("freq").desc(), F.col("item")])


@register("a14_bag_union", """
select o_orderkey, o_orderpriority as tag from orders where o_orderpriority = '1-URGENT'
union all
select o_orderkey, o_orderstatus as tag from orders where o_orderstatus = 'F'
""")
def a14_bag_union(spark, sf_dir):
    o = I.table(spark, sf_dir, "orders")
    a = o.filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", F.col("o_orderpriority").alias("tag"))
    b = o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", F.col("o_orderstatus").alias("tag"))
    return A.bag_union(a, b)


@register("a8_collect_bounded_group", f"""
with b as ({I.BASKET_ITEMS_SQL})
select basket, list_sort(list(item)) as items, count(*) as n_items from b group by basket
""")
def a8_collect_bounded_group(spark, sf_dir):
    """Gather a group only where its size is bounded by a dictionary (brands)."""
    b = I.baskets(spark, sf_dir)
    return b.select("basket", "items", F.size("items").cast("bigint").alias("n_items"))
