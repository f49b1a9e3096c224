"""Derived inputs built from the driver tables, each in Spark form and SQL form.

The SQL forms are DuckDB-dialect CTE bodies over the same table names; they
are the oracle's view of the very same derivation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- scored labels (E1, E3): score = round(value), label = purchase ----------
def scores(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("id"), F.round("value").alias("score"),
                     F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("label"))


SCORES_SQL = ("select event_id as id, round(value) as score, "
              "case when event_type = 'purchase' then 1 else 0 end as label from events")


# --- vectors (N*, R*): embeddings as double arrays ---------------------------
def vectors(spark, sf_dir) -> DataFrame:
    em = table(spark, sf_dir, "embeddings")
    return em.select(F.col("vec_id").alias("id"),
                     F.col("embedding").cast("array<double>").alias("features"),
                     F.col("label"))


VECTORS_SQL = "select vec_id as id, embedding::double[] as features, label from embeddings"


# --- 2-D points (D*): first two entries of each embedding --------------------
def points(spark, sf_dir) -> DataFrame:
    em = table(spark, sf_dir, "embeddings")
    return em.select(F.col("vec_id").alias("id"),
                     F.col("embedding")[0].cast("double").alias("x"),
                     F.col("embedding")[1].cast("double").alias("y"))


POINTS_SQL = ("select vec_id as id, embedding[1]::double as x, embedding[2]::double as y "
              "from embeddings")


# --- baskets (Q*): distinct brand per order ----------------------------------
def baskets(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    pa = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return (li.join(pa, "l_partkey").groupBy(F.col("l_orderkey").alias("basket"))
            .agg(F.array_sort(F.collect_set("p_brand")).alias("items")))


BASKET_ITEMS_SQL = ("select distinct l_orderkey as basket, p_brand as item "
                    "from lineitem join part on l_partkey = p_partkey")


# --- rows for the linear / FM models: numeric lineitem columns ---------------
REGRESSION_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def regression_rows(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        (F.col("l_quantity") / 50.0).alias("x0"),
        (F.col("l_extendedprice") / 10000.0).alias("x1"),
        (F.col("l_discount") * 10.0).alias("x2"),
        (F.col("l_tax") * 10.0).alias("x3"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"))


REGRESSION_SQL = ("select l_orderkey * 8 + l_linenumber as id, l_quantity / 50.0 as x0, "
                  "l_extendedprice / 10000.0 as x1, l_discount * 10.0 as x2, l_tax * 10.0 as x3, "
                  "case when l_returnflag = 'R' then 1.0 else 0.0 end as label from lineitem")


# --- kNN graph (G*): each vector to its k nearest others, made canonical ------
def knn_graph(spark, sf_dir, k: int = 5) -> DataFrame:
    from ..operators.knn import KNNParams, knn_pairs
    v = vectors(spark, sf_dir)
    pairs = knn_pairs(v, v, KNNParams(k=k, exclude_self=True))
    g = pairs.groupBy(F.least("id", "neighbor_id").alias("src"), F.greatest("id", "neighbor_id").alias("dst")) \
             .agg(F.min("distance").alias("distance"))
    return g.withColumn("weight", F.round(F.col("distance") * 1000).cast("bigint"))


def knn_graph_sql(k: int = 5) -> str:
    return f"""select least(id, nid) as src, greatest(id, nid) as dst, min(dist) as distance,
       cast(round(min(dist) * 1000) as bigint) as weight from (
  select id, nid, dist, row_number() over (partition by id order by round(dist, 9), nid) as rk from (
    select a.vec_id as id, b.vec_id as nid,
           list_distance(a.embedding::double[], b.embedding::double[]) as dist
    from embeddings a join embeddings b on a.vec_id <> b.vec_id)) where rk <= {k} group by 1, 2"""


def graph_vertices(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"))


VERTICES_SQL = "select vec_id as id from embeddings"


# --- 3-class rows for the pyspark.ml jobs: label = return flag index ---------
def class_rows(spark, sf_dir) -> DataFrame:
    r = regression_rows(spark, sf_dir).drop("label")
    li = table(spark, sf_dir, "lineitem")
    lab = F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0)
    return li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
                     (F.col("l_quantity") / 50.0).alias("x0"), (F.col("l_extendedprice") / 10000.0).alias("x1"),
                     (F.col("l_discount") * 10.0).alias("x2"), (F.col("l_tax") * 10.0).alias("x3"),
                     lab.alias("label"))


# --- credit-style integer fields for the regression-table scorer (M14) -------
def credit_rows(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.col("l_linenumber").alias("pay_0"),
                     F.floor(F.col("l_quantity") / 10).cast("int").alias("pay_2"),
                     F.round(F.col("l_discount") * 100).cast("int").alias("pay_3"),
                     F.round(F.col("l_tax") * 100).cast("int").alias("pay_4"),
                     (F.col("l_linenumber") % 3).alias("pay_5"),
                     F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("pay_6"),
                     F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("next_month"))


CREDIT_SQL = ("select l_orderkey, l_linenumber, l_linenumber as pay_0, cast(floor(l_quantity / 10) as int) as pay_2, "
              "cast(round(l_discount * 100) as int) as pay_3, cast(round(l_tax * 100) as int) as pay_4, "
              "l_linenumber % 3 as pay_5, case when l_linestatus = 'O' then 1 else 0 end as pay_6, "
              "case when l_returnflag = 'R' then 1 else 0 end as next_month from lineitem")
