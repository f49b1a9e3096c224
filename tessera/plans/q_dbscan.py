"""Density clustering analyses (D1-D4, J7, J8) on the 2-D points of all embeddings."""

from pyspark.sql import functions as F

from ..operators import dbscan as D
from . import inputs as I
from .catalog import register

EPS = 0.03
MIN_PTS = 5

_DB_SQL = f"""
with recursive p as ({I.POINTS_SQL}),
nb as (select * from (select a.id as a, b.id as b,
                             sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) as d
                      from p a join p b on abs(a.x - b.x) <= {EPS} and abs(a.y - b.y) <= {EPS}) where d <= {EPS}),
cnt as (select a as id, count(*) as n from nb group by a),
core as (select id from cnt where n >= {MIN_PTS}),
ce as (select nb.a, nb.b from nb join core c1 on c1.id = nb.a join core c2 on c2.id = nb.b where nb.a <> nb.b),
cc(v, c) as (select id, id from core union select ce.b, cc.c from cc join ce on ce.a = cc.v),
cl as (select v as id, min(c) as cluster from cc group by v),
bd as (select nb.a as id, cl.cluster, nb.d from nb join cl on cl.id = nb.b where nb.a not in (select id from core)),
bb as (select id, cluster from (select *, row_number() over (partition by id order by round(d, 9), cluster) as r
                                from bd) where r = 1),
res as (select p.id, p.x, p.y,
               case when cl.id is not null then 'core' when bb.id is not null then 'border' else 'noise' end as flag,
               coalesce(cl.cluster, bb.cluster) as cluster
        from p left join cl using (id) left join bb using (id))
"""


@register("d1_dbscan", _DB_SQL + "select * from res")
def d1_dbscan(spark, sf_dir):
    return D.dbscan(I.points(spark, sf_dir), EPS, MIN_PTS)


@register("d1_dbscan_small_blocks", _DB_SQL + "select * from res")
def d1_dbscan_small_blocks(spark, sf_dir):
    """Same answer with tiny chunks: exercises the split of crowded cells."""
    return D.dbscan(I.points(spark, sf_dir), EPS, MIN_PTS, block_rows=16)


@register("d2_dbscan_flags", _DB_SQL + "select id, flag from res")
def d2_dbscan_flags(spark, sf_dir):
    return D.dbscan_flags(I.points(spark, sf_dir), EPS, MIN_PTS)


@register("d3_cell_cluster_merge", _DB_SQL + f"""
select distinct cast(floor(x / ({EPS} / sqrt(2.0) * (1.0 - 1e-12))) as bigint) as cx,
       cast(floor(y / ({EPS} / sqrt(2.0) * (1.0 - 1e-12))) as bigint) as cy, cluster
from res where flag = 'core'
""")
def d3_cell_cluster_merge(spark, sf_dir):
    return D.cell_clusters(I.points(spark, sf_dir), EPS, MIN_PTS)


@register("j8_distance_self_join_counts", _DB_SQL + "select id, n as neighbours from cnt")
def j8_distance_self_join_counts(spark, sf_dir):
    """Neighbour count within eps (self included) for every point, via J7/J8 on cells."""
    return D.neighbour_counts(I.points(spark, sf_dir), EPS)


@register("d4_even_split_invariants", f"""
select count(*) as points, 0::bigint as wrong_counts, 0::bigint as too_full, 0::bigint as off_the_grid from embeddings
""")
def d4_even_split_invariants(spark, sf_dir):
    """Points in the regions; regions whose count is not that of their cells, that hold a cell outside their sides,
    that hold too many points and could still be cut, or whose sides are no cell lines."""
    size = 2 * EPS
    regions, cells = D.even_split(I.points(spark, sf_dir), EPS, 100, with_cells=True)
    sides = ("x1", "x2", "y1", "y2")
    at = {c: F.round(F.col(c) / size) for c in sides}
    inside = F.col("cx").between(at["x1"], at["x2"] - 1) & F.col("cy").between(at["y1"], at["y2"] - 1)
    per = regions.join(cells.withColumnRenamed("n", "c"), "region").groupBy("region", "n", *sides).agg(
        F.sum("c").alias("found"), F.sum(F.when(inside, 0).otherwise(1)).alias("outside"))
    wide = (at["x2"] - at["x1"] > 2) | (at["y2"] - at["y1"] > 2)
    off = F.greatest(*[F.abs(F.col(c) - at[c] * size) for c in sides]) > 1e-9
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return per.agg(F.sum("found").alias("points"), one((F.col("n") != F.col("found")) | (F.col("outside") > 0)).alias("wrong_counts"),
                   one((F.col("n") > 100) & wide).alias("too_full"), one(off).alias("off_the_grid"))


@register("d4_even_split")
def d4_even_split(spark, sf_dir):
    return D.even_split(I.points(spark, sf_dir), EPS, 100)
