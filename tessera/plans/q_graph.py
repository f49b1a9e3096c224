"""Graph analyses (G1-G8, A7, A10) on the kNN graph of all embeddings."""

from pyspark.sql import functions as F

from ..operators import graph as G
from ..operators.stats import degrees
from . import inputs as I
from .catalog import register

ORIGIN = 0
LPA_STEPS = 3
KG = I.knn_graph_sql(5)
KG1 = I.knn_graph_sql(1)


@register("g1_undirected", f"""
with g as ({KG})
select src, dst from g union select dst, src from g
""")
def g1_undirected(spark, sf_dir):
    return G.to_undirected(I.knn_graph(spark, sf_dir))


@register("g2_canonical_merge", f"""
with g as ({KG}), b as (select src, dst, weight from g union all select dst, src, weight from g)
select least(src, dst) as src, greatest(src, dst) as dst, sum(weight) as weight from b group by 1, 2
""")
def g2_canonical_merge(spark, sf_dir):
    g = I.knn_graph(spark, sf_dir)
    both = g.select("src", "dst", "weight").unionByName(g.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    return G.canonical_edges(both).withColumn("weight", F.col("weight").cast("bigint"))


@register("a7_min_incoming_message", f"""
with g as ({KG}), b as (select src, dst, weight from g union all select dst, src, weight from g)
select dst as id, min(weight) as min_weight, arg_min(src, weight * 1000000000 + src) as from_id from b group by dst
""")
def a7_min_incoming_message(spark, sf_dir):
    g = G.to_undirected(I.knn_graph(spark, sf_dir), extra=["weight"])
    return G.min_incoming(g)


@register("a10_degrees", f"""
with g as ({KG}), b as (select src, dst, weight from g union all select dst, src, weight from g),
ind as (select dst as id, count(*) as in_degree from b group by dst),
wd as (select id, sum(w) as weighted_degree from (select src as id, weight as w from b union all select dst, weight from b) group by id)
select wd.id, cast(wd.weighted_degree as bigint) as weighted_degree, coalesce(in_degree, 0) as in_degree
from wd left join ind using (id)
""")
def a10_degrees(spark, sf_dir):
    g = G.to_undirected(I.knn_graph(spark, sf_dir), extra=["weight"])
    d = degrees(g, weight="weight")
    return d.select("id", F.col("weighted_degree").cast("bigint").alias("weighted_degree"), "in_degree")


@register("g3_shortest_paths", f"""
with recursive g as ({KG}), b as (select src, dst, weight as w from g union all select dst, src, weight from g),
sp(v, d, pred) using key (v) as (
  select {ORIGIN}::bigint, 0::bigint, null::bigint
  union
  (select c.dst, c.d, c.pred from (
     select b.dst, min(sp.d + b.w) as d, arg_min(b.src, (sp.d + b.w) * 1000000000 + b.src) as pred
     from sp join b on b.src = sp.v group by b.dst) c
   left join recurring.sp r on r.v = c.dst
   where r.v is null or c.d < r.d or (c.d = r.d and c.pred < r.pred)))
select e.vec_id as id, sp.d as distance, sp.pred as predecessor
from embeddings e left join sp on sp.v = e.vec_id
""")
def g3_shortest_paths(spark, sf_dir):
    g = G.to_undirected(I.knn_graph(spark, sf_dir), extra=["weight"])
    return G.shortest_paths(I.graph_vertices(spark, sf_dir), g, ORIGIN)


def _lpa_sql(steps):
    parts = [f"l0 as (select id, id as label from ({I.VERTICES_SQL}))"]
    for s in range(1, steps + 1):
        parts.append(f"""m{s} as (select b.dst as id, l.label, count(*) as n from b join l{s-1} l on l.id = b.src group by 1, 2),
t{s} as (select id, label from (select *, row_number() over (partition by id order by n desc, label) as r from m{s}) where r = 1),
l{s} as (select l.id, coalesce(t.label, l.label) as label from l{s-1} l left join t{s} t using (id))""")
    return f"with g as ({KG}), b as (select src, dst from g union all select dst, src from g),\n" + ",\n".join(parts) + f"\nselect id, label from l{steps}"


@register("g4_label_propagation", _lpa_sql(LPA_STEPS))
def g4_label_propagation(spark, sf_dir):
    return G.label_propagation(I.graph_vertices(spark, sf_dir), I.knn_graph(spark, sf_dir), LPA_STEPS)


_TRI_SQL = f"""
with g as ({KG}), e as (select src as a, dst as b from g),
t as (select x.a as u, x.b as v, y.b as w from e x join e y on x.a = y.a and x.b < y.b
      join e z on z.a = x.b and z.b = y.b),
tri as (select id, count(*) as triangles from (select u as id from t union all select v from t union all select w from t) group by id),
deg as (select id, count(*) as degree from (select a as id from e union all select b from e) group by id),
loc as (select v.id, coalesce(degree, 0) as degree, coalesce(triangles, 0) as triangles
        from ({I.VERTICES_SQL}) v left join deg using (id) left join tri using (id))
"""


@register("g5_triangles", _TRI_SQL + "select id, triangles from tri")
def g5_triangles(spark, sf_dir):
    return G.triangles(I.knn_graph(spark, sf_dir))


@register("g7_local_clustering", _TRI_SQL + """
select id, degree, triangles,
       round(case when degree < 2 then 0.0 else triangles / (degree * (degree - 1) / 2) end, 6) as coefficient from loc
""")
def g7_local_clustering(spark, sf_dir):
    loc = G.local_clustering(I.graph_vertices(spark, sf_dir), I.knn_graph(spark, sf_dir))
    return loc.select("id", "degree", "triangles", F.round("coefficient", 6).alias("coefficient"))


@register("g6_global_clustering", _TRI_SQL + """
select cast(sum(triangles) as bigint) as triangles, cast(sum(degree * (degree - 1) / 2) as bigint) as pairs,
       round(coalesce(sum(triangles) / nullif(sum(degree * (degree - 1) / 2), 0), 0.0), 6) as coefficient from loc
""")
def g6_global_clustering(spark, sf_dir):
    gl = G.global_clustering(I.graph_vertices(spark, sf_dir), I.knn_graph(spark, sf_dir))
    return gl.select("triangles", "pairs", F.round("coefficient", 6).alias("coefficient"))


def _cc_sql(graph_sql):
    return f"""
with recursive g as ({graph_sql}), b as (select src, dst from g union all select dst, src from g),
cc(v, c) as (select id, id from ({I.VERTICES_SQL}) union select b.dst, cc.c from cc join b on b.src = cc.v)
select v as id, min(c) as component from cc group by v
"""


@register("g8_components_1nn", _cc_sql(KG1))
def g8_components_1nn(spark, sf_dir):
    return G.connected_components(I.graph_vertices(spark, sf_dir), I.knn_graph(spark, sf_dir, 1))


@register("g8_components_5nn", _cc_sql(KG))
def g8_components_5nn(spark, sf_dir):
    return G.connected_components(I.graph_vertices(spark, sf_dir), I.knn_graph(spark, sf_dir))
