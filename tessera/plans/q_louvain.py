"""Louvain analyses (G9-G13, S11) on the kNN graph with unit weights."""

from pyspark.sql import functions as F

from ..operators import louvain as L
from ..session import scratch_path
from ..sources.files import write_levels
from . import inputs as I
from .catalog import register

KG = I.knn_graph_sql(5)


def _graph(spark, sf_dir):
    g = I.knn_graph(spark, sf_dir).select("src", "dst", F.lit(1).cast("long").alias("weight"))
    return I.graph_vertices(spark, sf_dir), g


def _msgs(st):
    return f"""(select id, c, s, sum(weight) as k from (
    select e.dst as id, x.community as c, x.sigma_tot as s, e.weight from e join {st} x on x.id = e.src
    union all
    select e.src as id, x.community as c, x.sigma_tot as s, e.weight from e join {st} x on x.id = e.dst)
  group by id, c, s)"""


_BASE = f"""
with g as ({KG}), e as (select src, dst, cast(1 as bigint) as weight from g),
nw as (select id, sum(weight) as node_weight from (select src as id, weight from e union all select dst, weight from e) group by id),
st0 as (select v.id, v.id as community, coalesce(nw.node_weight, 0) as sigma_tot, cast(0 as bigint) as internal,
               coalesce(nw.node_weight, 0) as node_weight from ({I.VERTICES_SQL}) v left join nw using (id)),
mm as (select sum(internal + node_weight) as m from st0),
msg0 as {_msgs('st0')},
gj as (select msg0.*, x.community as own, x.internal, x.node_weight from msg0 join st0 x using (id)),
gg as (select id, c,
         case when c = own and s - (node_weight + internal) = 0 then cast(0 as hugeint)
              else cast(case when c = own then k + internal else k end as hugeint) * cast((select m from mm) as hugeint)
                   - cast(node_weight + internal as hugeint)
                     * cast(case when c = own then s - (node_weight + internal) else s end as hugeint) end as gain
       from gj),
best as (select id, arg_max(c, gain * cast(1099511627776 as hugeint) + c) as best from gg where gain > 0 group by id),
lab as (select x.id, case when b.best is not null and b.best <> x.community and x.community > b.best
                          then b.best else x.community end as community, x.internal, x.node_weight
        from st0 x left join best b using (id)),
sig as (select community, sum(node_weight + internal) as sigma_tot from lab group by community),
st1 as (select lab.id, lab.community, sig.sigma_tot, lab.internal, lab.node_weight from lab join sig using (community))
"""


@register("g9_louvain_initial_state", _BASE + """
select id, community, cast(sigma_tot as bigint) as sigma_tot, internal, cast(node_weight as bigint) as node_weight from st0
""")
def g9_louvain_initial_state(spark, sf_dir):
    v, g = _graph(spark, sf_dir)
    st, _ = L.initial_state(v, g)
    return st.select("id", "community", F.col("sigma_tot").cast("bigint").alias("sigma_tot"), "internal",
                     F.col("node_weight").cast("bigint").alias("node_weight"))


@register("g10_louvain_local_move", _BASE + """
select id, community, cast(sigma_tot as bigint) as sigma_tot from st1
""")
def g10_louvain_local_move(spark, sf_dir):
    v, g = _graph(spark, sf_dir)
    st, e = L.initial_state(v, g)
    m = L.total_weight(st)
    s1 = L.local_move(st, e, m, even=True)
    return s1.select("id", "community", F.col("sigma_tot").cast("bigint").alias("sigma_tot"))


@register("g11_louvain_modularity", _BASE + f""",
msg1 as {_msgs('st1')},
ins as (select m1.id, sum(case when m1.c = x.community then m1.k else 0 end) as kc
        from msg1 m1 join st1 x using (id) group by m1.id),
qv as (select (x.internal + ins.kc) / (select m from mm)
              - x.sigma_tot * (x.node_weight + x.internal) / ((select m from mm) * (select m from mm)) as q
       from st1 x join ins using (id))
select round(sum(greatest(q, 0.0)), 6) as q_clipped, round(sum(q), 6) as q_unclipped,
       cast((select m from mm) as bigint) as total_weight from qv
""")
def g11_louvain_modularity(spark, sf_dir):
    v, g = _graph(spark, sf_dir)
    st, e = L.initial_state(v, g)
    m = L.total_weight(st)
    s1 = L.cut_lineage(L.local_move(st, e, m, even=True).drop("changed"))
    qc, qu = L.modularity(s1, e, m), L.modularity(s1, e, m, clipped=False)
    return spark.range(1).select(F.round(F.lit(qc), 6).alias("q_clipped"), F.round(F.lit(qu), 6).alias("q_unclipped"),
                                 F.lit(m).cast("bigint").alias("total_weight"))


@register("g12_louvain_compress", _BASE + """,
ce as (select e.weight, a.community as cs, b.community as cd from e join st1 a on a.id = e.src join st1 b on b.id = e.dst),
ie as (select cs as id, sum(2 * weight) as ie from ce where cs = cd group by cs),
iw as (select community as id, sum(internal) as iw from st1 group by community),
v2 as (select iw.id, iw.iw + coalesce(ie.ie, 0) as internal from iw left join ie using (id)),
e2 as (select least(cs, cd) as src, greatest(cs, cd) as dst, sum(weight) as weight from ce where cs <> cd group by 1, 2),
nw2 as (select id, sum(weight) as nw from (select src as id, weight from e2 union all select dst, weight from e2) group by id)
select v2.id, v2.id as community, cast(coalesce(nw, 0) + internal as bigint) as sigma_tot,
       cast(internal as bigint) as internal, cast(coalesce(nw, 0) as bigint) as node_weight
from v2 left join nw2 using (id)
""")
def g12_louvain_compress(spark, sf_dir):
    v, g = _graph(spark, sf_dir)
    st, e = L.initial_state(v, g)
    m = L.total_weight(st)
    s1 = L.local_move(st, e, m, even=True).drop("changed")
    s2, _ = L.compress(s1, e)
    return s2.select("id", "community", *[F.col(c).cast("bigint").alias(c) for c in ("sigma_tot", "internal", "node_weight")])


@register("g13_louvain_levels")
def g13_louvain_levels(spark, sf_dir):
    v, g = _graph(spark, sf_dir)
    base = scratch_path(spark, "louvain_levels")

    def save(level, q, state, edges):  # S11: per-level snapshots
        write_levels(state, edges, base, level, q)

    levels, assign = L.louvain(v, g, min_progress=50, progress_counter=2, on_level=save)
    n_comm = assign.select("community").distinct().count()
    rows = [(lv, float(q), p, n_comm) for lv, q, p in levels]  # one row per level
    return spark.createDataFrame(rows, "level int, q double, passes int, communities long")


@register("s11_level_snapshots", _BASE + """
select 'vertex' as part, id, community, cast(sigma_tot as bigint) as sigma_tot, internal, cast(node_weight as bigint) as node_weight,
       null::bigint as dst, null::bigint as weight from st0
union all select 'edge', src, null, null, null, null, dst, weight from e
union all select 'level', 0, null, null, null, null, null, null
""")
def s11_level_snapshots(spark, sf_dir):
    """Level 0 written twice (the second time over the first), with its (level, q) row, and read back."""
    v, g = _graph(spark, sf_dir)
    base = scratch_path(spark, "louvain_snap")
    st, e = L.initial_state(v, g)
    m = L.total_weight(st)
    for _ in range(2):
        write_levels(st, e, base, 0, L.modularity(st, e, m))
    null = lambda c: F.lit(None).cast("bigint").alias(c)
    state = spark.read.parquet(f"{base}/level_0_vertices").select(
        F.lit("vertex").alias("part"), "id", "community", F.col("sigma_tot").cast("bigint").alias("sigma_tot"),
        F.col("internal").cast("bigint").alias("internal"), F.col("node_weight").cast("bigint").alias("node_weight"), null("dst"), null("weight"))
    rest = ("community", "sigma_tot", "internal", "node_weight")
    edges = spark.read.parquet(f"{base}/level_0_edges").select(
        F.lit("edge").alias("part"), F.col("src").alias("id"), *map(null, rest), "dst", "weight")
    level = spark.read.parquet(f"{base}/level_0_q").filter("q between -1 and 1").select(
        F.lit("level").alias("part"), F.col("level").cast("bigint").alias("id"), *map(null, rest), null("dst"), null("weight"))
    return state.unionByName(edges).unionByName(level)
