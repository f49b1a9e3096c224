"""Scalar function analyses (F1-F10) over whole driver tables."""

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import stats as A
from . import inputs as I
from .catalog import register

IP_BASE = 167772160  # 10.0.0.0


@register("f2_long_to_ipv4", f"""
select event_id, concat_ws('.', (({IP_BASE} + event_id) >> 24) & 255, (({IP_BASE} + event_id) >> 16) & 255,
       (({IP_BASE} + event_id) >> 8) & 255, ({IP_BASE} + event_id) & 255) as ip from events
""")
def f2_long_to_ipv4(spark, sf_dir):
    ev = I.table(spark, sf_dir, "events")
    return ev.select("event_id", S.long_to_ipv4(F.col("event_id") + IP_BASE).alias("ip"))


@register("f1_ipv4_to_long", f"""
select event_id, {IP_BASE} + event_id as ip_value from events
""")
def f1_ipv4_to_long(spark, sf_dir):
    ips = f2_long_to_ipv4(spark, sf_dir)
    return ips.select("event_id", S.ipv4_to_long("ip").alias("ip_value"))


_CENTROID_SQL = f"""
with v as ({I.VECTORS_SQL}),
e as (select id, label, unnest(features) as x, unnest(generate_series(0, len(features) - 1)) as pos from v),
c as (select label, pos, avg(x) as m from e group by label, pos),
cv as (select label, list(m order by pos) as centroid from c group by label)
"""


def class_centroids(vec):
    per = (vec.select("label", F.posexplode("features").alias("pos", "x"))
           .groupBy("label", "pos").agg(F.avg("x").alias("m")))
    return per.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centroid"))


@register("f3_distance_to_class_centroid", _CENTROID_SQL + """
select v.id, round(list_distance(v.features, cv.centroid), 6) as dist,
       round(list_distance(v.features, cv.centroid) ^ 2, 6) as sq_dist
from v join cv using (label)
""")
def f3_distance_to_class_centroid(spark, sf_dir):
    vec = I.vectors(spark, sf_dir)
    j = vec.join(class_centroids(vec), "label")
    return j.select("id", F.round(S.euclidean("features", "centroid"), 6).alias("dist"),
                    F.round(S.sq_distance("features", "centroid"), 6).alias("sq_dist"))


@register("f4_dot_with_class_centroid", _CENTROID_SQL + """
select v.id, round(list_inner_product(v.features, cv.centroid), 6) as dot from v join cv using (label)
""")
def f4_dot_with_class_centroid(spark, sf_dir):
    vec = I.vectors(spark, sf_dir)
    j = vec.join(class_centroids(vec), "label")
    return j.select("id", F.round(S.dot("features", "centroid"), 6).alias("dot"))


@register("f5_clip_and_logistic", """
select l_orderkey, l_linenumber,
       round(least(greatest(l_discount * 10 - l_tax * 10, -0.2), 0.2), 6) as clipped,
       round(1 / (1 + exp(-(l_discount * 10 - l_tax * 10))), 6) as prob
from lineitem
""")
def f5_clip_and_logistic(spark, sf_dir):
    li = I.table(spark, sf_dir, "lineitem")
    z = F.col("l_discount") * 10 - F.col("l_tax") * 10
    return li.select("l_orderkey", "l_linenumber", F.round(S.clip(z, -0.2, 0.2), 6).alias("clipped"),
                     F.round(S.logistic(z), 6).alias("prob"))


@register("f6_grid_corner", f"""
with p as ({I.POINTS_SQL})
select id, round(floor(x / 0.06) * 0.06, 6) as corner_x, round(floor(y / 0.06) * 0.06, 6) as corner_y,
       cast(floor(x / 0.06) as bigint) as cx, cast(floor(y / 0.06) as bigint) as cy from p
""")
def f6_grid_corner(spark, sf_dir):
    p = I.points(spark, sf_dir)
    return p.select("id", F.round(S.grid_corner("x", 0.06), 6).alias("corner_x"),
                    F.round(S.grid_corner("y", 0.06), 6).alias("corner_y"),
                    S.cell_index("x", 0.06).alias("cx"), S.cell_index("y", 0.06).alias("cy"))


@register("f7_rectangle_predicates", f"""
with p as ({I.POINTS_SQL}),
r as (select id, x, y, floor(x / 0.06) * 0.06 as x1, floor(y / 0.06) * 0.06 as y1 from p)
select id,
  (x >= x1 - 0.03 and x <= x1 + 0.06 + 0.03 and y >= y1 - 0.03 and y <= y1 + 0.06 + 0.03) as in_grown,
  (x > x1 + 0.03 and x < x1 + 0.06 - 0.03 and y > y1 + 0.03 and y < y1 + 0.06 - 0.03) as strictly_in_shrunk,
  (x >= x1 and x <= x1 + 0.06 and y >= y1 and y <= y1 + 0.06) as in_cell
from r
""")
def f7_rectangle_predicates(spark, sf_dir):
    p = I.points(spark, sf_dir)
    r = p.select("id", "x", "y", S.grid_corner("x", 0.06).alias("x1"), S.grid_corner("y", 0.06).alias("y1"))
    r = r.withColumn("x2", F.col("x1") + 0.06).withColumn("y2", F.col("y1") + 0.06)
    gx1, gy1, gx2, gy2 = S.rect_shrink("x1", "y1", "x2", "y2", -0.03)
    sx1, sy1, sx2, sy2 = S.rect_shrink("x1", "y1", "x2", "y2", 0.03)
    return r.select("id",
                    S.rect_contains("x", "y", gx1, gy1, gx2, gy2).alias("in_grown"),
                    S.rect_almost_contains("x", "y", sx1, sy1, sx2, sy2).alias("strictly_in_shrunk"),
                    S.rect_contains("x", "y", "x1", "y1", "x2", "y2").alias("in_cell"))


@register("f8_label_recoding", f"""
with r as ({I.REGRESSION_SQL})
select id, case when label > 0 then 1.0 else -1.0 end as y from r
""")
def f8_label_recoding(spark, sf_dir):
    r = I.regression_rows(spark, sf_dir)
    return r.select("id", S.recode_pm1("label").alias("y"))


@register("f9_invalid_label_test", """
select event_id, (value / 10 - 20) <> floor(value / 10 - 20) or (value / 10 - 20) < 0 as invalid from events
""")
def f9_invalid_label_test(spark, sf_dir):
    ev = I.table(spark, sf_dir, "events")
    return ev.select("event_id", S.invalid_label(F.col("value") / 10 - 20).alias("invalid"))


@register("f10_parse_helpers", """
select event_id, cast(trim(replace(split_part(props, ':', 2), '}', '')) as bigint) as k from events
""")
def f10_parse_helpers(spark, sf_dir):
    ev = I.table(spark, sf_dir, "events")
    f = S.parse_fields(F.regexp_replace("props", "[{}]", ""), ":")
    return ev.select("event_id", f[1].cast("bigint").alias("k"))
