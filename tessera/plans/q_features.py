"""Projection / filter / sampling / feature analyses."""

from pyspark.sql import functions as F

from ..operators import features as P
from . import inputs as I
from .catalog import register

_U = "((id * 0.6180339887498949) - floor(id * 0.6180339887498949))"


@register("p1_filter_sql_text", """
select l_orderkey, l_linenumber, l_returnflag from lineitem where l_returnflag in ('A', 'R')
""")
def p1_filter_sql_text(spark, sf_dir):
    li = I.table(spark, sf_dir, "lineitem")
    return P.filter_sql(li, "l_returnflag in ('A', 'R')").select("l_orderkey", "l_linenumber", "l_returnflag")


@register("p2_vertex_predicate", """
select c_name as name, c_acctbal as balance from customer where c_acctbal > 3000
""")
def p2_vertex_predicate(spark, sf_dir):
    c = I.table(spark, sf_dir, "customer")
    return P.filter_sql(c, "c_acctbal > 3000").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))


@register("p3_select_constant_weight", f"""
with r as ({I.REGRESSION_SQL})
select id, label, 1.0 as weight, round(x0, 6) as x0, round(x1, 6) as x1 from r
""")
def p3_select_constant_weight(spark, sf_dir):
    r = I.regression_rows(spark, sf_dir)
    out = P.with_constant(r, "weight", 1.0, ["id", "label", "weight", "x0", "x1"])
    return out.select("id", "label", "weight", F.round("x0", 6).alias("x0"), F.round("x1", 6).alias("x1"))


@register("p4_first_n_columns_formula", "select [l_quantity, l_extendedprice, l_discount] as features, l_tax as label from lineitem")
def p4_first_n_columns_formula(spark, sf_dir):
    li = I.table(spark, sf_dir, "lineitem")
    numeric = li.select("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")
    formula = P.first_n_formula(numeric.columns, "l_tax", 4)
    _, out = P.formula_encode(numeric, formula)
    from pyspark.ml.functions import vector_to_array
    return out.select(vector_to_array("features").alias("features"), "label")


@register("p5_hash_split", f"""
select l_orderkey * 8 + l_linenumber as id,
       case when ((l_orderkey * 8 + l_linenumber) * 0.6180339887498949
                  - floor((l_orderkey * 8 + l_linenumber) * 0.6180339887498949)) < 0.8 then 0 else 1 end as split
from lineitem
""")
def p5_hash_split(spark, sf_dir):
    r = I.regression_rows(spark, sf_dir).select("id")
    return P.hash_split(r, "id", [0.8, 0.2])


@register("p5_random_split")
def p5_random_split(spark, sf_dir):
    r = I.regression_rows(spark, sf_dir).select("id")
    train, test = P.random_split(r, [0.8, 0.2], 123)
    return train.withColumn("split", F.lit(0)).unionByName(test.withColumn("split", F.lit(1)))


_SIZES = [100, 1000, 5000]


@register("p6_sample_sizes", f"""
with n as (select count(*) as total from events),
s as (select unnest([{', '.join(map(str, _SIZES))}]) as sample_size)
select sample_size, event_id from events, s, n
where (event_id * 0.6180339887498949 - floor(event_id * 0.6180339887498949)) < least(1.0, sample_size / total)
""")
def p6_sample_sizes(spark, sf_dir):
    ev = I.table(spark, sf_dir, "events").select("event_id")
    return P.sample_sizes(ev, "event_id", _SIZES).select("sample_size", "event_id")


@register("p7_row_count", " union all ".join(
    f"select '{t}' as table_name, count(*) as n from {t}" for t in I.TABLES))
def p7_row_count(spark, sf_dir):
    out = None
    for t in I.TABLES:
        c = I.table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n")
        out = c if out is None else out.unionByName(c)
    return out


@register("p8_row_identity", """
select l_orderkey * 8 + l_linenumber as id, row_number() over (order by l_orderkey * 8 + l_linenumber) - 1 as row_index
from lineitem
""")
def p8_row_identity(spark, sf_dir):
    r = I.regression_rows(spark, sf_dir).select("id")
    return P.dense_index(r, "id").select("id", F.col("row_index").cast("bigint").alias("row_index"))


@register("p9_assemble_array", f"""
with r as ({I.REGRESSION_SQL})
select id, [round(x0, 6), round(x1, 6), round(x2, 6), round(x3, 6)] as features from r
""")
def p9_assemble_array(spark, sf_dir):
    r = P.assemble_array(I.regression_rows(spark, sf_dir), ["x0", "x1", "x2", "x3"])
    return r.select("id", F.transform("features", lambda v: F.round(v, 6)).alias("features"))


@register("p10_formula_encoding", """
with s as (select l_linestatus as v, row_number() over (order by count(*) desc, l_linestatus) as r from lineitem group by l_linestatus),
f as (select l_returnflag as v, row_number() over (order by count(*) desc, l_returnflag) - 1 as r from lineitem group by l_returnflag)
select [l_quantity, l_discount, case when s.r = 1 then 1.0 else 0.0 end] as features, cast(f.r as double) as label
from lineitem join s on s.v = l_linestatus join f on f.v = l_returnflag
""")
def p10_formula_encoding(spark, sf_dir):
    li = I.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_discount", "l_linestatus")
    _, out = P.formula_encode(li, "l_returnflag ~ l_quantity + l_discount + l_linestatus")
    from pyspark.ml.functions import vector_to_array
    return out.select(vector_to_array("features").alias("features"), "label")


@register("p11_label_index", """
with c as (select p_brand as value, count(*) as freq from part group by p_brand),
t as (select value, cast(row_number() over (order by freq desc, value) - 1 as double) as label_index from c)
select p_partkey, p_brand, label_index, value as label_value from part join t on p_brand = value
""")
def p11_label_index(spark, sf_dir):
    part = I.table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    table = P.label_index_table(part, "p_brand")
    idx = P.index_labels(part, "p_brand")
    return P.labels_from_index(idx, "label_index", table)


@register("p12_min_max_scale", """
select l_orderkey, l_linenumber,
  round((l_quantity - min(l_quantity) over ()) / (max(l_quantity) over () - min(l_quantity) over ()), 6) as l_quantity,
  round((l_extendedprice - min(l_extendedprice) over ()) / (max(l_extendedprice) over () - min(l_extendedprice) over ()), 6) as l_extendedprice
from lineitem
""")
def p12_min_max_scale(spark, sf_dir):
    li = I.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    s = P.min_max_scale(li, ["l_quantity", "l_extendedprice"])
    return s.select("l_orderkey", "l_linenumber", F.round("l_quantity", 6).alias("l_quantity"),
                    F.round("l_extendedprice", 6).alias("l_extendedprice"))


@register("p12_fixed_range_scale", """
select c_custkey, round((c_acctbal + 1000) / 11000, 6) as scaled from customer
""")
def p12_fixed_range_scale(spark, sf_dir):
    c = I.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("scaled"))
    s = P.scale_fixed(c, ["scaled"], -1000.0, 10000.0)
    return s.select("c_custkey", F.round("scaled", 6).alias("scaled"))


@register("p13_distinct_keys", """
select distinct l_suppkey, l_returnflag from lineitem
""")
def p13_distinct_keys(spark, sf_dir):
    li = I.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag")
    return P.distinct_rows(li)


@register("p14_class_count_metadata", """
select 'label' as "column", cast(count(distinct l_returnflag) as int) as num_classes from lineitem
""")
def p14_class_count_metadata(spark, sf_dir):
    from pyspark.ml.feature import StringIndexer
    li = I.table(spark, sf_dir, "lineitem").select("l_returnflag")
    idx = StringIndexer(inputCol="l_returnflag", outputCol="label").fit(li).transform(li)
    n = P.class_count_from_metadata(idx, "label")
    return spark.createDataFrame([("label", n)], "column string, num_classes int")
