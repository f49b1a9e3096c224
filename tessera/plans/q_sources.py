"""Source / sink analyses (S1-S4, S6-S9): write a driver table, read it back."""

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import files as S
from . import inputs as I
from .catalog import register


@register("s1_csv_declared_schema", "select * from part")
def s1_csv_declared_schema(spark, sf_dir):
    part = I.table(spark, sf_dir, "part")
    path = scratch_path(spark, "s1_part_csv")
    part.write.mode("overwrite").csv(path)
    return S.read_csv_schema(spark, path, part.schema)


@register("s2_csv_header_inferred", """
select cast(s_suppkey as int) as s_suppkey, s_name, s_nationkey, s_acctbal from supplier
""")
def s2_csv_header_inferred(spark, sf_dir):
    sup = I.table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "s2_supplier_csv")
    sup.write.mode("overwrite").option("header", True).csv(path)
    return S.read_csv_inferred(spark, path)


@register("s3_edge_list_text", """
select l_orderkey as src, l_suppkey as dst,
       case when l_linenumber % 2 = 1 then 1 else cast(l_quantity as bigint) end as weight
from lineitem
""")
def s3_edge_list_text(spark, sf_dir):
    li = I.table(spark, sf_dir, "lineitem")
    line = F.when(F.col("l_linenumber") % 2 == 1,
                  F.concat_ws(",", "l_orderkey", "l_suppkey")) \
            .otherwise(F.concat(F.col("l_orderkey").cast("string"), F.lit(" , "),
                                F.col("l_suppkey").cast("string"), F.lit(", "),
                                F.col("l_quantity").cast("bigint").cast("string")))
    path = scratch_path(spark, "s3_edges_txt")
    li.select(line.alias("value")).write.mode("overwrite").text(path)
    return S.read_edge_list(spark, path)


@register("s4_transactions_text", f"""
with b as ({I.BASKET_ITEMS_SQL})
select list_sort(list(item)) as items from b group by basket
""")
def s4_transactions_text(spark, sf_dir):
    b = I.baskets(spark, sf_dir)
    path = scratch_path(spark, "s4_baskets_txt")
    b.select(F.concat_ws(" ", "items").alias("value")).write.mode("overwrite").text(path)
    return S.read_transactions(spark, path).select(F.array_sort("items").alias("items"))


@register("s6_schema_document", "select * from orders")
def s6_schema_document(spark, sf_dir):
    orders = I.table(spark, sf_dir, "orders")
    doc = S.schema_to_json(orders.schema)
    return S.read_with_schema_doc(spark, f"{sf_dir.rstrip('/')}/orders.parquet", doc)


@register("s7_csv_onehot_label", """
select [l_quantity, l_discount, l_tax] as features,
       cast(case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as int) as label,
       [case when l_returnflag = 'A' then 1 else 0 end, case when l_returnflag = 'N' then 1 else 0 end,
        case when l_returnflag = 'R' then 1 else 0 end] as onehot
from lineitem
""")
def s7_csv_onehot_label(spark, sf_dir):
    li = I.table(spark, sf_dir, "lineitem")
    cls = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    lines = li.select(F.concat_ws(",", "l_quantity", "l_discount", cls.cast("string"), "l_tax").alias("value"))
    path = scratch_path(spark, "s7_csv")
    lines.write.mode("overwrite").text(path)
    return S.csv_to_onehot(spark.read.text(path), label_index=2, num_classes=3)


@register("s8_labelled_by_folder", "select doc_id, lang, text from documents")
def s8_labelled_by_folder(spark, sf_dir):
    # one line per document, whole text included; line ends inside a text are escaped
    docs = I.table(spark, sf_dir, "documents").select("lang", F.to_json(F.struct("doc_id", "text")).alias("value"))
    path = scratch_path(spark, "s8_by_lang")
    docs.write.mode("overwrite").partitionBy("lang").text(path)
    lang = F.regexp_replace("label", "^lang=", "")
    out = S.read_labelled_by_folder(spark, path).select(
        F.from_json("value", "doc_id bigint, text string").alias("d"),
        F.nullif(lang, F.lit("__HIVE_DEFAULT_PARTITION__")).alias("lang"))
    return out.select("d.doc_id", "lang", "d.text")


@register("s9_pipeline_save_load")
def s9_pipeline_save_load(spark, sf_dir):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import RFormula
    rows = I.regression_rows(spark, sf_dir)
    pipe = Pipeline(stages=[RFormula(formula="label ~ x0 + x1 + x2 + x3"),
                            LogisticRegression(maxIter=20, regParam=0.01)])
    model = pipe.fit(rows)
    path = scratch_path(spark, "s9_pipeline")
    S.save_pipeline(model, path)
    S.save_pipeline(model, path, overwrite=True)
    again = S.load_pipeline(path)
    # Score the same rows with both models in one pass (ids are not unique).
    first = model.transform(rows).select("id", "x0", "x1", "x2", "x3", "label", F.col("prediction").alias("p1"))
    both = again.transform(first).select("id", "p1", F.col("prediction").alias("p2"))
    return both.withColumn("same", F.col("p1") == F.col("p2"))
