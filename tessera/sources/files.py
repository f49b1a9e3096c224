"""File sources and sinks."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import ipv4_to_long

__all__ = ["read_csv_schema", "read_csv_inferred", "read_edge_list", "read_transactions",
           "from_rows", "schema_from_json", "schema_to_json", "read_with_schema_doc",
           "csv_to_onehot", "read_labelled_by_folder", "save_pipeline", "load_pipeline",
           "write_levels", "factor_tables"]


def read_csv_schema(spark: SparkSession, path: str, schema: T.StructType, header: bool = False) -> DataFrame:
    """CSV with a declared schema (S1).  ``header=False`` on a file that has a
    header yields one all-null row instead of an error; callers reading such
    files pass ``header=True``."""
    return spark.read.schema(schema).option("header", header).csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header and inferred types (S2).  Inference scans the data once
    more; prefer S1 for large inputs."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_edge_list(spark: SparkSession, path: str, sep: str = ",", ip_ids: bool = False,
                   partitions: int | None = None) -> DataFrame:
    """Delimited edge lines ``src,dst[,weight]`` (S3).

    Fields are trimmed; 2 fields -> weight 1, 3 fields -> weight; any other
    field count raises with the offending line.  Ids are integers, or IPv4
    text when ``ip_ids`` is set.
    """
    raw = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    parts = F.transform(F.split("value", sep), lambda s: F.trim(s))
    staged = raw.select("value", parts.alias("f"))
    n = F.size("f")
    bad = F.raise_error(F.concat(F.lit("bad edge line: "), F.col("value")))

    def ident(i):
        c = F.col("f")[i]
        if ip_ids:
            return c
        return F.when(c.rlike(r"^-?[0-9]+$"), c.cast("bigint")).otherwise(bad.cast("bigint"))

    w = F.when(n == 2, F.lit(1).cast("bigint")) \
         .when(n == 3, F.when(F.col("f")[2].rlike(r"^-?[0-9]+$"), F.col("f")[2].cast("bigint"))
               .otherwise(bad.cast("bigint"))) \
         .otherwise(bad.cast("bigint"))
    out = staged.select(F.when((n == 2) | (n == 3), ident(0)).otherwise(bad.cast("bigint") if not ip_ids else bad).alias("src"),
                        ident(1).alias("dst"), w.alias("weight"))
    if ip_ids:
        out = out.withColumn("src", ipv4_to_long("src")).withColumn("dst", ipv4_to_long("dst"))
    return out.repartition(partitions) if partitions else out


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """One basket per text line, items split on one space."""
    return spark.read.text(path).select(F.split(F.trim("value"), " ").alias("items"))


def from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """Literal rows -> table."""
    return spark.createDataFrame(rows, schema)


def schema_from_json(text: str) -> T.StructType:
    """Schema document (JSON text) -> StructType."""
    return T.StructType.fromJson(json.loads(text))


def schema_to_json(schema: T.StructType) -> str:
    return schema.json()


def read_with_schema_doc(spark: SparkSession, path: str, schema_text: str, fmt: str = "parquet") -> DataFrame:
    """Read a table with a schema taken from a schema document."""
    return spark.read.schema(schema_from_json(schema_text)).format(fmt).load(path)


def csv_to_onehot(lines: DataFrame, label_index: int, num_classes: int, sep: str = ",",
                  line: str = "value") -> DataFrame:
    """CSV line -> numeric features + one-hot label.

    ``label_index`` is the 0-based position of the class field; the other
    fields become ``features``.
    """
    f = F.split(F.col(line), sep)
    lab = f[label_index].cast("int")
    feats = F.concat(F.slice(f, 1, label_index), F.slice(f, label_index + 2, 1 << 30)) \
        if label_index > 0 else F.slice(f, 2, 1 << 30)
    onehot = F.transform(F.sequence(F.lit(0), F.lit(num_classes - 1)),
                         lambda i: F.when(i == lab, 1).otherwise(0))
    return lines.select(F.transform(feats, lambda s: s.cast("double")).alias("features"),
                        lab.alias("label"), onehot.alias("onehot"))


def read_labelled_by_folder(spark: SparkSession, path: str, binary: bool = False) -> DataFrame:
    """Files whose label is the name of their parent folder."""
    if binary:
        df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        return df.withColumn("label", F.element_at(F.split("path", "/"), -2))
    # the name comes URI-encoded, where a plus sign is a plain character
    name = F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B")))
    df = spark.read.option("recursiveFileLookup", True).text(path).withColumn("path", name)
    return df.withColumn("label", F.element_at(F.split("path", "/"), -2))


def save_pipeline(model, path: str, overwrite: bool = True) -> None:
    """Save a fitted pipeline / model."""
    w = model.write()
    (w.overwrite() if overwrite else w).save(path)


def load_pipeline(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def write_levels(vertices: DataFrame, edges: DataFrame, base: str, level: int, q: float | None = None) -> None:
    """Per-level graph snapshot, overwriting the level's folders (S11); with ``q`` also the level's (level, q) row."""
    if q is not None:
        vertices.sparkSession.createDataFrame([(level, float(q))], "level int, q double") \
                .coalesce(1).write.mode("overwrite").parquet(f"{base}/level_{level}_q")
    vertices.write.mode("overwrite").parquet(f"{base}/level_{level}_vertices")
    edges.write.mode("overwrite").parquet(f"{base}/level_{level}_edges")


def factor_tables(model=None, users: DataFrame | None = None, items: DataFrame | None = None):
    """(user factors, item factors) of a fitted ALS model or given tables."""
    if model is not None:
        return model.userFactors, model.itemFactors
    if users is None or items is None:
        raise ValueError("give a model or both factor tables")
    return users, items
