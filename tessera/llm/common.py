"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of one Arrow batch sent to a Python worker: with rows of 100 KB the
# default of 10,000 rows a batch would be a gigabyte.
BATCH_BYTES = 8 << 20


def session(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of this session by bytes; returns the session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    return spark


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame, *more: str) -> DataFrame:
    """The integer id and the text, and nothing else, whatever other columns there are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def crc_mod(ids: pa.Array, m: int) -> np.ndarray:
    """crc32(id as text) mod m of every id; a null id counts as the empty text."""
    return np.fromiter((zlib.crc32(b"" if i is None else b"%d" % i) % m for i in ids.to_pylist()), np.int64, len(ids))


def crc_of(column: str, m: int):
    """The same as a column expression."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % m


def gather(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that are no longer referred to."""
    import gc
    gc.collect()
    spark.sparkContext._jvm.System.gc()
