"""Session construction and the few cluster-level helpers every operator uses."""

from __future__ import annotations

import math
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bound, in bytes, for anything this library ships to executors as a
# broadcast (pivot tables, small factor matrices, lookup tables).  Callers may
# lower or raise it per call; nothing is broadcast without a size check.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(master: str | None = None, app: str = "tessera",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with the settings the operators expect (AQE on, UTC, no UI)."""
    master = master or os.environ.get("TESSERA_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app)
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions or 8),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A folder is created here only when nothing is configured *and* the master
    is local (tests, single-machine runs); on a cluster an unset folder is an
    error, because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    import uuid
    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, **options: str) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and
    read it back; ``options`` go to its writer.

    Like a reliable checkpoint it survives executor loss and ends the
    lineage; unlike ``Dataset.checkpoint`` the new plan carries none of the
    old plan's constraints, which otherwise pile up over hundreds of loop
    steps and make planning slower every step.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    df.write.mode("overwrite").options(**options).parquet(path)
    out = spark.read.parquet(path)
    out._tessera_path = path
    return out


def release(df: DataFrame | None) -> None:
    """Delete the table behind a :func:`cut_lineage` result.

    Loops call it on the previous step once the next step has been written
    (the new table is read from its own files, so nothing depends on the old
    one); without it every step of every loop would stay on shared storage.
    """
    path = getattr(df, "_tessera_path", None) if df is not None else None
    if not path:
        return
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def bucketed(df: DataFrame, key: str, rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Write ``df`` once as a table bucketed and sorted by ``key`` in the shared checkpoint folder and read it back.

    Joins and aggregates on ``key`` then need no shuffle of this table, however
    often it is read.  :func:`drop_bucketed` ends it.
    """
    spark = df.sparkSession
    stored = cut_lineage(df)
    n = partitions_for(spark, stored.count(), rows_per_bucket)
    path = scratch_path(spark, "bucketed")
    name = "tessera_" + path.rsplit("-", 1)[1]
    stored.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name)
    release(stored)
    out = spark.table(name)
    out._tessera_path, out._tessera_table = path, name
    return out


def drop_bucketed(df: DataFrame) -> None:
    """Forget a :func:`bucketed` table and delete its files."""
    df.sparkSession.sql(f"drop table if exists {df._tessera_table}")
    release(df)


def row_count_at_most(df: DataFrame, limit: int) -> int | None:
    """Row count if it is <= ``limit``, else None; reads at most limit+1 rows."""
    n = df.limit(limit + 1).count()
    return n if n <= limit else None


DICTIONARY_ROWS = 1_000_000  # label / item dictionaries broadcast below this many rows


def broadcast_if_bounded(df: DataFrame, max_rows: int = DICTIONARY_ROWS) -> DataFrame:
    """Hint a broadcast only when the row count is proven <= ``max_rows``."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) is not None else df


def partitions_for(spark: SparkSession, rows: int, rows_per_partition: int = 1_000_000) -> int:
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(base, int(math.ceil(rows / rows_per_partition)))
