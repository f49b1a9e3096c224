"""Stateless scorers on a stream; whole-table operators per micro-batch."""

from pyspark.sql import functions as F

from tessera.operators import jobs as J
from tessera.operators import knn as N
from tessera.plans import inputs as I
from tessera.streaming import apply_per_batch, score_stream

SMALL = "/root/testdata/sf0.001"


def test_regression_table_scoring_on_stream(spark, tmp_path):
    batch = I.credit_rows(spark, SMALL)
    src = tmp_path / "credit"
    batch.write.parquet(str(src))
    stream = spark.readStream.schema(batch.schema).parquet(str(src))
    scored = score_stream(stream, lambda df: J.score_regression_table(df, J.CREDIT_TABLE))
    q = scored.writeStream.format("memory").queryName("scored_credit").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = spark.sql("select count(*) as n, sum(probability_1) as s from scored_credit").first()
    want = J.score_regression_table(batch, J.CREDIT_TABLE).agg(F.count(F.lit(1)).alias("n"),
                                                                F.sum("probability_1").alias("s")).first()
    assert got["n"] == want["n"] and abs(got["s"] - want["s"]) < 1e-9


def test_knn_per_micro_batch(spark, tmp_path):
    v = I.vectors(spark, SMALL)
    src = tmp_path / "vec"
    v.write.parquet(str(src))
    stream = spark.readStream.schema(v.schema).parquet(str(src))
    out = tmp_path / "out"
    q = apply_per_batch(stream, lambda b: N.knn_pairs(b, v, N.KNNParams(k=2, exclude_self=True)),
                        str(out), str(tmp_path / "ckpt"), trigger_once=True)
    q.awaitTermination(120)
    assert spark.read.parquet(str(out)).count() == 2 * v.count()
