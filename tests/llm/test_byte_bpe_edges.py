"""Byte-level BPE on an empty table, clashing columns and bytes that are no UTF-8."""

from pyspark.sql import functions as F

from tessera.llm import byte_bpe


def test_clashing_columns_and_empty_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "some text"), (None, None)], "doc_id long, text string")
    for name in ("token_ids", "n_tokens", "round_trip", "ids", "row", "decoded"):
        df = df.withColumn(name, F.lit("z"))
    out = byte_bpe.with_tokens(df)
    assert sorted(out.columns) == sorted(df.columns)
    out.write.parquet(str(tmp_path / "t"))
    rows = {r["doc_id"]: r for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert rows[1]["n_tokens"] > 0 and rows[1]["round_trip"] and rows[1]["row"] == "z" and rows[None]["n_tokens"] == 0
    assert byte_bpe.with_tokens(df.limit(0)).count() == 0 and byte_bpe.encode(df.limit(0)).count() == 0


def test_bytes_that_are_no_utf8(spark):
    df = spark.createDataFrame([(1, bytearray(b"ab\xff cd"))], "doc_id long, raw binary").selectExpr("doc_id", "cast(raw as string) text")
    row = byte_bpe.with_tokens(df).first()
    good = byte_bpe.with_tokens(spark.createDataFrame([(1, "ab� cd")], "doc_id long, text string")).first()
    assert row["token_ids"] == good["token_ids"] and not row["round_trip"] and good["round_trip"]
