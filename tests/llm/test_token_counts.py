"""Prefix counts against the tokenizers library, prefix by prefix, and the defined edge cases."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tessera.llm import token_counts

SF = "/root/testdata/sf0.001"
PARTS = [" ", "  ", "\n", "\n\n", " \n", "\t", "'", "'s", "'re", "'ll", "'v", "'l", "a", "bc", " the", "é", "漢", "1", "23",
         "!", "...", "<|endoftext|>", "<|endof", "|>", "　", "\U0001f600", "'S"]


@pytest.fixture(scope="module")
def counter():
    with open(public_tokenizers.path(token_counts.VOCABULARY), encoding="utf-8") as f:
        return token_counts.Counter(f.read())


def _brute(counter, text):
    return [len(counter.tokenizer.encode(text[:p], add_special_tokens=False).ids) for p in range(1, len(text) + 1)]


def test_every_prefix_of_mixed_texts(counter):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14))) for _ in range(400)]
    texts += ["", "a" * 60, "0" * 90, "-" * 200, " " * 150, "    \n   x", "''''s", "<|endoftext|>" * 2, " <|endoftext|> 's"]
    for text, got in zip(texts, counter.counts(texts)):
        assert got.tolist() == _brute(counter, text), text


def test_long_texts_in_parts(counter, monkeypatch):
    monkeypatch.setattr(token_counts, "PART", 20)
    rnd = random.Random(6)
    for _ in range(40):
        text = "".join(rnd.choice(PARTS) for _ in range(60)) + "x"
        assert counter.long_counts(text).tolist() == _brute(counter, text), text


def test_memory_bound_changes_nothing(counter, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED", 3)
    for text in ("one two three four five", "six seven one two", "eight 'll nine\n\n ten"):
        assert counter.counts([text])[0].tolist() == _brute(counter, text)


def test_whole_documents_and_questions(spark, counter):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r[0]: r[1] or "" for r in docs.select("doc_id", "text").collect()}
    out = token_counts.prefix_counts(docs).select(
        "doc_id", "n_bytes", "prefix", token_counts.tokens_at(50).alias("at50"), token_counts.tokens_at(-3).alias("none"),
        token_counts.longest_within(30).alias("fit"), token_counts.longest_within(-1).alias("never")).collect()
    assert len(out) == len(texts)
    rnd = random.Random(7)
    for r in out:
        text = texts[r["doc_id"]]
        assert r["n_bytes"] == len(text.encode()) and len(r["prefix"]) == len(text) + 1
        for p in {0, len(text), *(rnd.randint(0, len(text)) for _ in range(4))}:
            assert r["prefix"][p] == len(counter.tokenizer.encode(text[:p], add_special_tokens=False).ids)
        assert r["at50"] == r["prefix"][min(50, len(text))] and r["none"] == 0
        assert r["fit"] == max(p for p, c in enumerate(r["prefix"]) if c <= 30) and r["never"] is None


def test_query(spark, counter):
    rows = {r["doc_id"]: r for r in token_counts.op12_token_counts(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        n = len(counter.tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)
        got = rows[r["doc_id"]]
        assert (got["n_tokens"], got["over_limit"], got["n_bytes"]) == (n, n > 1024, len((r["text"] or "").encode()))


def test_edges(spark, counter):
    rows = [(None, None), (1, ""), (1, ""), (2, "word"), (3, "Éa b\x0bc " * 4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("row", "prefix", "n_bytes", "_fit"):
        df = df.withColumn(name, F.lit(7))
    got = sorted((r["doc_id"] or 0, r["prefix"][-1]) for r in token_counts.prefix_counts(df).collect())
    assert got == sorted((i or 0, len(counter.tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert token_counts.prefix_counts(df.limit(0)).count() == 0
    cut = token_counts.truncate(df, 5)
    assert cut.columns == df.columns
    for r in cut.collect():
        assert (r["row"], r["prefix"]) == (7, 7)
        assert r["text"] is None or len(counter.tokenizer.encode(r["text"], add_special_tokens=False).ids) <= 5
    bad = spark.createDataFrame([(1, bytearray(b"ab\xff cd"))], "doc_id long, raw binary").selectExpr("doc_id", "cast(raw as string) text")
    assert token_counts.prefix_counts(bad).first()["prefix"][-1] == len(counter.tokenizer.encode("ab� cd").ids)
