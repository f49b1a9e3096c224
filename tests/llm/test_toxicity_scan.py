"""The token scan finds what the pattern finds, in linear time; very long and empty inputs."""

import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import toxicity
from tessera.llm.words import text_chunks

PIECES = list("abloseridtéÉßÿ漢“÷013527@$!|+.-_*',\n") + [" "] * 8 + ["l0s3r", "l o s e r", "iddiot", "a$$"]


@pytest.fixture(scope="module")
def channel():
    rng = np.random.default_rng(0)
    return toxicity.Channel(rng.integers(0, 50, toxicity.CLASSES ** 3))


def test_scan_equals_the_pattern_on_whole_rows(channel):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 25))) for _ in range(4000)] + [None, "", "l 0 s 3 r!", "a  b b"]
    for ch in text_chunks(pa.array(texts, pa.string()), 1 << 14):
        out = toxicity.restored(ch, channel)
        for r in range(ch.rows):
            got = out.data[out.offsets[r]:out.offsets[r + 1]].tobytes().decode()
            assert got == channel.restore(texts[ch.first + r] or ""), texts[ch.first + r]


@pytest.mark.parametrize("text", ["1" * 1_000_000, "a1" * 200_000, "x " * 300_000, "!" * 500_000, "aa " * 200_000])
def test_long_texts_take_linear_time(channel, text):
    start = time.process_time()
    (ch,) = text_chunks(pa.array([text]))
    toxicity.restored(ch, channel)
    assert time.process_time() - start < 40


def test_empty_table_and_long_text(spark):
    rows = [(i, f"some plain words number {i} stand here" + (" you vile grunzk" if i % 2 else "")) for i in range(1, 60)] + [(99, "word " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("z"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    assert toxicity.keep_clean(docs.limit(0), model).count() == 0
    kept = {r["doc_id"] for r in toxicity.keep_clean(docs, model).collect()}
    assert 99 in kept and not kept & {1, 3, 57} and {2, 4, 58} <= kept


def test_every_labelled_row_is_learned_from(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 30, raising=False)   # the bound there was
    monkeypatch.setattr(toxicity, "ASKED", 3)                    # several slices of units
    monkeypatch.setattr(toxicity, "HELD", 40)                    # counts handed on in pieces
    rows = [(i, f"plain entry {i} about item{i} stands here" + (" vile grunzk" if i % 2 else "")) for i in range(1, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 400)], "doc_id long, toxic int")
    used = [i for i, _ in rows if zlib.crc32(b"%d" % i) % 5]
    assert {r["doc_id"] for r in toxicity._labelled(docs, labels, 5, 0).collect()} == set(used)
    lexicon = toxicity.learn(docs, labels).lexicon
    texts = [t for i, t in rows if i in set(used)]
    bad, good = [t for t in texts if "vile" in t], [t for t in texts if "vile" not in t]
    nt, nc = (sum(len(t.split()) for t in x) for x in (bad, good))
    want = np.log(((len(bad) + 0.5) / (nt + 1)) / (0.5 / (nc + 1))) - 1 / np.sqrt(len(bad))
    assert np.allclose(lexicon.ratio, want) and len(lexicon.ratio) == 6   # vile, grunzk; beginnings vile, grun, grunz, grunzk
