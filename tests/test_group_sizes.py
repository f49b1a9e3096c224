"""Tiny chunks: every pair of rows meets once, in a number of groups that does not follow the square of a key's rows."""

import numpy as np
import pandas as pd

from tessera.operators import blocks
from tessera.operators import dbscan as D


def test_tiny_chunks_of_a_crowded_key_make_few_groups(spark):
    rows = 640
    df = spark.createDataFrame([("a" if i < 600 else "b", i) for i in range(rows)], "key string, id long")

    def count(lpdf, rpdf):
        return pd.DataFrame({"key": lpdf["key"].iat[0], "l": [len(lpdf)], "r": [len(rpdf)]})

    got = blocks.chunked_cogroup(df, df, "key", count, spark.createDataFrame([], "key string, l long, r long").schema, "id", "id", 16).toPandas()
    a = got[got["key"] == "a"]
    assert (a["l"] * a["r"]).sum() == 600 * 600 and len(a) <= 64   # 1,444 groups of 16 rows a side before
    b = got[got["key"] == "b"]
    assert (b["l"] * b["r"]).sum() == 40 * 40 and len(b) > 1 and b["l"].max() < 40   # a small key is still cut


def test_default_chunks_are_as_they_were(spark):
    n = spark.createDataFrame([(i,) for i in (1, 16, 17, 2048, 2049, 100_000)], "n long")
    got = [r["c"] for r in n.select(blocks.chunk_count(n["n"], 2048).alias("c")).collect()]
    assert got == [1, 1, 1, 1, 2, 49]


def test_closest_of_many_pairs_compares_points_of_one_pair(spark):
    rng = np.random.default_rng(3)
    sizes = {("a", "b"): (300, 200), ("a", "c"): (1, 40), **{(f"p{i:03d}", f"q{i:03d}"): (5, 7) for i in range(120)}}
    q, c, want, at = [], [], {}, 0
    for (src, dst), (n, m) in sizes.items():
        x, y = rng.uniform(0, 9, (n, 2)), rng.uniform(0, 9, (m, 2))
        q += [(src, dst, 0, 0, at + i, float(a), float(b)) for i, (a, b) in enumerate(x)]
        c += [(src, dst, 0, 0, at + i, float(a), float(b)) for i, (a, b) in enumerate(y)]
        want[src, dst] = np.sqrt(((x[:, None] - y) ** 2).sum(-1)).min()
        at += 1000
    schema = "src string, dst string, cx long, cy long, id long, x double, y double"
    out = D._closest(spark.createDataFrame(q, schema), spark.createDataFrame(c, schema), 16)
    # one row for a crossing of chunks, where each group of 16 rows had one for every pair in it before
    rows = out.toPandas()
    least = rows.groupby(["src", "dst"])["d"].min()
    assert least.to_dict() == want
    assert len(rows) <= 120 + 64 + 3
