"""Ranked search against a plain program and against its SQL twin, with many blocks of items and of classes, and edge cases."""

import math
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import search

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _brute(docs, items, best=10):
    bags = [(i, Counter(TERM.findall((t or "").translate(LOW)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall((t or "").translate(LOW)))
    out = []
    for item, terms in asked.items():
        found = []
        for i, b in bags:
            m = 10 + (90 * b.total() * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m)) for t in terms & b.keys())
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:best])]
    return sorted(out, key=repr)


def _run(spark, docs, items, best=10):
    return sorted(map(tuple, search.search(docs, items, best).collect()), key=repr)


@pytest.mark.parametrize("item_terms,pairs", [(250_000, 2_000_000), (9, 3)])
def test_brute_force_and_edges(spark, monkeypatch, item_terms, pairs):
    monkeypatch.setattr(search, "ITEM_TERMS", item_terms)
    monkeypatch.setattr(search, "PAIRS", pairs)
    docs = [(i, f"alpha {'beta ' * (i % 3)}gamma{i % 4}, x_y z{i % 2}") for i in range(1, 40)]
    docs += [(100 + i, "Alpha! copy-COPY of delta\x00é") for i in range(30)] + [(7, "alpha again"), (7, "alpha again"), (None, "alpha delta é")]
    docs += [(200, None), (201, ""), (202, "...!"), (203, "É É delta " * 3000)]
    items = [(1, "ALPHA delta"), (2, "é É copy"), (2, "beta"), (None, "gamma1 z0"), (4, None), (5, ""), (6, "unseen words"), (7, "x y z1 z1")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for name in ("n", "terms", "class", "item", "score", "rank", "member"):
        d, i = d.withColumn(name, F.lit("z")), i.withColumn(name, F.lit("z"))
    for best in (10, 3):
        assert _run(spark, d.repartition(5), i, best) == _brute(docs, items, best)
    assert _run(spark, d.limit(0), i) == [] and _run(spark, d, i.limit(0)) == [] and _run(spark, d, i.filter("item_id = 6")) == []


def test_matches_sql(spark):
    from ..oracle_check import canon
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert canon(search.op11_lexical_search(spark, SF).toPandas()) == canon(con.execute(search.ORACLE_SQL).df())
