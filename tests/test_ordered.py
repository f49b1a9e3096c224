"""Ranks and running totals by ranges: equal to a plain window, whatever the ties, nulls and sizes."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.features import index_labels, label_index_table
from tessera.operators.ordered import row_ranks, running_totals
from tessera.operators.stats import label_histogram


@pytest.fixture(scope="module")
def rows(spark):
    # a third of the rows share one key; nulls in both columns
    data = [(i, None if i % 11 == 0 else 5 if i % 3 == 0 else i % 37, f"k{i % 7}" if i % 5 else None, float(i % 4)) for i in range(600)]
    return spark.createDataFrame(data, "id long, a int, b string, x double").repartition(5)


def test_ranks_follow_a_compound_order(rows):
    order = [F.col("a").desc(), F.col("b").asc(), F.col("id").asc()]
    want = {r["id"]: r["w"] - 1 for r in rows.withColumn("w", F.row_number().over(Window.orderBy(*order))).collect()}
    for kw in ({"ranges": 9}, {"small": 0, "rows_per_range": 50}, {}):
        assert {r["id"]: r["rank"] for r in row_ranks(rows, order, **kw).collect()} == want


def test_equal_keys_are_cut_apart_and_numbered_once(spark, rows):
    same = rows.withColumn("a", F.lit(1))
    ranked = row_ranks(same, [F.col("a").asc()], ranges=6)
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(600))
    from tessera.operators.ordered import _in_ranges, _numbered
    sizes = [r["count"] for r in _in_ranges(_numbered(same)[0], [F.col("a").asc()], 6).groupBy(F.shiftright("_at", 33)).count().collect()]
    assert len(sizes) == 6 and max(sizes) < 200


def test_running_totals(rows):
    w = Window.orderBy(F.col("b").asc(), F.col("id").desc()).rowsBetween(Window.unboundedPreceding, 0)
    want = {r["id"]: (r["p"], r["q"]) for r in rows.withColumn("p", F.sum("a").over(w)).withColumn("q", F.sum("x").over(w)).collect()}
    got = running_totals(rows, [F.col("b").asc(), F.col("id").desc()], ["a", "x"], ranges=7)
    for r in got.collect():
        p, q = want[r["id"]]
        assert (r["a_cum"], r["x_cum"]) == (p or 0, q)


def test_empty_tables(rows):
    empty = rows.limit(0)
    assert row_ranks(empty, [F.col("id").asc()]).count() == 0 and row_ranks(empty, [F.col("id").asc()], ranges=3).count() == 0
    assert running_totals(empty, "id", ["a"]).count() == 0


def test_label_index_by_ranges(spark, rows, monkeypatch):
    from tessera.operators import features
    want = {r["value"]: (r["freq"], r["label_index"]) for r in label_index_table(rows, "a").collect()}
    order = sorted((v for v in want if v is not None), key=lambda v: (-want[v][0], v))
    assert [want[v][1] for v in order] == sorted(want[v][1] for v in order)
    monkeypatch.setattr(features, "row_ranks", lambda df, o, out: row_ranks(df, o, out, ranges=4))
    assert {r["value"]: (r["freq"], r["label_index"]) for r in label_index_table(rows, "a").collect()} == want
    assert index_labels(rows, "b").count() == 600


def test_histogram_fills_a_wide_gap(spark):
    h = label_histogram(spark.createDataFrame([(0.0,), (3_000_000.0,)], "label double"))
    assert h.count() == 3_000_001 and h.agg(F.sum("n")).first()[0] == 2
    assert label_histogram(spark.createDataFrame([], "label double")).count() == 0
