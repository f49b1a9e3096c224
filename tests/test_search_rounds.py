"""Search by slices: passes follow the bytes of the candidates, not the number of slices; results as in plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import blocks
from tessera.operators import recommend as R

from .test_search_paths import _brute, _frame, _got


@pytest.fixture()
def written(monkeypatch):
    """Counts the tables that a search writes."""
    tables, original = [], blocks.cut_lineage

    def counted(df, **options):
        tables.append(df.columns)
        return original(df, **options)

    monkeypatch.setattr(blocks, "cut_lineage", counted)
    return tables


@pytest.fixture()
def sliced(monkeypatch):
    """Rows of every slice that is sent."""
    rows, original = [], blocks._slices

    def seen(*args):
        for x in original(*args):
            rows.append(len(x["_tid"]))
            yield x

    monkeypatch.setattr(blocks, "_slices", seen)
    return rows


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(12)
    x = rng.normal(size=(150, 6))
    x[40:60] = x[40]  # ties
    return x


def test_many_small_slices_take_one_pass(spark, vectors, written, sliced):
    df = _frame(spark, vectors).drop("name")
    out = blocks.top_k(df, df, 4, exclude_self=True, broadcast_bytes=1000)
    assert _got(out) == _brute(vectors, vectors, 4, True)
    assert len(written) == 1                                     # the candidates; one table a slice before
    assert sum(sliced) == 150 and max(sliced) * 112 <= 1000      # and no broadcast is above the bound


@pytest.mark.parametrize("default", [3000, 9000])
def test_rounds_of_slices_match_brute_force_and_carry_columns(spark, vectors, written, monkeypatch, default):
    monkeypatch.setattr(blocks, "DEFAULT_BROADCAST_BYTES", default)
    df = _frame(spark, vectors)
    out = blocks.top_k(df, df, 4, aux=["name"], exclude_self=True, broadcast_bytes=800)
    rows = out.collect()
    assert _got(out) == _brute(vectors, vectors, 4, True)
    assert all(r["aux_name"] == f"name{r['tid']}" * 3 for r in rows)
    assert 2 < len(written) < 15


def test_joined_slices_of_a_tile_match(spark, monkeypatch):
    monkeypatch.setattr(blocks, "_TILE", 40)
    rng = np.random.default_rng(13)
    x = np.round(rng.normal(size=(300, 2)), 1)                   # many equal distances
    df = _frame(spark, x).drop("name")
    assert _got(blocks.top_k(df, df, 5, exclude_self=True, broadcast_bytes=1200)) == _brute(x, x, 5, True)


def test_blocked_recommendation_takes_one_pass(spark, vectors, written, sliced):
    df = _frame(spark, vectors).drop("name")
    got = {}
    for r in sorted(R.recommend_for_all(df, df, 3, block_size=8, force_blocked=True).collect(), key=lambda r: (r["src"], r["rank"])):
        got.setdefault(r["src"], []).append(r["dst"])
    want = vectors @ vectors.T
    assert got == {i: sorted(range(150), key=lambda j: (-round(want[i, j], 9), j))[:3] for i in range(150)}
    assert len(written) == 1 and sliced == [8] * 18 + [6]        # 19 tables before


def test_tuned_partitions_are_the_tasks_of_the_search(spark, vectors, written):
    df = R.tune_partitions(_frame(spark, vectors).drop("name"), 40)
    out = R.recommend_for_all(df, df, 3, block_size=8, force_blocked=True)
    assert out.rdd.getNumPartitions() == 40                      # before, files of an earlier pass packed by size
    assert len(written) == 1 and out.count() == 450


def test_quota_blocks_are_not_cut(spark, vectors, sliced):
    df = _frame(spark, vectors).withColumn("id", F.col("id") * 7)
    R.recommend_for_all(df, df, 5, approximate=True, block_size=30, broadcast_bytes=4000).count()
    assert sorted(sliced) == [30] * 5


@pytest.mark.parametrize("piece,default", [(1500, 1 << 26), (1500, 6000)])
def test_the_driver_reads_a_round_in_pieces(spark, vectors, monkeypatch, piece, default):
    seen, original = [], blocks._slices

    def counted(part, *args):
        seen.append(int(part["_bytes"].sum()))
        return original(part, *args)

    monkeypatch.setattr(blocks, "_PIECE_BYTES", piece)
    monkeypatch.setattr(blocks, "DEFAULT_BROADCAST_BYTES", default)
    monkeypatch.setattr(blocks, "_slices", counted)
    df = _frame(spark, vectors).drop("name")
    assert _got(blocks.top_k(df, df, 4, exclude_self=True, broadcast_bytes=400)) == _brute(vectors, vectors, 4, True)
    assert len(seen) == 12 and sum(seen) == 150 * 112            # 16,800 bytes, dealt by hash
