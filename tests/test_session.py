"""Session helpers: checkpoint folder, lineage cut / release, bounded broadcast."""

import os

from tessera.session import broadcast_if_bounded, checkpoint_dir, cut_lineage, release, row_count_at_most


def test_checkpoint_dir_comes_from_the_session(spark):
    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_cut_and_release(spark):
    df = spark.range(100).selectExpr("id", "id * 2 as twice")
    cut = cut_lineage(df)
    assert cut.count() == 100 and sorted(cut.columns) == ["id", "twice"]
    local = cut._tessera_path.replace("file:", "")
    assert os.path.exists(local)
    release(cut)
    assert not os.path.exists(local)
    release(df)  # not a cut table: nothing happens


def test_bounded_broadcast(spark):
    small = spark.range(10)
    assert row_count_at_most(small, 10) == 10 and row_count_at_most(small, 9) is None
    plan_small = small.join(broadcast_if_bounded(spark.range(5), 10), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan_small
