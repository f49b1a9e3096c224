"""Training jobs end in an evaluation; the grid names its points and its best one; literal rows become a table."""

from pyspark.sql import functions as F

from tessera.operators import jobs as J
from tessera.sources.files import from_rows

X = ["a", "b"]


def _rows(spark):
    data = [(float(i % 3), float(i % 3) + 0.01 * (i % 7), float(i % 5)) for i in range(150)]
    return from_rows(spark, data, "label double, a double, b double")  # S5


def test_multiclass_grid_and_evaluation(spark):
    rows = _rows(spark)
    cv = J.grid_search(rows, X, depths=(1, 2), etas=(0.5,), folds=2, rounds=2, multiclass=True)
    res = J.grid_results(cv)
    assert [(r["maxDepth"], r["stepSize"]) for r in res] == [(1, 0.5), (2, 0.5)] and sum(r["best"] for r in res) == 1
    assert max(r["avg_metric"] for r in res) == next(r["avg_metric"] for r in res if r["best"])
    assert J.evaluate_classifier(cv.bestModel, rows, X).first()["accuracy"] > 0.9


def test_bin_edges_keep_few_values_and_cut_many_evenly(spark):
    rows = spark.range(4000).select((F.col("id") % 32).cast("double").alias("a"), F.col("id").cast("double").alias("b"),
                                    F.when(F.col("id") == 7, 9.0).otherwise(1.5).alias("c"), F.lit(2.0).alias("d"))
    a, b, c, d = J.bin_edges(rows.repartition(8), ["a", "b", "c", "d"])
    assert a == [float(i) for i in range(32)] and c == [1.5, 9.0] and d == [2.0]   # a single odd row keeps its bin
    assert len(b) == 32 and b[0] == 0.0 and max(abs(v - 125 * i) for i, v in enumerate(b)) <= 8


def test_boosted_trees_learn_from_counts_of_bins(spark):
    """Copies of the rows add nothing to what the trees are taught from, and the trees are those of the rows themselves."""
    from pyspark.ml.classification import GBTClassifier, OneVsRest
    rows = _rows(spark).withColumn("label", F.when(F.col("b") == 4, F.lit(0.0)).otherwise(F.col("label")))
    one, _ = J.binned_cells(rows, X, ["label"])
    many, _ = J.binned_cells(rows.crossJoin(spark.range(20)), X, ["label"])
    weights = [t.agg(F.count("*"), F.sum("_weight")).first() for t in (one, many)]
    assert weights[0][0] == weights[1][0] and (weights[0][1], weights[1][1]) == (150, 3000)
    plain = OneVsRest(classifier=GBTClassifier(stepSize=0.8, maxDepth=2, maxIter=5, seed=1)).fit(J._vec(rows, X)).transform(J._vec(rows, X))
    ours = J.boosted_multiclass(rows, X, rounds=5).transform(J._vec(rows, X))
    pick = lambda df: sorted(map(tuple, df.select("a", "b", "label", "prediction").collect()))
    assert pick(ours) == pick(plain)
    wide = spark.range(2000).select(F.col("id").cast("double").alias("a"), (F.col("id") > 990).cast("double").alias("label"))
    model = J.boosted_multiclass(wide, ["a"], rounds=2)
    assert "{" not in model.stages[-1].models[0].toDebugString   # bins are in order, no categories
    assert model.transform(wide).filter("prediction <> label").count() <= 63   # one bin


def test_bins_refuse_missing_features(spark):
    import pytest
    for bad in (None, float("nan")):
        rows = _rows(spark).unionByName(from_rows(spark, [(1.0, bad, 2.0)], "label double, a double, b double"))
        with pytest.raises(Exception):
            J.boosted_multiclass(rows, X, rounds=1)


def test_nearest_centre_keeps_every_row(spark):
    rows = _rows(spark).select(F.array("a", "b").alias("features"))
    centres = spark.createDataFrame([(0, [0.0, 2.0]), (1, [2.0, 2.0])], "centre int, centroid array<double>")
    out = J.nearest_centre(rows, centres)
    assert out.count() == 150 and {r["cluster"] for r in out.collect()} == {0, 1}
