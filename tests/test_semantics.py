"""One test per 'semantics to mend' note of the inventory."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import jobs as J
from tessera.operators import knn as N
from tessera.operators import patterns as Q


def _line(spark):
    # five points on a line, labels and weights chosen so that weights flip the vote
    rows = [(1, [0.0], 0, 1.0), (2, [1.0], 1, 5.0), (3, [2.0], 0, 1.0), (4, [10.0], 1, 1.0), (5, [11.0], 1, 1.0)]
    return spark.createDataFrame(rows, "id long, features array<double>, label int, w double")


def test_weighted_votes_and_regression(spark):
    df = _line(spark)
    q = spark.createDataFrame([(100, [1.0])], "id long, features array<double>")
    p = N.KNNParams(k=3, weight_col="w")
    c = N.knn_classify(q, df, p, num_classes=2).first()
    # neighbours 2 (w5, class 1), 1 and 3 (w1 each, class 0): class 1 wins only with weights
    assert c["prediction"] == 1.0 and c["probability"] == pytest.approx([2 / 7, 5 / 7])
    plain = N.knn_classify(q, df, N.KNNParams(k=3), num_classes=2).first()
    assert plain["prediction"] == 0.0
    r = N.knn_regress(q, df, p).first()
    assert r["prediction"] == pytest.approx(5 / 7)


def test_no_neighbour_left_gives_null(spark):
    df = _line(spark)
    q = spark.createDataFrame([(100, [50.0])], "id long, features array<double>")
    p = N.KNNParams(k=2, max_distance=1.0)
    assert N.knn_classify(q, df, p, num_classes=2).first()["prediction"] is None
    assert N.knn_regress(q, df, p).first()["prediction"] is None


def test_vote_ties_go_to_smallest_class(spark):
    df = spark.createDataFrame([(1, [0.0], 1), (2, [2.0], 0)], "id long, features array<double>, label int")
    q = spark.createDataFrame([(9, [1.0])], "id long, features array<double>")
    assert N.knn_classify(q, df, N.KNNParams(k=2), num_classes=2).first()["prediction"] == 0.0


def test_repeated_items_in_a_basket_count_once(spark):
    b = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["a", "b"]), (3, ["b"])], "basket long, items array<string>")
    got = {tuple(r["items"]): r["freq"] for r in Q.frequent_itemsets(b, 2).collect()}
    assert got == {("a",): 2, ("b",): 3, ("a", "b"): 2}


def test_regression_table_hand_value(spark):
    row = {"pay_0": 1, "pay_2": 2, "pay_3": 0, "pay_4": 0, "pay_5": 1, "pay_6": 0}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} int" for k in row))
    z = -1.3068491709149153 + 0.12325947107501224 + 2 * 0.18065053351842655 + 0.03271040044767765
    got = J.score_regression_table(df, J.CREDIT_TABLE).first()
    assert got["probability_1"] == pytest.approx(1 / (1 + math.exp(-z)))
    assert got["prediction"] == (1.0 if z > 0 else 0.0)


def test_conditional_transactions_prefixes(spark):
    b = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a", "b"]), (3, ["a"])], "basket long, items array<string>")
    # ranks: a 0 (3), b 1 (2), c 2 (1); with 2 partitions: rank mod 2
    got = {(r["basket"], r["part"]): r["prefix"] for r in Q.conditional_transactions(b, 1, 2).collect()}
    assert got == {(1, 0): [0, 1, 2], (1, 1): [0, 1], (2, 1): [0, 1], (2, 0): [0], (3, 0): [0]}


def test_ml_estimator_surface(spark):
    from tessera.operators.knn_ml import KNN, KNNClassifier, KNNRegression
    df = _line(spark)
    q = spark.createDataFrame([(100, [1.0])], "id long, features array<double>")
    m = KNN().setK(2).setAuxCols(["label"]).fit(df)
    row = m.transform(q).first()
    assert [n["id"] for n in row["neighbors"]] == [2, 1] and row["distances"] == [0.0, 1.0]
    c = KNNClassifier().setK(3).setWeightCol("w").fit(df).transform(q).first()
    assert c["prediction"] == 1.0
    r = KNNRegression().setK(3).fit(df).transform(q).first()
    assert r["prediction"] == pytest.approx(1 / 3)
