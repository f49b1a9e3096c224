"""Ready-made training and scoring jobs on pyspark.ml."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, release


def _vec(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Feature vector; a null or NaN feature is an error, no row is left out."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error").transform(df)


BINS = 32  # bins of a feature that trees split at: Spark's default ``maxBins``
_BINS, _WEIGHT = "_bins", "_weight"


def bin_edges(df: DataFrame, cols: list[str], bins: int = BINS) -> list[list[float]]:
    """Lower bounds of at most ``bins`` bins of each column, from all rows: every value where there are no more, else quantiles."""
    import pyarrow as pa
    import pyarrow.compute as pc
    nums = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])

    def few(batches):
        # up to bins + 1 values of each column: one too many shows that there are more
        seen = [set() for _ in cols]
        for batch in batches:
            for i, s in enumerate(seen):
                if len(s) <= bins:
                    v = pc.unique(batch.column(i)).drop_null()
                    s.update(v.filter(pc.is_finite(v)).slice(0, 2 * bins + 2).to_pylist())
        rows = [(i, v) for i, s in enumerate(seen) for v in sorted(s)[:bins + 1]]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.float64())], ["i", "v"])

    values = [set() for _ in cols]
    for r in nums.mapInArrow(few, "i int, v double").distinct().groupBy("i").agg(F.sort_array(F.collect_set("v")).alias("v")) \
            .select("i", F.slice("v", 1, bins + 1).alias("v")).collect():
        values[r["i"]] = set(r["v"])
    many = [i for i, v in enumerate(values) if len(v) > bins]
    if many:
        quantiles = nums.approxQuantile([f"c{i}" for i in many], [j / bins for j in range(bins)], 1 / (32 * bins))
        for i, q in zip(many, quantiles):
            values[i] = {v for v in q if abs(v) < float("inf")}
    return [sorted(v) or [0.0] for v in values]


def binned_cells(train: DataFrame, cols: list[str], keys: list[str], bins: int = BINS):
    """All rows counted by ``keys`` and the bins of ``cols``: the written table with vectors of bin numbers and counts, and
    the stages that bin raw rows alike.

    Trees split at bounds of bins alone, so a count as weight teaches them what the rows would; the cells are
    bounded by the bins, not by the rows.
    """
    from pyspark.ml.feature import Bucketizer, VectorAssembler
    inf = float("inf")
    out = [f"_bin{i}" for i in range(len(cols))]
    stages = [Bucketizer(splitsArray=[[-inf, *e, inf] for e in bin_edges(train, cols, bins)], inputCols=cols, outputCols=out, handleInvalid="error"),
              VectorAssembler(inputCols=out, outputCol=_BINS, handleInvalid="error")]
    cells = stages[0].transform(train).groupBy(*keys, *out).agg(F.count(F.lit(1)).cast("double").alias(_WEIGHT))
    # without the bucketizer's metadata, which would make bin numbers categories: they are in order
    cells = cells.select(*keys, *[F.col(c).alias(c, metadata={}) for c in out], _WEIGHT)
    return cut_lineage(stages[1].transform(cells).select(*keys, _BINS, _WEIGHT)), stages


def boosted_multiclass(train: DataFrame, cols: list[str], label: str = "label", eta: float = 0.8,
                       depth: int = 2, rounds: int = 10, seed: int = 1):
    """M6: one-vs-rest boosted trees (eta, depth, rounds), taught by :func:`binned_cells` -> fitted model on raw columns."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import GBTClassifier, OneVsRest
    cells, stages = binned_cells(train, cols, [label])
    gbt = GBTClassifier(stepSize=eta, maxDepth=depth, maxIter=rounds, seed=seed)
    model = OneVsRest(classifier=gbt, labelCol=label, featuresCol=_BINS, weightCol=_WEIGHT).fit(cells)
    release(cells)
    return PipelineModel([*stages, model])


def random_forest(train: DataFrame, formula: str, trees: int = 20, seed: int = 1):
    """M7: formula + random forest pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import RFormula
    return Pipeline(stages=[RFormula(formula=formula), RandomForestClassifier(numTrees=trees, seed=seed)]).fit(train)


def decision_tree(train: DataFrame, cols: list[str], label: str = "label", depth: int = 5):
    """M8: decision tree; ``model.toDebugString`` prints the tree."""
    from pyspark.ml.classification import DecisionTreeClassifier
    return DecisionTreeClassifier(labelCol=label, maxDepth=depth).fit(_vec(train, cols))


def linear_svm(train: DataFrame, cols: list[str], label: str = "label", iters: int = 50):
    """M9: linear SVM on a binary label."""
    from pyspark.ml.classification import LinearSVC
    return LinearSVC(labelCol=label, maxIter=iters).fit(_vec(train, cols))


def logistic_pipeline(train: DataFrame, formula: str):
    """Formula + logistic regression with the saved pipeline's parameters
    (regParam 1.0, elasticNet 0, maxIter 100, tol 1e-4, threshold 0.5, standardised)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import RFormula
    lr = LogisticRegression(regParam=1.0, elasticNetParam=0.0, maxIter=100, tol=1e-4, threshold=0.5,
                            standardization=True)
    return Pipeline(stages=[RFormula(formula=formula), lr]).fit(train)


def kmeans(train: DataFrame, cols: list[str], k: int = 2, seed: int = 1):
    """KMeans fit."""
    from pyspark.ml.clustering import KMeans
    return KMeans(k=k, seed=seed).fit(_vec(train, cols))


def nearest_centre(df: DataFrame, centres: DataFrame, features: str = "features",
                   centre_id: str = "centre", centre_vec: str = "centroid") -> DataFrame:
    """M11 assignment step: each row to its nearest centre (ties -> smallest id).

    Centres are a model-sized table (k rows); the search itself is the
    blocked top-1 of :mod:`blocks`, so a large k is not a broadcast risk.
    """
    from .blocks import top_k
    # the generated id is written, so both sides of the join see the same one
    tmp = cut_lineage(df.withColumn("_rid", F.monotonically_increasing_id()))
    res = top_k(tmp, centres, 1, qid="_rid", tid=centre_id, qvec=features, tvec=centre_vec, metric="l2")
    return tmp.join(res.select(F.col("qid").alias("_rid"), F.col("tid").alias("cluster"), "distance"), "_rid").drop("_rid")


def mlp(train: DataFrame, cols: list[str], layers: list[int], label: str = "label", iters: int = 100,
        seed: int = 1234):
    """Multilayer perceptron (sigmoid hidden units, softmax output), fitted by :mod:`perceptron` -> Spark's model."""
    from .perceptron import train as fit
    return fit(train, cols, layers, label, iters, seed=seed)


def grid_search(train: DataFrame, cols: list[str], label: str = "label", depths=(2, 3), etas=(0.1, 0.8),
                folds: int = 3, rounds: int = 5, seed: int = 1, multiclass: bool = False):
    """Depth x eta grid of boosted trees with k-fold cross-validation; ``bestModel`` is fitted on all rows.

    ``multiclass`` takes one tree ensemble per class (any number of classes)
    and compares by accuracy, else the label is 0 / 1 and the area under ROC counts.
    Every row falls into a random fold; the folds are taught and judged by their :func:`binned_cells`.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import GBTClassifier, OneVsRest
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    # the folds that CrossValidator itself would draw
    folded = train.withColumn("_fold", F.least(F.floor(F.rand(seed) * folds), F.lit(folds - 1)).cast("int"))
    cells, stages = binned_cells(folded, cols, ["_fold", label])
    gbt = GBTClassifier(labelCol=label, featuresCol=_BINS, weightCol=_WEIGHT, maxIter=rounds, seed=seed)
    grid = ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).addGrid(gbt.stepSize, list(etas)).build()
    est = OneVsRest(classifier=gbt, labelCol=label, featuresCol=_BINS, weightCol=_WEIGHT) if multiclass else gbt
    judge = MulticlassClassificationEvaluator(labelCol=label, weightCol=_WEIGHT, metricName="accuracy") if multiclass \
        else BinaryClassificationEvaluator(labelCol=label, weightCol=_WEIGHT)
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, numFolds=folds, seed=seed, evaluator=judge, foldCol="_fold").fit(cells)
    release(cells)
    cv.bestModel = PipelineModel([*stages, cv.bestModel])   # takes raw columns
    return cv


def grid_results(cv) -> list[dict]:
    """One row per grid point: its parameters, average metric, and whether it is the best."""
    best = max(range(len(cv.avgMetrics)), key=lambda i: cv.avgMetrics[i])
    return [{**{p.name: v for p, v in point.items()}, "avg_metric": float(cv.avgMetrics[i]), "best": i == best}
            for i, point in enumerate(cv.getEstimatorParamMaps())]


def evaluate_classifier(model, df: DataFrame, cols: list[str], label: str = "label") -> DataFrame:
    """Evaluation at the end of a job (M6, M12): accuracy and weighted precision, recall and F1 on ``df``."""
    from .evaluate import multiclass_metrics
    out = model.transform(_vec(df, cols)).select(F.col(label).cast("double").alias("label"), "prediction")
    return multiclass_metrics(out)


# M14 ---------------------------------------------------------------------------
# The saved regression table (target category 1; category 0
# has intercept 0 and no predictors), link = logit.
CREDIT_TABLE = {
    1: (-1.3068491709149153, {"pay_0": 0.12325947107501224, "pay_2": 0.18065053351842655,
                              "pay_3": 0.06526988375539071, "pay_4": 0.10440956046307726,
                              "pay_5": 0.03271040044767765, "pay_6": 0.10934943733103335}),
    0: (0.0, {}),
}


def score_regression_table(df: DataFrame, table: dict, category_out: str = "prediction") -> DataFrame:
    """Binary regression-table model with logit link: z = intercept + sum coef * field
    for the target category; p(1) = 1 / (1 + exp(-(z1 - z0))); prediction = argmax."""
    def z(cat):
        b, coefs = table[cat]
        return sum((F.col(f).cast("double") * c for f, c in coefs.items()), F.lit(b))
    p1 = 1.0 / (1.0 + F.exp(-(z(1) - z(0))))
    return df.withColumn("probability_1", p1).withColumn("probability_0", 1.0 - p1) \
             .withColumn(category_out, F.when(F.col("probability_1") > F.col("probability_0"), 1.0).otherwise(0.0))
