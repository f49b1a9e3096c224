"""Evaluation of scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import running_totals


def precision_by_threshold(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """For each distinct score t: positives / rows among rows with score >= t.

    Output ``threshold, precision`` (plus the cumulative counts ``tp, predicted``).
    A row without a score lies below every threshold and is never counted.
    One aggregate per distinct score, then a range-partitioned running total.
    """
    per_score = df.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.when(F.col(label) > 0.5, 1).otherwise(0)).cast("long").alias("pos"),
        F.count(F.lit(1)).alias("cnt"))
    cum = running_totals(per_score, "threshold", ["pos", "cnt"], descending=True)
    return cum.select(
        "threshold",
        F.col("pos_cum").alias("tp"),
        F.col("cnt_cum").alias("predicted"),
        (F.col("pos_cum") / F.col("cnt_cum")).alias("precision"))


def confusion_table(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts per (label, prediction)."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")) \
             .agg(F.count(F.lit(1)).alias("n"))


def per_class_stats(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall and F1 per class, from the confusion table.

    Everything happens on the (label, prediction) table, whose size is the
    square of the class count, never on the rows themselves.
    """
    conf = confusion_table(df, label, prediction)
    tp = conf.filter(F.col("label") == F.col("prediction")).select(F.col("label").alias("cls"), F.col("n").alias("tp"))
    actual = conf.groupBy(F.col("label").alias("cls")).agg(F.sum("n").alias("actual"))
    predicted = conf.groupBy(F.col("prediction").alias("cls")).agg(F.sum("n").alias("predicted"))
    classes = actual.select("cls").unionByName(predicted.select("cls")).distinct()
    s = (classes.join(tp, "cls", "left").join(actual, "cls", "left").join(predicted, "cls", "left")
         .fillna(0, ["tp", "actual", "predicted"]))
    prec = F.col("tp") / F.nullif(F.col("predicted"), F.lit(0))
    rec = F.col("tp") / F.nullif(F.col("actual"), F.lit(0))
    return s.select(
        "cls", F.col("tp").cast("long").alias("tp"), F.col("actual").cast("long").alias("actual"),
        F.col("predicted").cast("long").alias("predicted"),
        prec.alias("precision"), rec.alias("recall"),
        (2 * prec * rec / F.nullif(prec + rec, F.lit(0))).alias("f1"))


def multiclass_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and weighted precision / recall / F1 in one row.

    The multiclass evaluator's default metric is weighted F1; the reference
    prints it as "accuracy", so both are returned under their own names.
    """
    st = per_class_stats(df, label, prediction)
    total = F.sum("actual")
    return st.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.coalesce(F.col("precision"), F.lit(0.0)) * F.col("actual")) / total).alias("weighted_precision"),
        (F.sum(F.coalesce(F.col("recall"), F.lit(0.0)) * F.col("actual")) / total).alias("weighted_recall"),
        (F.sum(F.coalesce(F.col("f1"), F.lit(0.0)) * F.col("actual")) / total).alias("weighted_f1"))


def log_loss(df: DataFrame, label: str = "label", prob: str = "probability",
             positive: float = 1.0, eps: float = 1e-15) -> DataFrame:
    """Mean of -[y ln p + (1-y) ln(1-p)] with y = (label == positive)."""
    p = F.least(F.greatest(F.col(prob).cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = F.when(F.col(label) == positive, 1.0).otherwise(0.0)
    return df.agg(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"),
                  F.count(F.lit(1)).alias("n"))
