"""Evaluation of predictions ``(id, fold, true, pred)`` as grouped aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUTCOMES = ["TP", "TN", "FP", "FN"]


def outcome(true: Column, pred: Column, positive: str = "positive", negative: str = "negative") -> Column:
    """TP, TN, FP or FN; null when either label is neither of the two."""
    return (
        F.when((true == positive) & (pred == positive), "TP")
        .when((true == negative) & (pred == negative), "TN")
        .when((true == negative) & (pred == positive), "FP")
        .when((true == positive) & (pred == negative), "FN")
    )


def with_outcome(predictions: DataFrame) -> DataFrame:
    """Rows with a valid outcome; rows with other labels are left out."""
    marked = predictions.withColumn("outcome", outcome(F.col("true"), F.col("pred")))
    return marked.where(F.col("outcome").isNotNull())


def outcome_summary(predictions: DataFrame, by: list[str] = ["fold"]) -> DataFrame:
    """Count per outcome with the first and last example id; the full lists belong in the error log."""
    return with_outcome(predictions).groupBy(*by, "outcome").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


def confusion(predictions: DataFrame, labels: list[str]) -> DataFrame:
    """true, pred, n in the given label order, zero cells included.

    One pass: every cell is a conditional count, so no grid is joined.
    """
    cells = [(t, p) for t in labels for p in labels]
    counts = [
        F.count_if((F.col("true") == t) & (F.col("pred") == p)).alias(f"c{i}")
        for i, (t, p) in enumerate(cells)
    ]
    rows = [
        F.struct(
            F.lit(labels.index(t)).alias("true_pos"), F.lit(labels.index(p)).alias("pred_pos"),
            F.lit(t).alias("true"), F.lit(p).alias("pred"), F.col(f"c{i}").alias("n"),
        )
        for i, (t, p) in enumerate(cells)
    ]
    return predictions.agg(*counts).select(F.inline(F.array(*rows)))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def per_label_prf(predictions: DataFrame, by: list[str] = []) -> DataFrame:
    """Precision, recall, F1 and support of every label that occurs as truth or prediction."""
    sides = predictions.select(
        *by,
        F.explode(F.array(
            F.struct(F.col("true").alias("label"), F.lit(1).alias("t"), F.lit(0).alias("p"),
                     F.lit(0).alias("hit")),
            F.struct(F.col("pred").alias("label"), F.lit(0).alias("t"), F.lit(1).alias("p"),
                     (F.col("true") == F.col("pred")).cast("int").alias("hit")),
        )).alias("s"),
    )
    sums = sides.groupBy(*by, F.col("s.label").alias("label")).agg(
        F.sum("s.t").alias("support"), F.sum("s.p").alias("predicted"), F.sum("s.hit").alias("hits")
    )
    precision = _ratio(F.col("hits"), F.col("predicted"))
    recall = _ratio(F.col("hits"), F.col("support"))
    return sums.select(*by, "label", "support", precision.alias("precision"), recall.alias("recall")) \
        .withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")))


def weighted_prf(predictions: DataFrame, by: list[str] = ["fold"]) -> DataFrame:
    """Support-weighted mean of per-label precision, recall and F1; support itself is undefined."""
    def mean(name: str) -> Column:
        return (F.sum(F.col(name) * F.col("support")) / F.sum("support")).alias(name)

    return per_label_prf(predictions, by).groupBy(*by).agg(
        mean("precision"), mean("recall"), mean("f1"), F.lit(float("nan")).alias("support")
    )


def fold_mean(scores: DataFrame, columns: list[str] = ["precision", "recall", "f1", "support"]) -> DataFrame:
    """Unweighted mean over folds that ignores NaN; NaN when nothing else is left."""
    def mean(name: str) -> Column:
        return F.coalesce(F.avg(F.when(~F.isnan(name), F.col(name))), F.lit(float("nan"))).alias(name)

    return scores.agg(*[mean(c) for c in columns])


def class_weights(labels: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights n / (k * n_c), one row per class."""
    counts = labels.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("k"))
    return counts.select(
        label, "n",
        (whole.select("total").scalar() / (whole.select("k").scalar() * F.col("n"))).alias("weight"),
    )
