"""Hold-out and k-fold evaluation of classifiers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finchlake.operators import metrics, ordinal
from finchlake.plans import svm
from finchlake.plans.hooks import Hook
from finchlake.plans.model import HASH_SIZE, MAX_ITER, fit_problems, inputs_of, score, text_stages, train
from finchlake.session import written
from finchlake.sources.labelled import write_error_log


def holdout(
    labelled: DataFrame, key: str, share: float = 0.8, **options
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the first ``share`` of the rows in key order, predict the rest.

    ``options`` go to :func:`finchlake.plans.model.train`. Returns the model and the predictions
    (id, fold, true, pred).
    """
    placed, total = ordinal.ordinal(labelled, key)
    first = ordinal.is_train(total, share)
    model = train(placed.where(first), **options)
    scored = score(model, placed.where(~first).select(key, "label", "text"))
    return model, scored.select(
        F.col(key).alias("id"), F.lit(0).alias("fold"), F.col("label").alias("true"), "pred"
    )


def cross_validate(
    labelled: DataFrame,
    key: str,
    folds: int,
    architecture: str = "base",
    lexicon: dict[str, list[str]] | None = None,
    encoder: Callable | None = None,
    hash_size: int = HASH_SIZE,
    max_iter: int = MAX_ITER,
    legacy_tail: bool = False,
    cost: float = 1.0,
    log_path: str | None = None,
    lemmas: dict[str, str] | None = None,
    prepare: Hook | None = None,
) -> DataFrame:
    """Predictions (id, fold, true, pred, text) of contiguous k-fold cross-validation.

    Row-wise features are computed once and written to the shared folder. Document frequencies are counted by
    fold in one scan, and a fold's model takes those of the other folds. The models of all folds are fitted in
    the same passes, each on its own training rows, and one last pass predicts every fold by its model.
    """
    placed, total = ordinal.ordinal(labelled, key)
    fold = F.coalesce(ordinal.fold_id(total, folds, legacy_tail=legacy_tail), F.lit(-1))
    inputs = inputs_of(architecture)
    made = PipelineModel(text_stages(architecture, lexicon, encoder, hash_size, lemmas=lemmas, prepare=prepare)).transform(
        placed.withColumn("fold", fold))
    features = written(made.select(key, "fold", "label", "text", *inputs), "features")
    tested = total - 1 if legacy_tail else total
    fold_ids = list(range(-(-tested // ordinal.fold_width(total, folds))))
    read, blocks, problems, names = fit_problems(
        features, inputs, fold_ids, cost, max_iter, balanced=architecture == "BERTweet")
    scored = svm.predicted(read, blocks, problems, [key, "fold", "label", "text"])
    predictions = scored.select(
        F.col(key).alias("id"), "fold", F.col("label").alias("true"),
        F.when(F.col("margin") > 0, names[1]).otherwise(names[0]).alias("pred"), "text")
    if log_path is not None:
        predictions = written(predictions, "predictions")
        write_error_log(predictions, log_path, metrics.weighted_prf(predictions))
    return predictions


def cv_scores(predictions: DataFrame) -> DataFrame:
    """One row: mean precision, recall and F1 over the folds; support stays undefined."""
    return metrics.fold_mean(metrics.weighted_prf(predictions))
