"""Evaluation of scored rows.

The confusion matrix is the only pass over the rows; accuracy, precision, recall
and F1 are read off its few cells. All functions accept weighted rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from facetforge.config import BoostSettings, ClassificationTask
from facetforge.functions.columns import column, key_fraction
from facetforge.operators.boosting import classifier, distinct_rows, sized_for_training
from facetforge.operators.encoding import encode, encoder, feature_columns, fit_vocabulary, with_label
from facetforge.operators.ordering import running_totals
from facetforge.storage import enable_checkpoints, materialise


def confusion_matrix(
    scored: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """(label, prediction, count): observed cells only, NULLs in their own cells."""
    n = F.sum(weight).cast("bigint") if weight else F.count("*")
    return scored.groupBy(column(label).alias("label"), column(prediction).alias("prediction")).agg(
        n.alias("count")
    )


def confusion_wide(cells: DataFrame, predictions: Sequence[float] = (0.0, 1.0)) -> DataFrame:
    """One row per label, one column per predicted class, zeros filled in."""
    return cells.groupBy("label").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("prediction") == p, F.col("count"))), F.lit(0)).alias(
                f"predicted_{int(p)}"
            )
            for p in predictions
        ]
    )


def _cells(label: float, prediction: float) -> Column:
    here = (F.col("label") == label) & (F.col("prediction") == prediction)
    return F.coalesce(F.sum(F.when(here, F.col("count"))), F.lit(0))


def summary(cells: DataFrame) -> DataFrame:
    """One row of metrics from a confusion matrix.

    A row counts as correct when label and prediction are equal; NULL equals
    nothing but still counts in the total. Without rows the ratios are NULL.
    """
    sums = cells.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total"),
        F.coalesce(
            F.sum(F.when(F.col("label") == F.col("prediction"), F.col("count"))), F.lit(0)
        ).alias("correct"),
        _cells(1.0, 1.0).alias("_tp"),
        _cells(0.0, 1.0).alias("_fp"),
        _cells(1.0, 0.0).alias("_fn"),
    )
    doubled = F.lit(2) * F.col("_tp")
    return sums.select(
        "total",
        "correct",
        F.try_divide("correct", "total").alias("accuracy"),
        F.try_divide(F.col("_tp"), F.col("_tp") + F.col("_fp")).alias("precision"),
        F.try_divide(F.col("_tp"), F.col("_tp") + F.col("_fn")).alias("recall"),
        F.try_divide(doubled, doubled + F.col("_fp") + F.col("_fn")).alias("f1"),
    )


def accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return summary(confusion_matrix(scored, label, prediction)).select("total", "correct", "accuracy")


def positive_probability(scored: DataFrame, name: str = "score") -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    return scored.withColumn(name, F.get(vector_to_array("probability"), 1))


def area_under_roc(
    scored: DataFrame, label: str = "label", score: str = "score", weight: str | None = None
) -> DataFrame:
    """Exact area under the ROC curve, equal scores counted half.

    Rows are first reduced to one row per score. Every positive then counts the
    negatives below it, which needs running totals over the scores; those run
    per score range. NULL when a class is missing.
    """
    amount = column(weight) if weight else F.lit(1)
    per_score = (
        scored.filter(column(label).isNotNull() & column(score).isNotNull())
        .groupBy(column(score).alias("score"))
        .agg(
            F.sum(F.when(column(label) == 1.0, amount).otherwise(0)).cast("double").alias("positives"),
            F.sum(F.when(column(label) == 1.0, 0).otherwise(amount)).cast("double").alias("negatives"),
        )
    )
    totalled = running_totals(per_score, [F.col("score")], {"negatives_to_here": F.col("negatives")})
    won = F.col("positives") * (F.col("negatives_to_here") - F.col("negatives") / 2)
    sums = totalled.agg(
        F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"), F.sum(won).alias("_won")
    )
    pairs = F.nullif(F.col("positives") * F.col("negatives"), F.lit(0.0))
    return sums.select(
        F.coalesce(F.col("positives"), F.lit(0.0)).cast("bigint").alias("positives"),
        F.coalesce(F.col("negatives"), F.lit(0.0)).cast("bigint").alias("negatives"),
        (F.col("_won") / pairs).alias("auc"),
    )


def holdout_split(
    df: DataFrame, keys: Sequence[str], holdout: float = 0.2, seed: int = 7
) -> tuple[DataFrame, DataFrame]:
    """(training, hold-out), decided per row by a hash of its keys.

    The same row lands on the same side in every run, and no shuffle is needed.
    """
    if not keys:
        raise ValueError("a hold-out split needs key columns")
    draw = key_fraction(seed, *[column(k) for k in keys])
    return df.filter(draw >= holdout), df.filter(draw < holdout)


def group_folds(df: DataFrame, group: Sequence[str], folds: int, seed: int = 7) -> DataFrame:
    """Add ``fold``, from 0 on, by a hash of the group's columns: rows of one group
    are in one fold, so none of it is trained on while the rest is judged."""
    draw = key_fraction(seed, *[column(c) for c in group])
    return df.withColumn("fold", F.floor(draw * F.lit(folds)).cast("int"))


def cross_validate(
    df: DataFrame,
    task: ClassificationTask,
    settings: BoostSettings,
    depths: Sequence[int],
    folds: int = 3,
    group: Sequence[str] | None = None,
) -> tuple[DataFrame, CrossValidatorModel]:
    """Mean hold-out AUC per tree depth over ``folds`` folds.

    Rows fall into folds by a hash of their keys, or of ``group``, and are then
    reduced to weighted distinct rows per fold.
    """
    spark = df.sparkSession
    enable_checkpoints(spark)
    if not (group or task.keys):
        raise ValueError("cross validation needs key columns to assign folds")
    attributes = feature_columns(df, task)
    labelled = group_folds(with_label(df, task), group or task.keys, folds, settings.seed)
    compact = materialise(distinct_rows(labelled, attributes, ["fold"]), "fold-rows")
    vocabulary = fit_vocabulary(compact, attributes, weight="weight")
    prepared = encode(
        compact, encoder(compact, vocabulary), attributes, ("label", "features", "weight", "fold")
    )
    training = sized_for_training(prepared, compact.count(), vocabulary.width)
    training = training.persist(StorageLevel.MEMORY_AND_DISK)
    trees = classifier(settings)
    validator = CrossValidator(
        estimator=trees,
        estimatorParamMaps=ParamGridBuilder().addGrid(trees.maxDepth, list(depths)).build(),
        evaluator=BinaryClassificationEvaluator(
            labelCol="label", rawPredictionCol="rawPrediction", weightCol="weight", numBins=0
        ),
        numFolds=folds,
        foldCol="fold",
        seed=settings.seed,
    )
    try:
        model = validator.fit(training)
    finally:
        training.unpersist()
    rows = [(int(d), float(m)) for d, m in zip(depths, model.avgMetrics)]
    return spark.createDataFrame(rows, "max_depth int, mean_auc double"), model
