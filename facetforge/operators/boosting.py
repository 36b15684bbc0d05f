"""Boosted-tree classification of encoded rows.

Spark's gradient-boosted trees fit each round to first-order residuals;
second-order boosting libraries weigh leaves by curvature and add an L2 term. On
separable data the predicted classes agree; probabilities and tree shapes need
not. A zero in a one-hot block may be read as "missing" or as "not this
category": both allow the same split, so no special case is needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from facetforge.config import BoostSettings, ClassificationTask
from facetforge.functions.columns import column
from facetforge.operators.encoding import (
    MAX_LOCAL_CATEGORIES,
    as_categories,
    encode,
    encoder,
    feature_columns,
    fit_vocabulary,
    with_label,
)
from facetforge.storage import enable_checkpoints, materialise

MODEL_COLUMNS = ("features", "rawPrediction", "probability", "prediction")
# Most attribute combinations, and bytes of their scores, that may be broadcast.
MAX_LOCAL_COMBINATIONS = 100_000
MAX_LOCAL_SCORE_BYTES = 128 * 1024 * 1024
# Boosting runs thousands of short stages, so small inputs must not be spread
# thin; and a training row is held as one 4-byte bin per vector position, so wide
# rows need more tasks.
ROWS_PER_TRAINING_TASK = 20_000
BYTES_PER_TRAINING_TASK = 128 * 1024 * 1024


def distinct_rows(df: DataFrame, attributes: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Equal training rows as one row with a weight.

    Categorical tables repeat themselves, and a weighted row trains exactly like
    its copies. Counting starts before the shuffle, so no group of copies ever
    meets in one task. Rows without a label cannot train and are left out.
    """
    columns = [column(c) for c in ("label", *extra, *attributes)]
    return (
        as_categories(df, attributes)
        .filter(F.col("label").isNotNull())
        .groupBy(*columns)
        .agg(F.count("*").cast("double").alias("weight"))
    )


def classifier(settings: BoostSettings) -> GBTClassifier:
    return GBTClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        lossType="logistic",
        stepSize=settings.step_size,
        maxDepth=settings.max_depth,
        maxIter=settings.rounds,
        subsamplingRate=settings.subsampling_rate,
        maxMemoryInMB=settings.max_memory_mb,
        checkpointInterval=settings.checkpoint_interval,
        # One-hot inputs have two values each; more bins would go unused.
        maxBins=2,
        seed=settings.seed,
    )


def sized_for_training(df: DataFrame, rows: int, width: int) -> DataFrame:
    """Bring the training rows to a partition count that fits their number and
    size: enough to keep the cluster busy, and never too large to hold."""
    by_work = min(
        -(-rows // ROWS_PER_TRAINING_TASK), 2 * df.sparkSession.sparkContext.defaultParallelism
    )
    by_size = -(-rows * 4 * width // BYTES_PER_TRAINING_TASK)
    wanted = max(1, by_work, by_size)
    return df.repartition(wanted) if wanted > 1 else df.coalesce(1)


@dataclass(frozen=True)
class TrainingSet:
    """Weighted, encoded training rows (label, features, weight), held in memory
    and on disk until ``release``, and the encoder that made them."""

    rows: DataFrame
    encoder: PipelineModel
    distinct_rows: int
    combinations: DataFrame  # the attributes of the stored training rows

    def release(self) -> None:
        self.rows.unpersist()


def prepare_training(
    df: DataFrame, task: ClassificationTask, local_limit: int = MAX_LOCAL_CATEGORIES
) -> TrainingSet:
    """Vocabulary, encoder and encoded rows. The input is scanned once: both the
    vocabulary and the training rows start from the stored distinct rows. More
    categories than ``local_limit`` raise VocabularyTooLarge."""
    enable_checkpoints(df.sparkSession)
    attributes = feature_columns(df, task)
    compact = materialise(distinct_rows(with_label(df, task), attributes), "training-rows")
    vocabulary = fit_vocabulary(compact, attributes, "weight", local_limit)
    preparation = encoder(compact, vocabulary)
    prepared = encode(compact, preparation, attributes, ("label", "features", "weight"))
    count = compact.count()
    rows = sized_for_training(prepared, count, vocabulary.width).persist(StorageLevel.MEMORY_AND_DISK)
    rows.count()
    return TrainingSet(rows, preparation, count, compact.select(*[column(a) for a in attributes]))


def fit_trees(training: TrainingSet, settings: BoostSettings = BoostSettings()) -> PipelineModel:
    """Train on a prepared set. The model takes raw rows and can be saved."""
    return PipelineModel(stages=[*training.encoder.stages, classifier(settings).fit(training.rows)])


def train_classifier(
    df: DataFrame, task: ClassificationTask, settings: BoostSettings = BoostSettings()
) -> PipelineModel:
    """Fit vocabulary, encoder and trees on all labelled rows of ``df``."""
    training = prepare_training(df, task)
    try:
        return fit_trees(training, settings)
    finally:
        training.release()


def score(
    df: DataFrame,
    model: PipelineModel,
    task: ClassificationTask,
    by_combination: bool = False,
    combinations: DataFrame | None = None,
) -> DataFrame:
    """Keys, label (when the target is there), features and the model's columns
    for every row.

    A model gives equal rows equal scores. With ``by_combination`` each distinct
    combination of attributes is scored once and the scores are joined to the
    rows by broadcast, provided the combinations are few enough; otherwise, and
    by default, every row runs through the model. Neither way shuffles the rows.

    ``combinations`` spares the scan that finds the combinations: attributes, as
    text, among which are those of every row of ``df``.
    """
    attributes = feature_columns(df, task)
    rows = with_label(df, task) if task.target in df.columns else df
    label = ["label"] if task.target in df.columns else []
    # Keys are carried under names of their own, so that a column may be key and
    # attribute at once.
    carried = as_categories(
        rows.select(
            *[column(k).alias(f"_key_{i}") for i, k in enumerate(task.keys)],
            *label,
            *[column(a) for a in attributes],
        ),
        attributes,
    )
    few = None
    if by_combination:
        few = _few_combinations(carried if combinations is None else combinations, attributes)
    if few is None:
        scored = encode(carried, model, attributes)
    else:
        scores = materialise(encode(few, model, attributes), "combination-scores")
        scored = _join_scores(carried, scores, attributes)
    return scored.select(
        *[F.col(f"_key_{i}").alias(k) for i, k in enumerate(task.keys)], *label, *MODEL_COLUMNS
    )


def _few_combinations(rows: DataFrame, attributes: Sequence[str]) -> DataFrame | None:
    """The distinct attribute combinations, or None if they or their scores are
    too much for a broadcast."""
    distinct = rows.select(*[column(a) for a in attributes]).distinct()
    stored = materialise(distinct, "combinations")
    text = sum((F.coalesce(F.octet_length(column(a)), F.lit(0)) for a in attributes), F.lit(0))
    found = stored.agg(F.count("*").alias("rows"), F.sum(text).alias("bytes")).first()
    # Per attribute a string header and one vector entry, per row two short
    # vectors and the prediction.
    size = (found["bytes"] or 0) + found["rows"] * (32 * len(attributes) + 256)
    fits = found["rows"] <= MAX_LOCAL_COMBINATIONS and size <= MAX_LOCAL_SCORE_BYTES
    return stored if fits else None


def _join_scores(rows: DataFrame, scores: DataFrame, attributes: Sequence[str]) -> DataFrame:
    # Structs are equal when all fields are, NULL fields included.
    left = rows.withColumn("_combination", F.struct(*[column(a) for a in attributes]))
    right = scores.select(F.struct(*[column(a) for a in attributes]).alias("_combination"), *MODEL_COLUMNS)
    return left.join(F.broadcast(right), "_combination")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.load(path)
