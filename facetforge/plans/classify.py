"""Train, score, evaluate and load: the batch job from table to documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetforge.config import BoostSettings, ClassificationTask
from facetforge.operators.boosting import (
    MAX_LOCAL_COMBINATIONS,
    fit_trees,
    prepare_training,
    score,
)
from facetforge.operators.delivery import LoadResult, load_documents
from facetforge.operators.documents import vector_documents
from facetforge.operators.encoding import (
    MAX_LOCAL_CATEGORIES,
    VocabularyTooLarge,
    feature_columns,
    fit_vocabulary,
)
from facetforge.operators.metrics import (
    area_under_roc,
    confusion_matrix,
    holdout_split,
    positive_probability,
    summary,
)
from facetforge.operators.runs import QUALITIES, PhaseTimer
from facetforge.operators.wide_boosting import (
    WideModel,
    WideSettings,
    fit_wide,
    score_with_vectors,
)
from facetforge.storage import materialise


@dataclass(frozen=True)
class ClassificationRun:
    model: PipelineModel | WideModel
    scored: DataFrame
    confusion: DataFrame
    metrics: DataFrame
    load: LoadResult | None
    timer: PhaseTimer


@dataclass(frozen=True)
class DocumentTarget:
    store_path: str | None
    fallback_path: str
    dead_letter_path: str
    when_present: str = "divert"


def run_classification(
    table: DataFrame,
    task: ClassificationTask,
    settings: BoostSettings = BoostSettings(),
    target: DocumentTarget | None = None,
    run: str = "run",
    holdout: float = 0.0,
    local_limit: int = MAX_LOCAL_CATEGORIES,
) -> ClassificationRun:
    """The whole job, with each phase materialised and timed.

    Without ``holdout`` the model is evaluated on the rows it was trained on.
    With it, that share of the rows (chosen by key) is kept from training and
    the evaluation uses only them. All rows are scored either way, and scored
    rows are written once: evaluation and loading read the written table.

    With more categories than ``local_limit``, the trees are those of
    ``wide_boosting``, and vectors are made by joins; the columns are the same.
    """
    timer = PhaseTimer(run)
    training = holdout_split(table, task.keys, holdout)[0] if holdout else table
    with timer.phase("prepare"):
        try:
            prepared, vocabulary = prepare_training(training, task, local_limit), None
        except VocabularyTooLarge:
            attributes = feature_columns(training, task)
            prepared, vocabulary = None, fit_vocabulary(training, attributes, None, local_limit)
    if prepared is None:
        with timer.phase("train"):
            model = fit_wide(training, task, WideSettings(settings))
        with timer.phase("predict"):
            scored = materialise(score_with_vectors(table, model, task, vocabulary), "scored")
    else:
        try:
            with timer.phase("train"):
                model = fit_trees(prepared, settings)
        finally:
            prepared.release()
        with timer.phase("predict"):
            # Few distinct training rows mean few attribute combinations to score.
            few = prepared.distinct_rows <= MAX_LOCAL_COMBINATIONS
            # Training has seen every combination if it left out no row.
            seen = None if holdout or task.null_label == "drop" else prepared.combinations
            scored = materialise(
                score(table, model, task, by_combination=few, combinations=seen), "scored"
            )
    with timer.phase("evaluate"):
        judged = holdout_split(scored, task.keys, holdout)[1] if holdout else scored
        # One pass over the scored rows serves both the matrix and the AUC.
        cells = positive_probability(judged).groupBy("label", "prediction", "score")
        cells = materialise(cells.agg(F.count("*").alias("rows")), "judged")
        confusion = confusion_matrix(cells, weight="rows")
        auc = area_under_roc(cells, weight="rows").first()["auc"]
        metrics = summary(confusion).withColumn("auc", F.lit(auc).cast("double"))
        found = metrics.first()
        for quality in QUALITIES:
            value = found[quality]
            timer.record(quality, float("nan") if value is None else value)
    load = None
    if target is not None:
        with timer.phase("sink"):
            load = load_documents(
                vector_documents(scored, task),
                target.store_path,
                target.fallback_path,
                target.dead_letter_path,
                task.dataset_type,
                run,
                when_present=target.when_present,
            )
    timer.finish()
    return ClassificationRun(model, scored, confusion, metrics, load, timer)


def training_confusion(
    table: DataFrame, task: ClassificationTask, settings: BoostSettings
) -> DataFrame:
    """Confusion matrix of a model on its own training rows."""
    prepared = prepare_training(table, task)
    try:
        model = fit_trees(prepared, settings)
    finally:
        prepared.release()
    few = prepared.distinct_rows <= MAX_LOCAL_COMBINATIONS
    return confusion_matrix(score(table, model, task, by_combination=few))
