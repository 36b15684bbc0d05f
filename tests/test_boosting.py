import random

import pytest
from pyspark.sql import functions as F

from facetforge.config import BoostSettings, ClassificationTask
from facetforge.operators import boosting
from facetforge.operators.boosting import (
    distinct_rows,
    load_model,
    prepare_training,
    save_model,
    score,
    train_classifier,
)
from facetforge.operators.encoding import with_label
from facetforge.operators.metrics import confusion_matrix, summary
from facetforge.plans.classify import DocumentTarget, run_classification
from facetforge.storage import fresh_path

TASK = ClassificationTask("class", "p", keys=("k",), dataset_type="fixture")
SETTINGS = BoostSettings(rounds=3, max_depth=3)


@pytest.fixture(scope="module")
def separable(spark):
    draw = random.Random(5)
    rows = []
    for i in range(400):
        odor = draw.choice("anfy")
        rows.append((i, "p" if odor in "fy" else "e", odor, draw.choice("xbf?"), draw.choice(["t", None]), "c"))
    return spark.createDataFrame(
        rows, "k int, class string, odor string, `cap-shape` string, ring string, veil string"
    )


def test_separable_data_is_learned(spark, separable):
    model = train_classifier(separable, TASK, SETTINGS)
    scored = score(separable, model, TASK)
    assert scored.columns == ["k", "label", "features", "rawPrediction", "probability", "prediction"]
    assert scored.count() == 400
    assert summary(confusion_matrix(scored)).first()["accuracy"] == 1.0


def test_scoring_by_combination_changes_nothing(spark, separable, monkeypatch):
    model = train_classifier(separable, TASK, SETTINGS)

    def plain(scored):
        return sorted((r["k"], r["label"], r["prediction"], tuple(r["probability"]), tuple(r["features"].toArray()))
                      for r in scored.collect())

    # Keys and attributes may share columns; ring is NULL in many rows.
    wanted = plain(score(separable, model, TASK))
    joined = score(separable, model, TASK, by_combination=True)
    assert plain(joined) == wanted and len(wanted) == 400
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().toString()
    monkeypatch.setattr(boosting, "MAX_LOCAL_COMBINATIONS", 3)
    assert plain(score(separable, model, TASK, by_combination=True)) == wanted
    monkeypatch.undo()
    monkeypatch.setattr(boosting, "MAX_LOCAL_SCORE_BYTES", 1000)
    assert plain(score(separable, model, TASK, by_combination=True)) == wanted


def test_saved_model_scores_new_rows(spark, separable):
    model = train_classifier(separable, TASK, SETTINGS)
    path = fresh_path(spark, "model")
    save_model(model, path)
    new = spark.createDataFrame(
        [(1, "f", "never", None, None), (2, "a", "x", "t", "c")],
        "k int, odor string, `cap-shape` string, ring string, veil string",
    )
    scored = score(new, load_model(spark, path), TASK)
    assert "label" not in scored.columns
    assert {r["k"]: r["prediction"] for r in scored.collect()} == {1: 1.0, 2: 0.0}


def test_weighted_rows_train_like_their_copies(spark, separable):
    few = separable.select("k", "class", "odor", "cap-shape", "ring", "veil").limit(60)
    copies = few.select("*", F.explode(F.array(*[F.lit(i) for i in range(5)])).alias("c")).drop("c")
    attributes = ["odor", "cap-shape"]
    task = ClassificationTask("class", "p", keys=("k",), features=tuple(attributes))
    once = distinct_rows(with_label(few, task), attributes)
    five = distinct_rows(with_label(copies, task), attributes)
    assert once.count() == five.count()
    joined = once.withColumnRenamed("weight", "w").join(five, ["label", *attributes])
    assert joined.filter(F.col("weight") != 5 * F.col("w")).count() == 0
    one = score(few, train_classifier(few, task, SETTINGS), task)
    other = score(few, train_classifier(copies, task, SETTINGS), task)
    wanted = {r["k"]: r["probability"].toArray() for r in one.collect()}
    for r in other.collect():
        assert abs(wanted[r["k"]] - r["probability"].toArray()).max() < 1e-9


def test_target_may_be_called_label(spark, separable):
    renamed = separable.withColumnRenamed("class", "label")
    task = ClassificationTask("label", "p", keys=("k",))
    scored = score(renamed, train_classifier(renamed, task, SETTINGS), task)
    assert summary(confusion_matrix(scored)).first()["accuracy"] == 1.0


def test_null_target_is_scored_but_not_trained_on(spark, separable):
    unlabelled = separable.withColumn("class", F.when(F.col("k") >= 100, F.col("class")))
    training = prepare_training(unlabelled, TASK)
    weights = training.rows.agg(F.sum("weight")).first()[0]
    training.release()
    assert weights == 300
    scored = score(unlabelled, train_classifier(unlabelled, TASK, SETTINGS), TASK)
    assert scored.count() == 400 and scored.filter("label is null").count() == 100
    metrics = summary(confusion_matrix(scored)).first()
    assert metrics["total"] == 400 and metrics["correct"] == 300


def test_whole_job(spark, separable):
    base = fresh_path(spark, "job")
    target = DocumentTarget(f"{base}/store", f"{base}/fallback", f"{base}/dead")
    first = run_classification(separable, TASK, SETTINGS, target, run="first")
    assert first.load.status == "loaded" and first.load.written == 400
    stored = spark.read.parquet(f"{base}/store")
    assert stored.select("id").distinct().count() == 400
    assert {r[0] for r in stored.select("predicted_class").distinct().collect()} == {"positive", "negative"}

    second = run_classification(separable, TASK, SETTINGS, target, run="second", holdout=0.3)
    assert second.load.status == "diverted" and second.load.written == 400
    assert spark.read.parquet(f"{base}/store").count() == 400
    assert 60 < second.metrics.first()["total"] < 180
    assert second.metrics.first()["auc"] == 1.0
    assert [m for _, m, _ in second.timer.rows] == [
        "prepare", "train", "predict", "accuracy", "auc", "evaluate", "sink", "total",
    ]
