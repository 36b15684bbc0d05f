import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from facetforge.config import BoostSettings, ClassificationTask
from facetforge.operators.metrics import (
    accuracy,
    area_under_roc,
    confusion_matrix,
    confusion_wide,
    cross_validate,
    holdout_split,
    summary,
)


@pytest.fixture(scope="module")
def scored(spark):
    draw = random.Random(6)
    rows = [(float(draw.random() < 0.4), round(draw.random(), 1), float(draw.random() < 0.5), draw.randrange(1, 4))
            for _ in range(500)]
    return spark.createDataFrame(rows, "label double, score double, prediction double, w int").cache()


def test_confusion_sums_to_the_rows(scored):
    cells = {(r["label"], r["prediction"]): r["count"] for r in confusion_matrix(scored).collect()}
    assert sum(cells.values()) == 500
    metrics = summary(confusion_matrix(scored)).first()
    assert metrics["correct"] == cells[0.0, 0.0] + cells[1.0, 1.0]
    assert metrics["precision"] == cells[1.0, 1.0] / (cells[1.0, 1.0] + cells[0.0, 1.0])
    assert metrics["recall"] == cells[1.0, 1.0] / (cells[1.0, 1.0] + cells[1.0, 0.0])
    wide = {r["label"]: (r["predicted_0"], r["predicted_1"]) for r in confusion_wide(confusion_matrix(scored)).collect()}
    assert wide[1.0] == (cells[1.0, 0.0], cells[1.0, 1.0])


def test_nothing_to_evaluate(scored):
    none = scored.filter("false")
    assert tuple(accuracy(none).first()) == (0, 0, None)
    assert area_under_roc(none).first()["auc"] is None
    assert area_under_roc(scored.filter("label = 1")).first()["auc"] is None


def test_null_counts_in_the_total_only(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, None), (0.0, None)], "label double, prediction double")
    assert tuple(accuracy(df).first()) == (3, 1, 1 / 3)


def test_auc_equals_library_and_weights_equal_copies(scored):
    library = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert area_under_roc(scored).first()["auc"] == pytest.approx(library.evaluate(scored), abs=1e-12)
    copies = scored.select("label", "score", F.explode(F.sequence(F.lit(1), F.col("w"))).alias("copy"))
    weighted = area_under_roc(scored, weight="w").first()
    assert weighted["auc"] == pytest.approx(area_under_roc(copies).first()["auc"], abs=1e-12)


def test_weighted_confusion(scored):
    copies = scored.select("*", F.explode(F.sequence(F.lit(1), F.col("w"))).alias("copy"))
    wanted = {tuple(r) for r in confusion_matrix(copies).collect()}
    assert {tuple(r) for r in confusion_matrix(scored, weight="w").collect()} == wanted


def test_holdout_is_a_stable_partition(spark):
    df = spark.range(4000)
    for parts in (1, 7):
        training, judged = holdout_split(df.repartition(parts), ["id"], 0.25)
        ids = {r["id"] for r in judged.collect()}
        if parts == 1:
            first = ids
        assert ids == first and training.count() + len(ids) == 4000
    assert 850 < len(first) < 1150
    with pytest.raises(ValueError, match="key"):
        holdout_split(df, [], 0.25)


def test_cross_validation_finds_the_depth_that_separates(spark):
    rows = [(i, "p" if (i % 2) ^ (i % 3 == 0) else "e", f"a{i % 2}", f"b{i % 3}") for i in range(300)]
    df = spark.createDataFrame(rows, "k int, class string, a string, b string")
    task = ClassificationTask("class", "p", keys=("k",))
    table, model = cross_validate(df, task, BoostSettings(rounds=3), depths=[1, 3])
    means = {r["max_depth"]: r["mean_auc"] for r in table.collect()}
    assert means[3] == pytest.approx(1.0) and means[1] < 1.0
    assert model.bestModel.getOrDefault("maxDepth") == 3
