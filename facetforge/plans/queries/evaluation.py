"""Training, scoring and metrics."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetforge.config import BoostSettings, ClassificationTask
from facetforge.operators.boosting import load_model, save_model, score, train_classifier
from facetforge.operators.encoding import with_label
from facetforge.operators.metrics import (
    accuracy,
    area_under_roc,
    confusion_matrix,
    confusion_wide,
    cross_validate,
    holdout_split,
    positive_probability,
    summary,
)
from facetforge.plans.classify import training_confusion
from facetforge.plans.queries.common import FLAG_TASK, line_attributes, rule_scores, table
from facetforge.storage import fresh_path

# Fewer and smaller trees than the production setting keep the check short.
SHORT = BoostSettings(rounds=5, max_depth=4)
TINY = BoostSettings(rounds=2, max_depth=3)

RULE_TASK = ClassificationTask(
    target="rule",
    positive="yes",
    keys=("l_orderkey", "l_linenumber"),
    features=("l_linestatus", "p_brand", "p_type", "p_size"),
    dataset_type="rule-lines",
)


def equality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = rule_scores(spark, sf_dir)
    return scored.filter(F.col("label") == F.col("prediction")).agg(F.count("*").alias("correct"))


def confusion_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion_matrix(rule_scores(spark, sf_dir))


def confusion_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion_wide(confusion_matrix(rule_scores(spark, sf_dir)))


def rule_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accuracy(rule_scores(spark, sf_dir))


def rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(confusion_matrix(rule_scores(spark, sf_dir)))


def auc_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = documents.join(labels, "doc_id").select(
        F.col("quality").cast("double").alias("label"), F.col("n_chars").alias("score")
    )
    return area_under_roc(scored).withColumn("auc", F.round("auc", 6))


def rule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose target follows from their attributes."""
    rule = F.when(
        (F.col("p_type") == "ECONOMY") | (F.col("l_linestatus") == "F"), F.lit("yes")
    ).otherwise(F.lit("no"))
    return line_attributes(spark, sf_dir, rule.alias("rule"))


def gbt_rule_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trees must find the rule: every row is predicted as labelled."""
    settings = BoostSettings(rounds=3, max_depth=3)
    return training_confusion(rule_lines(spark, sf_dir), RULE_TASK, settings)


def gbt_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_confusion(line_attributes(spark, sf_dir), FLAG_TASK, SHORT)


def gbt_first_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One round of depth 1 on a label that follows no rule, saved and loaded
    before it scores: the best split and its two leaves can be worked out."""
    lines = line_attributes(spark, sf_dir)
    path = fresh_path(spark, "first-tree")
    save_model(train_classifier(lines, FLAG_TASK, BoostSettings(rounds=1, max_depth=1)), path)
    scored = score(lines, load_model(spark, path), FLAG_TASK, by_combination=True)
    positive = F.round(vector_to_array("probability")[1], 6).alias("probability")
    return scored.groupBy("label", "prediction", positive).agg(F.count("*").alias("lines"))


def gbt_training_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = rule_lines(spark, sf_dir)
    scored = score(lines, train_classifier(lines, RULE_TASK, TINY), RULE_TASK)
    return area_under_roc(positive_probability(scored))


def holdout_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = with_label(table(spark, sf_dir, "lineitem"), FLAG_TASK)
    sides = zip(("training", "holdout"), holdout_split(lines, FLAG_TASK.keys, 0.2))
    counts = [
        side.groupBy("label").agg(F.lit(name).alias("side"), F.count("*").alias("rows"))
        for name, side in sides
    ]
    return counts[0].unionByName(counts[1])


def holdout_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trained on the training side, judged on the other: the rule must hold."""
    training, judged = holdout_split(rule_lines(spark, sf_dir), RULE_TASK.keys, 0.2)
    model = train_classifier(training, RULE_TASK, TINY)
    return summary(confusion_matrix(score(judged, model, RULE_TASK, by_combination=True)))


def cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_validate(rule_lines(spark, sf_dir), RULE_TASK, TINY, depths=[2, 3], folds=2)[0]


QUERIES = {
    "equality_filter": equality_filter,
    "confusion_matrix": confusion_cells,
    "confusion_wide": confusion_pivot,
    "accuracy": rule_accuracy,
    "classification_metrics": rule_metrics,
    "auc_rule": auc_rule,
    "gbt_rule_recovery": gbt_rule_recovery,
    "gbt_train_score": gbt_train_score,
    "gbt_first_tree": gbt_first_tree,
    "gbt_training_auc": gbt_training_auc,
    "holdout_sides": holdout_sides,
    "holdout_metrics": holdout_metrics,
    "cross_validation": cross_validation,
}

_RULE = """
    WITH scored AS (SELECT CAST(l_returnflag = 'R' AS DOUBLE) AS label,
                           CAST(l_discount > 0.05 AS DOUBLE) AS prediction FROM lineitem)
"""

_LABELLED = """
    WITH labelled AS (
        SELECT CAST(p_type = 'ECONOMY' OR l_linestatus = 'F' AS DOUBLE) AS label,
               l_orderkey, l_linenumber
        FROM lineitem JOIN part ON l_partkey = p_partkey)
"""
_DRAW = (
    "CAST('0x' || substr(md5(concat_ws('|', '7', l_orderkey, l_linenumber)), 1, 13) AS BIGINT)"
    " / 4503599627370496.0"
)

SQL = {
    "equality_filter": _RULE + "SELECT count(*) AS correct FROM scored WHERE label = prediction",
    "confusion_matrix": _RULE
    + 'SELECT label, prediction, count(*) AS "count" FROM scored GROUP BY label, prediction',
    "confusion_wide": _RULE
    + """SELECT label, count(*) FILTER (prediction = 0) AS predicted_0,
                count(*) FILTER (prediction = 1) AS predicted_1
         FROM scored GROUP BY label""",
    "accuracy": _RULE
    + """SELECT count(*) AS total, count(*) FILTER (label = prediction) AS correct,
                avg(CAST(label = prediction AS DOUBLE)) AS accuracy FROM scored""",
    "classification_metrics": _RULE
    + """, n AS (SELECT count(*) AS total, count(*) FILTER (label = prediction) AS correct,
                 count(*) FILTER (label = 1 AND prediction = 1) AS tp,
                 count(*) FILTER (label = 0 AND prediction = 1) AS fp,
                 count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM scored)
         SELECT total, correct, correct / total AS accuracy, tp / (tp + fp) AS precision,
                tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1 FROM n""",
    "auc_rule": """
        WITH scored AS (SELECT quality AS label, n_chars AS score
                        FROM documents JOIN labels USING (doc_id)),
        ranked AS (SELECT label, rank() OVER (ORDER BY score)
                          + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS place FROM scored),
        n AS (SELECT count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q,
                     sum(place) FILTER (label = 1) AS places FROM ranked)
        SELECT p AS positives, q AS negatives,
               round((places - p * (p + 1) / 2.0) / (p * q), 6) AS auc FROM n
    """,
    "gbt_rule_recovery": _LABELLED
    + """SELECT label, label AS prediction, count(*) AS "count" FROM labelled GROUP BY label""",
    "gbt_first_tree": """
        WITH labelled AS (
            SELECT l_returnflag = 'R' AS hit, 2.0::DOUBLE * CAST(l_returnflag = 'R' AS INT) - 1 AS y,
                   l_linestatus, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size
            FROM lineitem JOIN part ON l_partkey = p_partkey),
        n AS (SELECT count(*) AS n, sum(y) AS s FROM labelled),
        splits AS (
            SELECT attribute, category, count(*) AS n1, sum(y) AS s1
            FROM (UNPIVOT labelled ON l_linestatus, p_brand, p_type, p_size
                  INTO NAME attribute VALUE category) GROUP BY attribute, category),
        best AS (
            SELECT attribute, category, s1 / n1 AS inside, (s - s1) / (n - n1) AS outside
            FROM splits, n WHERE n1 < n
            ORDER BY s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) DESC, attribute, category LIMIT 1),
        leaves AS (
            SELECT CAST(hit AS DOUBLE) AS label,
                   CASE WHEN CASE attribute WHEN 'l_linestatus' THEN l_linestatus
                                            WHEN 'p_brand' THEN p_brand WHEN 'p_type' THEN p_type
                                            ELSE p_size END = category
                        THEN inside ELSE outside END AS leaf
            FROM labelled, best)
        SELECT label, CAST(leaf > 0 AS DOUBLE) AS prediction,
               round(1 / (1 + exp(-2 * leaf)), 6) AS probability, count(*) AS lines
        FROM leaves GROUP BY 1, 2, 3
    """,
    "gbt_training_auc": _LABELLED
    + """SELECT count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives,
                1.0::DOUBLE AS auc FROM labelled""",
    "holdout_sides": f"""
        SELECT CAST(l_returnflag = 'R' AS DOUBLE) AS label,
               CASE WHEN {_DRAW} < 0.2 THEN 'holdout' ELSE 'training' END AS side, count(*) AS rows
        FROM lineitem GROUP BY 1, 2
    """,
    "holdout_metrics": _LABELLED
    + f"""SELECT count(*) AS total, count(*) AS correct, 1.0::DOUBLE AS accuracy,
                 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1
          FROM labelled WHERE {_DRAW} < 0.2""",
    "cross_validation": """
        SELECT CAST(depth AS INTEGER) AS max_depth, 1.0::DOUBLE AS mean_auc
        FROM (VALUES (2), (3)) AS t(depth) WHERE EXISTS (SELECT 1 FROM lineitem)
    """,
}
