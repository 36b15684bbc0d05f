"""Boosted trees over vocabularies of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetforge.config import BoostSettings, ClassificationTask
from facetforge.functions.columns import key_fraction
from facetforge.operators.encoding import category_counts, fit_vocabulary
from facetforge.operators.metrics import confusion_matrix, group_folds, holdout_split, summary
from facetforge.operators.vocabulary_state import merge_vocabulary, vocabulary_drift
from facetforge.operators.wide_boosting import (
    WideSettings,
    continue_rounds,
    fit_wide,
    load_wide,
    save_wide,
    score_wide,
    tree_table,
)
from facetforge.plans.queries.common import table
from facetforge.storage import fresh_path

# One category for each customer: as many as rows allow, and no limit to them.
ORDER_TASK = ClassificationTask(
    target="o_orderstatus",
    positive="F",
    keys=("o_orderkey",),
    features=("o_custkey", "o_orderpriority"),
    dataset_type="orders",
)
SHALLOW = WideSettings(BoostSettings(rounds=1, max_depth=2))


def trees_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits, gains and leaves of the first tree."""
    orders = table(spark, sf_dir, "orders")
    found = tree_table(spark, fit_wide(orders, ORDER_TASK, SHALLOW))
    return found.select(
        "node",
        "attribute",
        "category",
        F.round("gain", 6).alias("gain"),
        F.round("leaf", 6).alias("leaf"),
    )


def trees_wide_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that is saved and loaded scores every row; rows by leaf."""
    orders = table(spark, sf_dir, "orders")
    path = fresh_path(spark, "wide-model")
    save_wide(spark, fit_wide(orders, ORDER_TASK, SHALLOW), path)
    scored = score_wide(orders, load_wide(spark, path), ORDER_TASK)
    probability = F.round("probability", 6).alias("probability")
    return scored.groupBy("label", "prediction", probability).agg(F.count("*").alias("orders"))


def trees_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One round and one more on a saved model, against two at once: scores that
    differ."""
    orders = table(spark, sf_dir, "orders")
    path = fresh_path(spark, "wide-model")
    save_wide(spark, fit_wide(orders, ORDER_TASK, SHALLOW), path)
    more = fit_wide(orders, ORDER_TASK, SHALLOW, start=load_wide(spark, path))
    once = fit_wide(orders, ORDER_TASK, continue_rounds(SHALLOW, 2))
    left = score_wide(orders, more, ORDER_TASK).select("o_orderkey", "margin")
    right = score_wide(orders, once, ORDER_TASK).select("o_orderkey", F.col("margin").alias("other"))
    differ = F.count_if(F.abs(F.col("margin") - F.col("other")) > 1e-9).alias("differing")
    return left.join(right, "o_orderkey").agg(F.count("*").alias("orders"), differ)


def trees_early_stopping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds with the loss on held-out customers, until it rises. The label is
    noise to the attributes, so it soon does."""
    orders = table(spark, sf_dir, "orders")
    settings = WideSettings(
        BoostSettings(step_size=1.0, max_depth=2, rounds=6), min_child_weight=0.5, patience=1
    )
    held_out = key_fraction(7, F.col("o_custkey")) < 0.2
    model = fit_wide(orders, ORDER_TASK, settings, validation=held_out)
    rows = [
        (i + 1, float(loss), i < len(model.trees)) for i, loss in enumerate(model.losses)
    ]
    return spark.createDataFrame(rows, "round int, loss double, kept boolean")


def holdout_metrics_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One split, learned on the training side of orders whose label no attribute
    tells, judged on the other side."""
    training, judged = holdout_split(table(spark, sf_dir, "orders"), ORDER_TASK.keys, 0.3)
    model = fit_wide(training, ORDER_TASK, WideSettings(BoostSettings(rounds=1, max_depth=1)))
    return summary(confusion_matrix(score_wide(judged, model, ORDER_TASK)))


def grouped_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and customers by fold: a customer is in one fold only."""
    orders = group_folds(table(spark, sf_dir, "orders"), ["o_custkey"], 4)
    return orders.groupBy("fold").agg(
        F.count("*").alias("orders"), F.count_distinct("o_custkey").alias("customers")
    )


GROWING = ("o_custkey", "o_orderstatus", "o_orderpriority")


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders that came first, and those that came later: by year."""
    orders = table(spark, sf_dir, "orders")
    late = F.year("o_orderdate") >= 2000
    return orders.filter(~late), orders.filter(late)


def vocabulary_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vocabulary of earlier orders, merged with the counts of later ones."""
    early, late = _parts(spark, sf_dir)
    stored = fit_vocabulary(early, GROWING)
    return merge_vocabulary(stored.table, late, GROWING).table


def vocabulary_drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    early, late = _parts(spark, sf_dir)
    report = vocabulary_drift(category_counts(early, GROWING), category_counts(late, GROWING))
    return report.withColumns({c: F.round(c, 6) for c in ("added_share", "distance")})


QUERIES = {
    "vocabulary_merge": vocabulary_merge,
    "vocabulary_drift": vocabulary_drift_report,
    "trees_wide": trees_wide,
    "trees_wide_scores": trees_wide_scores,
    "trees_incremental": trees_incremental,
    "trees_early_stopping": trees_early_stopping,
    "grouped_folds": grouped_folds,
    "holdout_metrics_noise": holdout_metrics_noise,
}

# Gradients of the first round are 0.5 - y, hessians 0.25.
_TREE = """
    WITH base AS (
        SELECT o_orderkey AS k, CAST(o_orderstatus = 'F' AS INT) AS y,
               0.5::DOUBLE - CAST(o_orderstatus = 'F' AS INT) AS g, 0.25::DOUBLE AS h,
               CAST(o_custkey AS VARCHAR) AS c0, o_orderpriority AS c1 FROM orders),
    wide AS (SELECT k, g, h, 0 AS a, c0 AS category FROM base
             UNION ALL SELECT k, g, h, 1, c1 FROM base),
    top AS (
        SELECT a, category, sum(g) AS yg, sum(h) AS yh, any_value(bg) AS bg, any_value(bh) AS bh
        FROM wide, (SELECT sum(g) AS bg, sum(h) AS bh FROM base) GROUP BY a, category),
    root AS (
        SELECT a, category, round((yg * yg / (yh + 1) + (bg - yg) * (bg - yg) / (bh - yh + 1)
               - bg * bg / (bh + 1)) / 2, 9) AS gain
        FROM top WHERE yh >= 1 AND bh - yh >= 1
        QUALIFY gain > 0 AND row_number() OVER (ORDER BY gain DESC, a, category) = 1),
    placed AS (
        SELECT b.*, CASE WHEN CASE r.a WHEN 0 THEN c0 ELSE c1 END = r.category THEN 1 ELSE 2 END AS node
        FROM base b, root r),
    sums AS (SELECT node, sum(g) AS bg, sum(h) AS bh FROM placed GROUP BY node),
    cells AS (
        SELECT node, a, category, sum(g) AS yg, sum(h) AS yh, any_value(bg) AS bg, any_value(bh) AS bh
        FROM (SELECT node, g, h, 0 AS a, c0 AS category FROM placed
              UNION ALL SELECT node, g, h, 1, c1 FROM placed) JOIN sums USING (node)
        GROUP BY node, a, category),
    lower AS (
        SELECT node, a, category, round((yg * yg / (yh + 1) + (bg - yg) * (bg - yg) / (bh - yh + 1)
               - bg * bg / (bh + 1)) / 2, 9) AS gain
        FROM cells WHERE yh >= 1 AND bh - yh >= 1
        QUALIFY gain > 0 AND row_number() OVER
            (PARTITION BY node ORDER BY gain DESC, a, category) = 1),
    ends AS (
        SELECT p.k, p.y, p.g, p.h, CASE WHEN l.node IS NULL THEN p.node
            WHEN CASE l.a WHEN 0 THEN c0 ELSE c1 END = l.category THEN 2 * p.node + 1
            ELSE 2 * p.node + 2 END AS node
        FROM placed p LEFT JOIN lower l ON l.node = p.node),
    leaves AS (SELECT node, -sum(g) / (sum(h) + 1) * 0.1::DOUBLE AS leaf FROM ends GROUP BY node),
    splits AS (SELECT 0 AS node, a, category, gain FROM root
               UNION ALL SELECT node, a, category, gain FROM lower)
"""

_GROWING = """
    WITH long AS (
        SELECT year(o_orderdate) >= 2000 AS late, 'o_custkey' AS attribute,
               CAST(o_custkey AS VARCHAR) AS category FROM orders
        UNION ALL SELECT year(o_orderdate) >= 2000, 'o_orderstatus', o_orderstatus FROM orders
        UNION ALL SELECT year(o_orderdate) >= 2000, 'o_orderpriority', o_orderpriority FROM orders),
    n AS (SELECT attribute, category, count(*) FILTER (NOT late) AS old, count(*) FILTER (late) AS new
          FROM long WHERE category IS NOT NULL GROUP BY attribute, category)
"""

SQL = {
    "vocabulary_merge": _GROWING
    + """
        SELECT attribute, category, old + new AS n, CASE WHEN old > 0
            THEN row_number() OVER (PARTITION BY attribute, old > 0 ORDER BY old DESC, category) - 1
            ELSE row_number() OVER (PARTITION BY attribute, old > 0 ORDER BY new DESC, category) - 1
                 + (SELECT count(*) FROM n m WHERE m.attribute = n.attribute AND m.old > 0)
            END AS idx FROM n
    """,
    "vocabulary_drift": _GROWING
    + """
        , t AS (SELECT attribute, sum(old) AS all_old, sum(new) AS all_new FROM n GROUP BY attribute)
        SELECT attribute, count(*) FILTER (old > 0) AS stored, count(*) FILTER (new > 0) AS seen,
               count(*) FILTER (old = 0) AS added, count(*) FILTER (new = 0) AS missing,
               round(coalesce(coalesce(sum(new) FILTER (old = 0), 0) / nullif(sum(new), 0), 0.0::DOUBLE), 6)
                   AS added_share,
               round(sum(abs(coalesce(old / nullif(all_old, 0), 0) - coalesce(new / nullif(all_new, 0), 0)))
                     / 2, 6) AS distance
        FROM n JOIN t USING (attribute) GROUP BY attribute
    """,
    "trees_wide": _TREE
    + """
        SELECT CAST(node AS INTEGER) AS node,
               CASE a WHEN 0 THEN 'o_custkey' ELSE 'o_orderpriority' END AS attribute, category,
               round(gain, 6) AS gain, CAST(NULL AS DOUBLE) AS leaf FROM splits
        UNION ALL SELECT CAST(node AS INTEGER), NULL, NULL, NULL, round(leaf, 6) FROM leaves
    """,
    "trees_wide_scores": _TREE
    + """
        SELECT CAST(y AS DOUBLE) AS label, CAST(leaf > 0 AS DOUBLE) AS prediction,
               round(1 / (1 + exp(-leaf)), 6) AS probability, count(*) AS orders
        FROM ends JOIN leaves USING (node) GROUP BY 1, 2, 3
    """,
    "trees_incremental": "SELECT count(*) AS orders, 0::BIGINT AS differing FROM orders",
    "holdout_metrics_noise": """
        WITH base AS (
            SELECT CAST('0x' || substr(md5(concat_ws('|', '7', o_orderkey)), 1, 13) AS BIGINT)
                   / 4503599627370496.0 < 0.3 AS judged,
                   CAST(o_orderstatus = 'F' AS INT) AS y, 0.5::DOUBLE - CAST(o_orderstatus = 'F' AS INT) AS g,
                   CAST(o_custkey AS VARCHAR) AS c0, o_orderpriority AS c1 FROM orders),
        wide AS (SELECT g, 0 AS a, c0 AS category FROM base WHERE NOT judged
                 UNION ALL SELECT g, 1, c1 FROM base WHERE NOT judged),
        cells AS (
            SELECT a, category, sum(g) AS yg, count(*) * 0.25::DOUBLE AS yh,
                   any_value(bg) AS bg, any_value(bh) AS bh
            FROM wide, (SELECT sum(g) AS bg, count(*) * 0.25::DOUBLE AS bh FROM base WHERE NOT judged)
            GROUP BY a, category),
        root AS (
            SELECT *, round((yg * yg / (yh + 1) + (bg - yg) * (bg - yg) / (bh - yh + 1)
                   - bg * bg / (bh + 1)) / 2, 9) AS gain
            FROM cells WHERE yh >= 1 AND bh - yh >= 1
            QUALIFY row_number() OVER (ORDER BY gain DESC, a, category) = 1),
        told AS (
            SELECT y, CASE WHEN CASE a WHEN 0 THEN c0 ELSE c1 END = category
                      THEN -yg / (yh + 1) ELSE -(bg - yg) / (bh - yh + 1) END > 0 AS p
            FROM base, root WHERE judged),
        n AS (SELECT count(*) AS total, count(*) FILTER ((y = 1) = p) AS correct,
                     count(*) FILTER (y = 1 AND p) AS tp, count(*) FILTER (y = 0 AND p) AS fp,
                     count(*) FILTER (y = 1 AND NOT p) AS fn FROM told)
        SELECT total, correct, correct / total AS accuracy, tp / nullif(tp + fp, 0) AS precision,
               tp / nullif(tp + fn, 0) AS recall, 2 * tp / nullif(2 * tp + fp + fn, 0) AS f1 FROM n
    """,
    "grouped_folds": """
        SELECT CAST(floor(CAST('0x' || substr(md5(concat_ws('|', '7', o_custkey)), 1, 13) AS BIGINT)
                          / 4503599627370496.0 * 4) AS INTEGER) AS fold,
               count(*) AS orders, count(DISTINCT o_custkey) AS customers
        FROM orders GROUP BY 1
    """,
}
