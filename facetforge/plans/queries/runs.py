"""Run logs and run comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetforge.functions.loglines import log_line
from facetforge.operators.metrics import confusion_matrix, summary
from facetforge.operators.runs import compare_accuracy, compare_times, report_lines
from facetforge.plans.queries.common import table
from facetforge.sources.logs import read_run_log, run_metrics
from facetforge.storage import fresh_path


# What run_classification records.
JOB_METRICS = ("prepare", "train", "predict", "evaluate", "sink", "total", "accuracy", "auc")


def log_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as log lines, one log per event type, and mined again."""
    value = F.col("value")
    ms = F.round(value * 1000).cast("bigint").cast("string")
    took = lambda phase, word="": F.concat(
        F.lit(f"INFO {phase} completed {word}in "), ms, F.lit(" ms")
    )
    line = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("ERROR not completed: "), ms))
        .when(F.col("event_type") == "signup", F.concat(F.lit("INFO Model Accuracy: "), value))
        .when(value < 5, took("Data loading and preparation"))
        .when(value < 10, took("Model training"))
        .when(value < 20, took("Prediction"))
        .otherwise(took("Processing", "successfully "))
    )
    path = fresh_path(spark, "logs")
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("run"), line.alias("value"))
    events.write.partitionBy("run").text(path)
    metrics = run_metrics(read_run_log(spark, path, r"/run=([^/]+)/"))
    return metrics.groupBy("run", "metric").agg(
        F.count("*").alias("lines"), F.round(F.sum("value"), 3).alias("total")
    )


def own_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metrics that a job records, logged as the job logs them and mined."""
    measured = table(spark, sf_dir, "events").agg(
        *[
            F.sum(F.when(F.col("event_id") % len(JOB_METRICS) == i, 1).otherwise(0)).alias(m)
            for i, m in enumerate(JOB_METRICS)
        ]
    )
    lines = [F.lit(log_line(m, 7)) for m in JOB_METRICS]
    written = [F.regexp_replace(x, r"\b7(\.0)?\b", F.col(m).cast("string")) for m, x in zip(JOB_METRICS, lines)]
    path = fresh_path(spark, "own-log")
    head = F.lit("2024-01-01 00:00:00 INFO facetforge.operators.runs: ")
    measured.select(F.explode(F.array(*[F.concat(head, x) for x in written])).alias("value")).write.text(path)
    return run_metrics(read_run_log(spark, path)).select("metric", "value")


def daily_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric table with event types as runs and days as phases."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("run"), F.to_date("ts").cast("string").alias("metric"))
        .agg(F.sum(F.round(F.col("value") * 1000).cast("bigint")).cast("double").alias("value"))
    )


def run_speedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_times(daily_times(spark, sf_dir), "click", "view")


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = compare_times(daily_times(spark, sf_dir), "click", "view")
    measured = rule_accuracies(spark, sf_dir, "click", "view")
    qualities = compare_accuracy(measured, "click", "view")
    return report_lines(times, "click", "view", qualities).select("block", "value")


def rule_accuracies(spark: SparkSession, sf_dir: str, *runs: str) -> DataFrame:
    """Two rules over the same order lines as two runs."""
    lines = table(spark, sf_dir, "lineitem")
    rules = zip(runs, (F.col("l_discount") > 0.05, F.col("l_tax") > 0.06), strict=True)
    measured = []
    for run, rule in rules:
        scored = lines.select(
            (F.col("l_returnflag") == "R").cast("double").alias("label"),
            rule.cast("double").alias("prediction"),
        )
        measured.append(
            summary(confusion_matrix(scored)).select(
                F.lit(run).alias("run"), F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value")
            )
        )
    return reduce(DataFrame.unionByName, measured)


def accuracy_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = ("by_discount", "by_tax")
    compared = compare_accuracy(rule_accuracies(spark, sf_dir, *runs), *runs)
    return compared.withColumn("difference", F.round("difference", 9))


QUERIES = {
    "log_metrics": log_metrics,
    "own_log_roundtrip": own_log_roundtrip,
    "run_speedup": run_speedup,
    "run_report": run_report,
    "accuracy_parity": accuracy_parity,
}

_SPEEDUP = """
    WITH daily AS (
        SELECT event_type AS run, strftime(ts, '%Y-%m-%d') AS phase,
               CAST(sum(CAST(round(value * 1000) AS BIGINT)) AS BIGINT) AS ms
        FROM events GROUP BY 1, 2),
    times AS (
        SELECT phase, max(ms) FILTER (run = 'click') AS first_ms,
               max(ms) FILTER (run = 'view') AS second_ms
        FROM daily WHERE run IN ('click', 'view') GROUP BY phase),
    compared AS (
        SELECT *, CAST((first_ms * 100) // nullif(second_ms, 0) AS DOUBLE) / 100 AS speedup
        FROM times)
"""

SQL = {
    "log_metrics": """
        WITH mined AS (
            SELECT event_type AS run,
                   CASE WHEN event_type = 'signup' THEN 'accuracy' WHEN value < 5 THEN 'prepare'
                        WHEN value < 10 THEN 'train' WHEN value < 20 THEN 'predict'
                        ELSE 'total' END AS metric,
                   CASE WHEN event_type = 'signup' THEN value
                        ELSE round(value * 1000) END AS value
            FROM events WHERE event_type <> 'error')
        SELECT run, metric, count(*) AS lines, round(sum(value), 3) AS total
        FROM mined GROUP BY run, metric
    """,
    "run_speedup": _SPEEDUP + "SELECT phase, first_ms, second_ms, speedup FROM compared",
    "run_report": _SPEEDUP
    + """
        SELECT 0 AS block, '| Phase | click (ms) | view (ms) | Speedup |' AS value
        UNION ALL SELECT 1, '| --- | --- | --- | --- |'
        UNION ALL SELECT 2, concat('| ', concat_ws(' | ', phase,
            coalesce(CAST(first_ms AS VARCHAR), 'N/A'), coalesce(CAST(second_ms AS VARCHAR), 'N/A'),
            coalesce(CAST(speedup AS VARCHAR), 'N/A')), ' |') FROM compared
        UNION ALL SELECT 3, '| Metric | click | view | Difference |'
        UNION ALL SELECT 4, '| --- | --- | --- | --- |'
        UNION ALL SELECT 5, printf('| accuracy | %.4f | %.4f | %.4f |', a, b, abs(a - b)) FROM (
            SELECT avg(CAST((l_returnflag = 'R') = (l_discount > 0.05) AS DOUBLE)) AS a,
                   avg(CAST((l_returnflag = 'R') = (l_tax > 0.06) AS DOUBLE)) AS b FROM lineitem)
    """,
    "own_log_roundtrip": """
        SELECT metric, CAST(count(event_id) AS DOUBLE) AS value
        FROM (VALUES (0, 'prepare'), (1, 'train'), (2, 'predict'), (3, 'evaluate'), (4, 'sink'),
                     (5, 'total'), (6, 'accuracy'), (7, 'auc')) AS m(place, metric)
        LEFT JOIN events ON event_id % 8 = place GROUP BY metric
    """,
    "accuracy_parity": """
        WITH measured AS (
            SELECT avg(CAST((l_returnflag = 'R') = (l_discount > 0.05) AS DOUBLE)) AS a,
                   avg(CAST((l_returnflag = 'R') = (l_tax > 0.06) AS DOUBLE)) AS b FROM lineitem)
        SELECT 'accuracy' AS metric, a AS first_value, b AS second_value,
               round(abs(a - b), 9) AS difference FROM measured
    """,
}
