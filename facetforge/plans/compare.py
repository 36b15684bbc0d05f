"""Compare two labelled runs from their logs or metric tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from facetforge.operators.runs import compare_accuracy, compare_times, write_report
from facetforge.sources.logs import read_run_log, run_metrics


def compare_logs(
    spark: SparkSession,
    paths: Sequence[str],
    first: str,
    second: str,
    report_path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(times, accuracies) of two runs whose logs are named after them."""
    return compare_metrics(run_metrics(read_run_log(spark, list(paths))), first, second, report_path)


def compare_metrics(
    metrics: DataFrame, first: str, second: str, report_path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    times = compare_times(metrics, first, second)
    qualities = compare_accuracy(metrics, first, second)
    if report_path is not None:
        write_report(times, report_path, first, second, qualities)
    return times, qualities
