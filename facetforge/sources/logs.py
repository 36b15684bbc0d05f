"""Run logs as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetforge.functions.loglines import (
    PHASES,
    accuracy_value,
    auc_value,
    elapsed_ms,
    is_metric_line,
    phase_name,
)


def read_run_log(
    spark: SparkSession, paths: str | Sequence[str], run_pattern: str = r"([^/]+?)(?:\.[^./]*)?$"
) -> DataFrame:
    """Log lines with the run they belong to, taken from the file path by the
    first group of ``run_pattern`` (default: the file name without suffix)."""
    run = F.regexp_extract(F.col("_metadata.file_path"), run_pattern, 1)
    return spark.read.text(paths).select(run.alias("run"), F.col("value"))


def run_metrics(lines: DataFrame, phases: dict[str, str] = PHASES) -> DataFrame:
    """(run, metric, value) for each line that reports a time, an accuracy or an
    AUC.

    Times keep their phase name and are in milliseconds; a phase without a short
    name keeps its phrase.
    """
    line = F.col("value")
    phase = F.when(elapsed_ms(line).isNotNull(), phase_name(line, phases))
    accuracy, auc = accuracy_value(line), auc_value(line)
    return (
        lines.filter(is_metric_line(line))
        .select(
            "run",
            F.coalesce(
                phase,
                F.when(accuracy.isNotNull(), F.lit("accuracy")),
                F.when(auc.isNotNull(), F.lit("auc")),
            ).alias("metric"),
            F.coalesce(elapsed_ms(line).cast("double"), accuracy, auc).alias("value"),
        )
        .filter(F.col("metric").isNotNull())
    )
