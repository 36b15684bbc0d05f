"""Timing of job phases and comparison of labelled runs."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetforge.functions.columns import truncated_ratio
from facetforge.functions.loglines import log_line

log = logging.getLogger(__name__)

# Metrics that are qualities of the model, not times.
QUALITIES = ("accuracy", "auc")


class PhaseTimer:
    """Wall-clock times of the phases of one run.

    Spark is lazy: a phase is measured truly only if it materialises its result
    inside the block.
    """

    def __init__(self, run: str) -> None:
        self.run = run
        self.rows: list[tuple[str, str, float]] = []
        self._started = time.monotonic()

    @contextmanager
    def phase(self, name: str) -> Iterator[None]:
        started = time.monotonic()
        try:
            yield
        finally:
            self.record(name, int((time.monotonic() - started) * 1000))

    def record(self, metric: str, value: float) -> None:
        self.rows.append((self.run, metric, float(value)))
        log.info(log_line(metric, value))

    def finish(self) -> None:
        self.record("total", int((time.monotonic() - self._started) * 1000))

    def table(self, spark: SparkSession) -> DataFrame:
        """(run, metric, value), the same shape as metrics read from logs."""
        return spark.createDataFrame(self.rows, "run string, metric string, value double")

    def append_to(self, spark: SparkSession, path: str) -> None:
        self.table(spark).write.mode("append").partitionBy("run").parquet(path)


def _side_by_side(metrics: DataFrame, first: str, second: str) -> DataFrame:
    """One row per metric with the value of each run, NULL where a run lacks it.

    Several values of one metric in one run count with the largest. One partial
    aggregation replaces a full outer join of the runs.
    """
    def of(run: str) -> Column:
        return F.max(F.when(F.col("run") == run, F.col("value")))

    return (
        metrics.filter(F.col("run").isin(first, second))
        .groupBy("metric")
        .agg(of(first).alias("first_value"), of(second).alias("second_value"))
    )


def compare_times(metrics: DataFrame, first: str, second: str) -> DataFrame:
    """(phase, first_ms, second_ms, speedup): how many times faster the second
    run was, cut after two decimals; NULL if a time is missing or zero."""
    pairs = _side_by_side(metrics.filter(~F.col("metric").isin(*QUALITIES)), first, second)
    first_ms = F.col("first_value").cast("bigint")
    second_ms = F.col("second_value").cast("bigint")
    return pairs.select(
        F.col("metric").alias("phase"),
        first_ms.alias("first_ms"),
        second_ms.alias("second_ms"),
        truncated_ratio(first_ms, second_ms).alias("speedup"),
    )


def compare_accuracy(metrics: DataFrame, first: str, second: str) -> DataFrame:
    """(metric, first_value, second_value, difference) of accuracy and AUC."""
    pairs = _side_by_side(metrics.filter(F.col("metric").isin(*QUALITIES)), first, second)
    return pairs.withColumn("difference", F.abs(F.col("first_value") - F.col("second_value")))


def report_lines(
    comparison: DataFrame, first: str, second: str, qualities: DataFrame | None = None
) -> DataFrame:
    """The comparison as lines of a Markdown table: (block, phase, value).

    Ordered by block and phase, the two heading lines come first. With
    ``qualities`` (from ``compare_accuracy``) a second table of accuracy and AUC
    follows.
    """
    def cell(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("N/A"))

    def share(name: str) -> Column:
        return F.coalesce(F.format_string("%.4f", F.col(name)), F.lit("N/A"))

    def body(rows: DataFrame, block: int, key: str, *cells: Column) -> DataFrame:
        text = F.concat(F.lit("| "), F.concat_ws(" | ", cell(key), *cells), F.lit(" |"))
        return rows.select(F.lit(block).alias("block"), F.col(key).alias("phase"), text.alias("value"))

    headings = [
        (0, "", f"| Phase | {first} (ms) | {second} (ms) | Speedup |"),
        (1, "", "| --- | --- | --- | --- |"),
    ]
    times = body(comparison, 2, "phase", cell("first_ms"), cell("second_ms"), cell("speedup"))
    if qualities is not None:
        headings += [
            (3, "", f"| Metric | {first} | {second} | Difference |"),
            (4, "", "| --- | --- | --- | --- |"),
        ]
        shares = [share(n) for n in ("first_value", "second_value", "difference")]
        times = times.unionByName(body(qualities, 5, "metric", *shares))
    heading = comparison.sparkSession.createDataFrame(
        headings, "block int, phase string, value string"
    )
    return heading.unionByName(times)


def write_report(
    comparison: DataFrame,
    path: str,
    first: str,
    second: str,
    qualities: DataFrame | None = None,
) -> None:
    """Report tables as Parquet under ``path``/table (and ``path``/qualities) and
    Markdown under ``path``/text; sorted across the part files."""
    comparison.write.mode("overwrite").parquet(f"{path}/table")
    if qualities is not None:
        qualities.write.mode("overwrite").parquet(f"{path}/qualities")
    lines = report_lines(comparison, first, second, qualities).orderBy("block", "phase")
    lines.select("value").write.mode("overwrite").text(f"{path}/text")
