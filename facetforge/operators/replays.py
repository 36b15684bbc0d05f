"""Replaying dead letters and fallbacks, each file once.

A ledger lists the files that were replayed, with the run that did it. What is
not in it is loaded, and only then entered: a crash in between leads to a second
load of the same documents, which loading by id makes harmless.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetforge.sources.tables import DOCUMENT_SCHEMA
from facetforge.storage import materialise

LEDGER_SCHEMA = "file string, run_id string, documents bigint"


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """(file, run_id, documents); empty when there is none yet."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def pending_documents(
    spark: SparkSession, paths: str | list[str], ledger_path: str, format: str = "json"
) -> DataFrame:
    """Documents of the files that the ledger does not list, with their ``file``."""
    found = spark.read.schema(DOCUMENT_SCHEMA).format(format).load(paths)
    listed = found.select(*DOCUMENT_SCHEMA.names, F.col("_metadata.file_path").alias("file"))
    return listed.join(read_ledger(spark, ledger_path).select("file"), "file", "left_anti")


def replay_once(
    spark: SparkSession,
    paths: str | list[str],
    ledger_path: str,
    run_id: str,
    load: Callable[[DataFrame], Any],
    format: str = "json",
) -> DataFrame:
    """Give the documents that were not replayed yet to ``load``, and enter their
    files. Returns the new lines of the ledger, none if nothing was pending.

    The documents are written down first, so files that come meanwhile wait for
    the next replay. ``load`` should add by id, like ``load_documents`` with
    "resume" or ``deliver``.
    """
    pending = materialise(pending_documents(spark, paths, ledger_path, format), "pending")
    lines = pending.groupBy("file").agg(
        F.lit(run_id).alias("run_id"), F.count("*").alias("documents")
    )
    lines = materialise(lines.select("file", "run_id", "documents"), "ledger-lines")
    if lines.isEmpty():
        return lines
    load(pending.select(*DOCUMENT_SCHEMA.names))
    lines.coalesce(1).write.mode("append").parquet(ledger_path)
    return lines
