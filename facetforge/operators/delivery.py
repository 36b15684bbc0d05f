"""Loading documents into a store: guard, resume, dead letters, fallback.

Two kinds of target:

* a document table (``load_documents``), written by Spark's own file writers;
* an external store (``deliver`` or the ``document_store`` data source), where
  each task sends its partition in small batches through a client object.

No path brings rows to the driver, and ids are reproducible, so running a load
again adds nothing.
"""

from __future__ import annotations

import logging
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetforge.config import DeliveryPolicy
from facetforge.functions.columns import percent
from facetforge.operators.documents import feature_array
from facetforge.operators.ordering import running_totals
from facetforge.sources.tables import DOCUMENT_SCHEMA, read_documents
from facetforge.storage import delete_folder, materialise, move_files, partition_folder

log = logging.getLogger(__name__)

# Fixed value: a tag with more documents than this counts as loaded.
PRESENT_THRESHOLD = 10


# ---------------------------------------------------------------- guard, resume


def open_store(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """The document table at ``path``; empty when there is none yet. Other
    errors are raised: an unreadable store must not look like an empty one."""
    try:
        return read_documents(spark, path, format)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DOCUMENT_SCHEMA)


def create_store(spark: SparkSession, path: str, format: str = "parquet") -> None:
    """Make sure the document table exists by adding no rows to it."""
    nothing = spark.createDataFrame([], DOCUMENT_SCHEMA)
    nothing.write.mode("append").partitionBy("dataset_type").format(format).save(path)


def tag_counts(documents: DataFrame) -> DataFrame:
    return documents.groupBy("dataset_type").agg(F.count("*").alias("documents"))


def tag_counts_or_zero(documents: DataFrame, tags: Sequence[str]) -> DataFrame:
    """The number of documents of each given tag, 0 for a tag that is absent."""
    tag = F.col("dataset_type")
    counts = documents.filter(tag.isin(*tags)).agg(
        *[F.count_if(tag == t).alias(f"tag_{i}") for i, t in enumerate(tags)]
    )
    lines = [
        F.struct(F.lit(t).alias("dataset_type"), F.col(f"tag_{i}").alias("documents"))
        for i, t in enumerate(tags)
    ]
    return counts.select(F.inline(F.array(*lines)))


def loaded_tags(documents: DataFrame, threshold: int = PRESENT_THRESHOLD) -> DataFrame:
    """(dataset_type, documents, loaded) for every tag in the store."""
    return tag_counts(documents).withColumn("loaded", F.col("documents") > threshold)


def is_loaded(documents: DataFrame, dataset_type: str, threshold: int = PRESENT_THRESHOLD) -> bool:
    """Whether the tag has more than ``threshold`` documents.

    Takes only as many rows as the answer needs, however large the store is.
    """
    tagged = documents.filter(F.col("dataset_type") == dataset_type).select("dataset_type")
    return len(tagged.take(threshold + 1)) > threshold


def not_yet_stored(documents: DataFrame, stored: DataFrame) -> DataFrame:
    """Documents whose id the store does not hold under the same tag.

    Ids are hashes, so the join keys are spread evenly. Of the store only the
    ids are read.
    """
    present = stored.select("dataset_type", "id")
    return documents.join(present, ["dataset_type", "id"], "left_anti").select(*documents.columns)


# ------------------------------------------------------- dead letters, fallback


def problem_of(documents: DataFrame) -> Column:
    """Why a document cannot be stored; NULL when it can."""
    prediction = F.col("prediction")
    return F.coalesce(
        F.when(F.col("id").isNull(), F.lit("missing id")),
        F.when(F.col("features").isNull(), F.lit("missing features")),
        F.when(prediction.isNull() | F.isnan(prediction), F.lit("missing prediction")),
    )


def split_documents(
    documents: DataFrame, problem: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good, bad). Bad documents keep all fields and gain ``error``; every
    document is on exactly one side."""
    error = problem_of(documents) if problem is None else problem
    marked = documents.withColumn("error", error)
    return marked.filter(F.col("error").isNull()).drop("error"), marked.filter(F.col("error").isNotNull())


def write_dead_letters(bad: DataFrame, path: str, run_id: str) -> None:
    """Add failed documents as JSON lines under their run; nothing is replaced."""
    folder = partition_folder(path, "run_id", run_id)
    bad.write.mode("append").option("ignoreNullFields", False).json(folder)


def write_fallback(scored: DataFrame, path: str, run_id: str) -> str:
    """Add the rows as JSON under their run, vectors as plain arrays so that the
    files can be loaded again. Nothing is replaced: a fallback may hold the only
    copy of its documents. Returns the folder of the run."""
    plain = scored
    if "features" in scored.columns:
        plain = scored.withColumn("features", feature_array(scored))
    folder = partition_folder(path, "run_id", run_id)
    plain.write.mode("append").option("ignoreNullFields", False).json(folder)
    return folder


@dataclass(frozen=True)
class LoadResult:
    status: str  # "loaded" or "diverted"
    written: int
    dead_lettered: int
    path: str
    duplicates: int = 0  # of the dead letters, those whose id the load has already


def load_documents(
    documents: DataFrame,
    store_path: str | None,
    fallback_path: str,
    dead_letter_path: str,
    dataset_type: str,
    run_id: str,
    when_present: str = "divert",
    threshold: int = PRESENT_THRESHOLD,
    problem: Column | None = None,
    format: str = "parquet",
) -> LoadResult:
    """Load documents of one tag into a document table.

    Documents with a problem (by default: missing fields), those of another tag,
    and all but one of the documents with the same id become dead letters.
    Without a store, or when the tag is loaded already and ``when_present`` is
    "divert", the documents go to ``fallback_path``. With "resume" only those
    that are missing are added. On any error, also when the store cannot be
    opened, the fallback is written and the error raised again.

    Fallback and dead letters are added under the run; neither replaces anything,
    so ``documents`` may come from ``replay`` of the same paths.

    Good documents are written once, to a folder of their own in the store, and
    moved to the others when their ids are known to differ. A load that ends in
    between leaves nothing that readers see, or adds its files again: with
    "resume" only those whose ids are missing.

    ``documents`` is read a second time if some of them are bad, so it should
    come from a stored table, not from a long computation.
    """
    if when_present not in ("divert", "resume"):
        raise ValueError("when_present must be divert or resume")
    if store_path is None:
        return _divert(documents, fallback_path, run_id)
    try:
        create_store(documents.sparkSession, store_path, format)
        stored = read_documents(documents.sparkSession, store_path, format)
        stored = stored.filter(F.col("dataset_type") == dataset_type)
        diverted = when_present == "divert" and is_loaded(stored, dataset_type, threshold)
        if not diverted:
            return _load(
                documents, stored, store_path, dead_letter_path, dataset_type, run_id, problem, format
            )
    except Exception:
        log.exception("load failed; writing the documents to %s", fallback_path)
        write_fallback(documents, fallback_path, run_id)
        raise
    return _divert(documents, fallback_path, run_id)


def _load(
    documents: DataFrame,
    stored: DataFrame,
    store_path: str,
    dead_letter_path: str,
    dataset_type: str,
    run_id: str,
    problem: Column | None,
    format: str,
) -> LoadResult:
    # A first load has nothing to compare with and needs no join.
    missing = documents if stored.isEmpty() else not_yet_stored(documents, stored)
    other_tag = ~F.col("dataset_type").eqNullSafe(dataset_type)
    error = F.coalesce(
        F.when(other_tag, F.lit("other dataset type")),
        problem_of(missing) if problem is None else problem,
    )
    is_bad = F.col("error").isNotNull()
    marked = missing.withColumn("error", error)
    # Both sides are counted in the pass that writes the good ones; without bad
    # documents there is no second pass.
    seen = Observation()
    counted = marked.observe(
        seen, F.count_if(~is_bad).alias("good"), F.count_if(is_bad).alias("bad")
    )
    # Good documents all have the one tag. They are computed once, into a folder
    # beside those of the tags that readers pass over; ids are looked at there.
    spark = documents.sparkSession
    folder = partition_folder(store_path, "dataset_type", dataset_type)
    staged = f"{store_path}/_staged-{uuid.uuid4().hex}"
    extra = None
    try:
        good = counted.filter(~is_bad).drop("error", "dataset_type")
        good.write.format(format).save(staged)
        written, rejected = seen.get.get("good", 0), seen.get.get("bad", 0)
        kept = spark.read.schema(good.schema).format(format).load(staged)
        first, extra = _first_of_each_id(kept)
        if extra is None:
            move_files(spark, staged, folder)
            duplicates = 0
        else:
            duplicates = extra.count()
            written -= duplicates
            first.write.mode("append").format(format).save(folder)
            told = extra.withColumn("dataset_type", F.lit(dataset_type)).withColumn(
                "error", F.lit("duplicate id")
            )
            write_dead_letters(told.select(*marked.columns), dead_letter_path, run_id)
        if rejected:
            write_dead_letters(marked.filter(is_bad), dead_letter_path, run_id)
    finally:
        delete_folder(spark, staged)
    return LoadResult("loaded", written, rejected + duplicates, store_path, duplicates)


def _first_of_each_id(documents: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """One document of each id, and the others; None if no id repeats.

    Of the stored documents only the ids are read, and counted with partial sums,
    so an id with very many copies is no hot group. Only if some id repeats, the
    documents are numbered, and the smallest number of an id is the one that
    stays.
    """
    counts = documents.groupBy("id").agg(F.count("*").alias("copies"))
    if counts.filter("copies > 1").isEmpty():
        return documents, None
    numbered = materialise(
        documents.withColumn("_number", F.monotonically_increasing_id()), "numbered-documents"
    )
    first = numbered.groupBy("id").agg(F.min("_number").alias("_number"))
    columns = [F.col(c) for c in documents.columns]
    return (
        numbered.join(first, ["id", "_number"], "left_semi").select(*columns),
        numbered.join(first, ["id", "_number"], "left_anti").select(*columns),
    )


def _divert(documents: DataFrame, fallback_path: str, run_id: str) -> LoadResult:
    seen = Observation()
    counted = documents.observe(seen, F.count(F.lit(1)).alias("rows"))
    folder = write_fallback(counted, fallback_path, run_id)
    return LoadResult("diverted", seen.get.get("rows", 0), 0, folder)


# ------------------------------------------------------------- external stores


class StoreClient(Protocol):
    """What an external store must offer. ``upsert`` replaces documents with the
    same id and returns one entry per document: None, or why it was refused."""

    def upsert(self, documents: list[dict[str, Any]]) -> list[str | None]: ...

    def close(self) -> None: ...


@dataclass(frozen=True)
class BatchOutcome:
    batch_no: int
    attempts: int
    succeeded: int
    failures: list[tuple[dict[str, Any], str]]


def chunks(items: Iterable[Any], size: int) -> Iterator[list[Any]]:
    """Lists of ``size`` items; only the last may be shorter."""
    batch: list[Any] = []
    for item in items:
        batch.append(item)
        if len(batch) == size:
            yield batch
            batch = []
    if batch:
        yield batch


def _try_upsert(client: StoreClient, documents: list[dict[str, Any]]) -> list[str | None]:
    try:
        answers = client.upsert(documents)
    except Exception as error:  # the whole batch is tried again
        return [f"{type(error).__name__}: {error}"] * len(documents)
    if len(answers) != len(documents):
        raise RuntimeError("upsert must answer once per document")
    return answers


def send_batches(
    documents: Iterable[dict[str, Any]],
    client: StoreClient,
    policy: DeliveryPolicy,
    sleep: Callable[[float], None] = time.sleep,
) -> Iterator[BatchOutcome]:
    """Send one partition. Only refused documents are tried again; what is still
    refused after the last attempt is reported, not dropped."""
    for batch_no, batch in enumerate(chunks(documents, policy.batch_size), start=1):
        waiting, attempts, reasons = batch, 0, []
        while waiting and attempts < policy.max_attempts:
            if attempts:
                sleep(policy.backoff_ms * 2**attempts / 1000)
            attempts += 1
            answers = list(zip(waiting, _try_upsert(client, waiting)))
            reasons = [(d, why) for d, why in answers if why is not None]
            waiting = [d for d, _ in reasons]
        yield BatchOutcome(batch_no, attempts, len(batch) - len(reasons), reasons)
        if policy.pause_ms:
            sleep(policy.pause_ms / 1000)


@contextmanager
def _told(
    progress: Callable[[int, int], None] | None, seconds: float, state: Callable[[], tuple[int, int]]
) -> Iterator[None]:
    """Tell ``progress`` of every change of the state, from a thread of its own."""
    if progress is None:
        yield
        return
    ended, last = threading.Event(), [(0, 0)]

    def tell() -> None:
        now = state()
        if now != last[0]:
            last[0] = now
            progress(*now)

    def watch() -> None:
        while not ended.wait(seconds):
            tell()

    thread = threading.Thread(target=watch, daemon=True)
    thread.start()
    try:
        yield
    finally:
        ended.set()
        thread.join()
        tell()


def log_progress(total: int) -> Callable[[int, int], None]:
    """A ``progress`` that logs documents sent and their share of ``total``."""

    def tell(batches: int, documents: int) -> None:
        share = f" ({100 * documents / total:.1f} %)" if total else ""
        log.info("%d of %d documents stored in %d batches%s", documents, total, batches, share)

    return tell


def _outcome_schema(documents: DataFrame) -> T.StructType:
    failure = T.StructType([*documents.schema.fields, T.StructField("error", T.StringType())])
    return T.StructType(
        [
            T.StructField("task", T.IntegerType()),
            T.StructField("batch_no", T.IntegerType()),
            T.StructField("attempts", T.IntegerType()),
            T.StructField("succeeded", T.IntegerType()),
            T.StructField("failed", T.IntegerType()),
            T.StructField("failures", T.ArrayType(failure)),
        ]
    )


def deliver(
    documents: DataFrame,
    open_client: Callable[[], StoreClient],
    outcome_path: str,
    policy: DeliveryPolicy = DeliveryPolicy(),
    senders: int | None = None,
    progress: Callable[[int, int], None] | None = None,
    progress_seconds: float = 1.0,
) -> DataFrame:
    """Send documents to an external store; returns one row per batch.

    ``senders`` spreads the documents evenly over that many tasks (by id, so a
    repeated task sends the same ones). Without it each task sends the partition
    it has.

    The outcome table is written as the documents are sent, so Spark's output
    commit keeps exactly one outcome per batch even when tasks are repeated.
    Repeated tasks upsert the same ids again, which changes nothing.

    ``progress`` is called on the driver with the batches and documents sent so
    far whenever more tasks have ended, looked for every ``progress_seconds``. A
    repeated task counts again there; the exact totals are those of the outcomes.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    if senders is not None:
        documents = documents.repartition(senders, "id")
    schema = _outcome_schema(documents)
    arrow_schema = to_arrow_schema(schema)
    context = documents.sparkSession.sparkContext
    sent_batches, sent_documents = context.accumulator(0), context.accumulator(0)

    def send_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        rows = (row for batch in batches for row in batch.to_pylist())
        client = open_client()
        try:
            for done in send_batches(rows, client, policy):
                line = {
                    "task": task,
                    "batch_no": done.batch_no,
                    "attempts": done.attempts,
                    "succeeded": done.succeeded,
                    "failed": len(done.failures),
                    "failures": [{**d, "error": why} for d, why in done.failures],
                }
                sent_batches.add(1)
                sent_documents.add(done.succeeded)
                yield pa.RecordBatch.from_pylist([line], schema=arrow_schema)
        finally:
            client.close()

    # An outcome table may hold the only copy of refused documents: an existing
    # one is an error, never replaced.
    outcomes = documents.mapInArrow(send_partition, schema)
    with _told(progress, progress_seconds, lambda: (sent_batches.value, sent_documents.value)):
        outcomes.write.mode("errorifexists").parquet(outcome_path)
    return documents.sparkSession.read.schema(schema).parquet(outcome_path)


def delivery_totals(outcomes: DataFrame, *extra: Column) -> DataFrame:
    """One row: batches, documents stored, documents refused, and any further
    aggregates over the batches."""
    return outcomes.agg(
        F.count("*").alias("batches"),
        F.coalesce(F.sum("succeeded"), F.lit(0)).alias("succeeded"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"),
        *extra,
    )


def failed_documents(outcomes: DataFrame) -> DataFrame:
    """Refused documents with their error, ready for ``write_dead_letters``."""
    return outcomes.select(F.inline("failures"))


def delivery_progress(outcomes: DataFrame, total: Column, order_by: list[Column]) -> DataFrame:
    """Running number of stored documents after each batch and its share of
    ``total`` in percent."""
    done = running_totals(outcomes, order_by, {"done": F.col("succeeded").cast("bigint")})
    return done.withColumn("percent_done", percent(F.col("done"), total))


def replay(spark: SparkSession, paths: str | list[str], format: str = "json") -> DataFrame:
    """Documents from dead-letter or fallback files, to be loaded again."""
    return read_documents(spark, paths, format)
