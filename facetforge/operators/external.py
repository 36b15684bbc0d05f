"""The whole load into an external store: guard, resume, fallback, staging.

What ``load_documents`` does for document tables, for stores that are reached
through a client. The client answers two more questions; with them, what is
there already is found in the tasks, batch by batch, and nothing is collected.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetforge.config import DeliveryPolicy
from facetforge.operators.delivery import (
    PRESENT_THRESHOLD,
    StoreClient,
    chunks,
    deliver,
    delivery_totals,
    failed_documents,
    problem_of,
    send_batches,
    split_documents,
    write_dead_letters,
    write_fallback,
)

log = logging.getLogger(__name__)

# Ids asked for in one look-up.
LOOK_UP = 500


class GuardedClient(StoreClient, Protocol):
    """A store that can tell what it holds."""

    def count(self, dataset_type: str, limit: int) -> int:
        """Documents of the tag, counted up to ``limit``."""
        ...

    def existing(self, dataset_type: str, ids: list[str]) -> Iterable[str]:
        """Those of the ids that the store holds under the tag."""
        ...


class StagingClient(Protocol):
    """A store with a place where documents wait unseen under a token."""

    def stage(self, token: str, documents: list[dict[str, Any]]) -> list[str | None]: ...

    def publish(self, tokens: list[str]) -> None:
        """Show what waits under the tokens; done twice, it changes nothing."""
        ...

    def discard(self, prefix: str) -> None:
        """Remove what waits under all tokens with the prefix."""
        ...

    def close(self) -> None: ...


@dataclass(frozen=True)
class DeliveryResult:
    status: str  # "delivered" or "diverted"
    sent: int
    failed: int  # refused by the store, or not fit to be sent
    present: int  # in the store before
    path: str  # outcomes, or the fallback of the run
    diverted: int = 0


def is_present(
    open_client: Callable[[], GuardedClient], dataset_type: str, threshold: int = PRESENT_THRESHOLD
) -> bool:
    """Whether the store holds more than ``threshold`` documents of the tag."""
    client = open_client()
    try:
        return client.count(dataset_type, threshold + 1) > threshold
    finally:
        client.close()


def missing_in_store(
    documents: DataFrame, open_client: Callable[[], GuardedClient], look_up: int = LOOK_UP
) -> DataFrame:
    """Documents whose id the store does not hold under their tag: an anti-join by
    look-ups in the tasks, ``look_up`` ids at a time. Documents without id or tag
    are not looked up and stay."""
    id_place, tag_place = documents.columns.index("id"), documents.columns.index("dataset_type")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = open_client()
        try:
            for batch in batches:
                ids, tags = batch.column(id_place).to_pylist(), batch.column(tag_place).to_pylist()
                wanted: dict[str, list[str]] = {}
                for id_, tag in zip(ids, tags):
                    if id_ is not None and tag is not None:
                        wanted.setdefault(tag, []).append(id_)
                held = {
                    (tag, id_)
                    for tag, own in wanted.items()
                    for some in chunks(own, look_up)
                    for id_ in client.existing(tag, some)
                }
                if held:
                    batch = batch.filter(
                        pa.array([pair not in held for pair in zip(tags, ids)], pa.bool_())
                    )
                if batch.num_rows:
                    yield batch
        finally:
            client.close()

    return documents.mapInArrow(run, documents.schema)


def deliver_documents(
    documents: DataFrame,
    open_client: Callable[[], GuardedClient],
    outcome_path: str,
    fallback_path: str,
    dead_letter_path: str,
    dataset_type: str,
    run_id: str,
    when_present: str = "divert",
    threshold: int = PRESENT_THRESHOLD,
    problem: Column | None = None,
    policy: DeliveryPolicy = DeliveryPolicy(),
    senders: int | None = None,
    progress: Callable[[int, int], None] | None = None,
) -> DeliveryResult:
    """Send the documents of one tag to an external store.

    When the store holds the tag already, "divert" writes the documents to the
    fallback, "resume" sends those whose ids it lacks. Documents with a problem
    or of another tag, and those that the store refuses, become dead letters
    under the run. On any error, also when no client can be opened, all documents
    go to the fallback and the error is raised again; some may have been sent,
    which sending by id makes harmless.
    """
    if when_present not in ("divert", "resume"):
        raise ValueError("when_present must be divert or resume")
    try:
        present = is_present(open_client, dataset_type, threshold)
        if not (present and when_present == "divert"):
            other_tag = ~F.col("dataset_type").eqNullSafe(dataset_type)
            error = F.coalesce(
                F.when(other_tag, F.lit("other dataset type")),
                problem_of(documents) if problem is None else problem,
            )
            good, bad = split_documents(documents, error)
            seen = good.count() if present or when_present == "resume" else None
            wanted = missing_in_store(good, open_client) if seen is not None else good
            outcomes = deliver(wanted, open_client, outcome_path, policy, senders, progress)
            totals = delivery_totals(outcomes).first()
            refused = failed_documents(outcomes)
            lost = bad.select(*documents.columns, "error").unionByName(
                refused.select(*documents.columns, "error")
            )
            unfit = bad.count()
            if unfit or totals["failed"]:
                write_dead_letters(lost, dead_letter_path, run_id)
            before = 0 if seen is None else seen - totals["succeeded"] - totals["failed"]
            return DeliveryResult(
                "delivered", totals["succeeded"], totals["failed"] + unfit, before, outcome_path
            )
    except Exception:
        log.exception("delivery failed; writing the documents to %s", fallback_path)
        write_fallback(documents, fallback_path, run_id)
        raise
    seen = Observation()
    counted = documents.observe(seen, F.count(F.lit(1)).alias("rows"))
    folder = write_fallback(counted, fallback_path, run_id)
    return DeliveryResult("diverted", 0, 0, 0, folder, seen.get.get("rows", 0))


class StagedUpserts:
    """A staging client as one that ``send_batches`` can use."""

    def __init__(self, client: StagingClient, token: str):
        self.client, self.token = client, token

    def upsert(self, documents: list[dict[str, Any]]) -> list[str | None]:
        return self.client.stage(self.token, documents)

    def close(self) -> None:
        self.client.close()


def attempt_token(run_id: str) -> str:
    """A token of its own for each attempt of a task."""
    context = TaskContext.get()
    place = f"{context.partitionId()}-{context.taskAttemptId()}" if context else "0-0"
    return f"{run_id}/{place}-{uuid.uuid4().hex[:8]}"


def deliver_staged(
    documents: DataFrame,
    open_client: Callable[[], StagingClient],
    outcome_path: str,
    run_id: str,
    policy: DeliveryPolicy = DeliveryPolicy(),
) -> DataFrame:
    """Send documents in two phases; returns one row per task: token, batches,
    attempts, succeeded, failed.

    Each attempt of a task stages its partition under a token of its own, and a
    document that stays refused fails it. The table of outcomes keeps the tokens
    of the attempts that Spark committed; these are published, all others are
    discarded. If the job fails, everything is discarded and the store shows
    nothing of the run. A task that is still running then may stage a batch more;
    it stays unseen until the run is discarded again.
    """
    spark = documents.sparkSession
    schema = T.StructType(
        [
            T.StructField("token", T.StringType()),
            *[T.StructField(n, T.LongType()) for n in ("batches", "attempts", "succeeded", "failed")],
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = attempt_token(run_id)
        rows = (row for batch in batches for row in batch.to_pylist())
        client = StagedUpserts(open_client(), token)
        total = [0, 0, 0, 0]
        try:
            for done in send_batches(rows, client, policy):
                if done.failures:
                    document, why = done.failures[0]
                    raise RuntimeError(
                        f"{len(done.failures)} documents refused, first {document.get('id')}: {why}"
                    )
                for i, n in enumerate((1, done.attempts, done.succeeded, len(done.failures))):
                    total[i] += n
        finally:
            client.close()
        if total[0]:
            yield pa.RecordBatch.from_pylist(
                [dict(zip(schema.names, (token, *total)))],
                schema=pa.schema([("token", pa.string()), *[(n, pa.int64()) for n in schema.names[1:]]]),
            )

    client = open_client()
    try:
        try:
            documents.mapInArrow(run, schema).write.mode("errorifexists").parquet(outcome_path)
            outcomes = spark.read.schema(schema).parquet(outcome_path)
            # One token for each task.
            client.publish([r["token"] for r in outcomes.select("token").collect()])
        finally:
            client.discard(run_id + "/")
    finally:
        client.close()
    return outcomes
