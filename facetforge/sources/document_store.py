"""``df.write.format("document_store")``: the batched sender as a data source.

    spark.dataSource.register(DocumentStoreSource)
    docs.write.format("document_store").mode("append") \\
        .option("client", "my_module:open_client").save()

Options: ``client`` (module:callable, called with the options dictionary in
each task), ``batch_size``, ``max_attempts``, ``backoff_ms``, ``pause_ms``. A
document that stays refused fails its task and, after Spark's retries, the
write; use ``deliver`` to collect refused documents instead.

With ``staged`` = true the client stages documents instead of upserting them (see
``operators.external.StagingClient``). Each attempt of a task stages under a token
of its own; when all tasks are done, the tokens of the attempts that Spark kept
are published at once, and a write that fails discards all of its run, so the
store shows all documents or none.
"""

from __future__ import annotations

import importlib
import logging
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from facetforge.config import DeliveryPolicy
from facetforge.operators.delivery import send_batches
from facetforge.operators.external import StagedUpserts, attempt_token
from facetforge.sources.tables import DOCUMENT_SCHEMA

log = logging.getLogger(__name__)


@dataclass
class SentDocuments(WriterCommitMessage):
    batches: int
    documents: int
    token: str | None = None


class DocumentStoreSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "document_store"

    def schema(self) -> StructType:
        return DOCUMENT_SCHEMA

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("document_store only adds or replaces by id; use mode('append')")
        return DocumentStoreWriter(dict(self.options))


class DocumentStoreWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options
        self.staged = options.get("staged", "false").lower() == "true"
        self.run_id = options.get("run_id") or uuid.uuid4().hex
        default = DeliveryPolicy()
        self.policy = DeliveryPolicy(
            batch_size=int(options.get("batch_size", default.batch_size)),
            max_attempts=int(options.get("max_attempts", default.max_attempts)),
            backoff_ms=int(options.get("backoff_ms", default.backoff_ms)),
            pause_ms=int(options.get("pause_ms", default.pause_ms)),
        )

    def _open(self):
        module, _, attribute = self.options["client"].partition(":")
        return getattr(importlib.import_module(module), attribute)(self.options)

    def write(self, iterator: Iterator[Row]) -> SentDocuments:
        client, sent = self._open(), SentDocuments(0, 0)
        if self.staged:
            sent.token = attempt_token(self.run_id)
            client = StagedUpserts(client, sent.token)
        try:
            rows = (row.asDict(recursive=True) for row in iterator)
            for outcome in send_batches(rows, client, self.policy):
                if outcome.failures:
                    document, why = outcome.failures[0]
                    raise RuntimeError(
                        f"{len(outcome.failures)} documents refused, first {document.get('id')}: {why}"
                    )
                sent.batches += 1
                sent.documents += outcome.succeeded
        finally:
            client.close()
        return sent

    def commit(self, messages: list[SentDocuments | None]) -> None:
        done = [m for m in messages if m is not None]
        if self.staged:
            client = self._open()
            try:
                client.publish([m.token for m in done])
                # What is left is of attempts that were repeated.
                client.discard(self.run_id + "/")
            finally:
                client.close()
        log.info(
            "stored %d documents in %d batches",
            sum(m.documents for m in done),
            sum(m.batches for m in done),
        )

    def abort(self, messages: list[SentDocuments | None]) -> None:
        if self.staged:
            client = self._open()
            try:
                client.discard(self.run_id + "/")
            finally:
                client.close()
