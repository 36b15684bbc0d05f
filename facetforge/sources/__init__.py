from facetforge.sources.logs import read_run_log, run_metrics
from facetforge.sources.tables import (
    DOCUMENT_SCHEMA,
    attach_header,
    read_documents,
    read_headed_csv,
    publish,
)

__all__ = [
    "DOCUMENT_SCHEMA",
    "attach_header",
    "publish",
    "read_documents",
    "read_headed_csv",
    "read_run_log",
    "run_metrics",
]
