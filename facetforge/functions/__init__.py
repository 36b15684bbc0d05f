from facetforge.functions.columns import (
    binary_label,
    class_name,
    column,
    cosine_similarity,
    document_id,
    epoch_ms_now,
    failed_document_json,
    key_fraction,
    percent,
    truncated_ratio,
)
from facetforge.functions.loglines import (
    accuracy_value,
    elapsed_ms,
    is_metric_line,
    log_line,
    phase_name,
)

__all__ = [
    "accuracy_value",
    "binary_label",
    "class_name",
    "column",
    "cosine_similarity",
    "document_id",
    "elapsed_ms",
    "epoch_ms_now",
    "failed_document_json",
    "is_metric_line",
    "key_fraction",
    "log_line",
    "percent",
    "phase_name",
    "truncated_ratio",
]
