"""Parameters of a classification job. Everything the job needs to know about
a data set is here; nothing about a particular table is built in."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ClassificationTask:
    """Which table columns mean what.

    target         column that holds the class
    positive       value of the target that becomes label 1.0 (exact match:
                   case matters, blanks are not trimmed)
    keys           columns that identify a row; carried through to the documents
    features       attributes to encode; None means every column that is neither
                   the target nor a key
    null_label     what a NULL target becomes: "keep" (NULL label), "drop" (row
                   removed) or "negative" (label 0.0)
    """

    target: str
    positive: str
    keys: tuple[str, ...] = ()
    features: tuple[str, ...] | None = None
    dataset_type: str = "default"
    positive_name: str = "positive"
    negative_name: str = "negative"
    null_label: str = "keep"

    def __post_init__(self) -> None:
        if self.null_label not in ("keep", "drop", "negative"):
            raise ValueError(f"null_label must be keep, drop or negative, not {self.null_label!r}")


@dataclass(frozen=True)
class BoostSettings:
    """Boosted-tree parameters. The defaults are the production setting."""

    # Learning rate 0.1, depth 8, 100 rounds.
    step_size: float = 0.1
    max_depth: int = 8
    rounds: int = 100
    seed: int = 7
    subsampling_rate: float = 1.0
    max_memory_mb: int = 512
    checkpoint_interval: int = 10


@dataclass(frozen=True)
class DeliveryPolicy:
    """How documents are sent to an external store."""

    # 25 documents a batch, 3 attempts, 1000 ms doubled per retry,
    # 100 ms pause after a batch.
    batch_size: int = 25
    max_attempts: int = 3
    backoff_ms: int = 1000
    pause_ms: int = 100
