"""Reading metrics out of run-log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The phrases (in lower case) a run log uses for its phases.
PHASES = {
    "data loading and preparation": "prepare",
    "model training": "train",
    "prediction": "predict",
    "vector storage": "sink",
    "processing": "total",
}
ELAPSED_PATTERN = r"completed (?:successfully )?in (\d+) ms"
ACCURACY_PATTERN = r"Model Accuracy: (\S+)"
AUC_PATTERN = r"Model AUC: (\S+)"
# What stands between the head of the line (up to a colon, a bracket or the
# level) and "completed".
_PHRASE_PATTERN = (
    r"^(?:.*(?:[:\]>|]|\b(?:trace|debug|info|warn|warning|error|fatal))\s+)?"
    r"(\S.*?)\s+completed (?:successfully )?in \d+ ms"
)


def is_metric_line(line: Column) -> Column:
    return line.rlike(ELAPSED_PATTERN) | line.rlike(ACCURACY_PATTERN) | line.rlike(AUC_PATTERN)


def _number_in(line: Column, pattern: str) -> Column:
    return F.regexp_extract(line, pattern, 1)


def elapsed_ms(line: Column) -> Column:
    """Milliseconds reported by the line; NULL when it reports none."""
    return _number_in(line, ELAPSED_PATTERN).try_cast("bigint")


def accuracy_value(line: Column) -> Column:
    """Accuracy reported by the line; NULL for other lines and for text that is
    not a number."""
    return _number_in(line, ACCURACY_PATTERN).try_cast("double")


def auc_value(line: Column) -> Column:
    """Area under the ROC curve reported by the line, like ``accuracy_value``."""
    return _number_in(line, AUC_PATTERN).try_cast("double")


def phase_name(line: Column, phases: dict[str, str] = PHASES) -> Column:
    """Short name of the phase whose completion the line reports, else NULL.

    A phrase that is none of ``phases``, and does not end in one as a word, is
    its own name, in lower case: no phase is lost.
    """
    phrase = F.regexp_extract(F.lower(line), _PHRASE_PATTERN, 1)
    names = [
        F.when((phrase == known.lower()) | phrase.endswith(f" {known.lower()}"), F.lit(short))
        for known, short in phases.items()
    ]
    return F.coalesce(*names, F.when(phrase != "", phrase))


def log_line(metric: str, value: float, phases: dict[str, str] = PHASES) -> str:
    """A metric as the log line that the functions above read."""
    if metric == "accuracy":
        return f"Model Accuracy: {value}"
    if metric == "auc":
        return f"Model AUC: {value}"
    phrase = {short: phrase for phrase, short in phases.items()}.get(metric, metric)
    return f"{phrase.capitalize()} completed in {int(value)} ms"
