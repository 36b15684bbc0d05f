"""Scalar expressions. All of them are built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """Reference a top-level column whose name may hold dashes, spaces or dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def binary_label(target: Column, positive: str, null_label: str = "keep") -> Column:
    """1.0 where the target equals ``positive``, else 0.0; NULL stays NULL
    unless ``null_label`` is "negative"."""
    label = (target.cast("string") == F.lit(positive)).cast("double")
    return F.coalesce(label, F.lit(0.0)) if null_label == "negative" else label


def class_name(prediction: Column, negative_name: str, positive_name: str) -> Column:
    """Name of the predicted class, cut at 0.5; NULL for a NULL prediction."""
    return (
        F.when(prediction < 0.5, F.lit(negative_name))
        .when(prediction.isNotNull(), F.lit(positive_name))
    )


def _key_part(value: Column) -> Column:
    text = F.replace(value.cast("string"), F.lit("\\"), F.lit("\\\\"))
    return F.coalesce(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\\N"))


def document_id(dataset_type: str, *keys: Column) -> Column:
    """Reproducible id: the same row gets the same id in every run and retry.

    Key parts are escaped and NULL is spelled out, so different keys never give
    the same text.
    """
    return F.md5(F.concat_ws("|", F.lit(dataset_type), *[_key_part(k) for k in keys]))


def key_fraction(seed: int, *keys: Column) -> Column:
    """A reproducible draw in [0, 1) per row, from a hash of its keys. Any engine
    with MD5 gets the same: the first 13 hexadecimal digits as a fraction."""
    digits = F.substring(document_id(str(seed), *keys), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(1 << 52))


def epoch_ms_now() -> Column:
    return F.unix_millis(F.current_timestamp())


def failed_document_json(*fields: str) -> Column:
    return F.to_json(F.struct(*[column(f) for f in fields]), {"ignoreNullFields": "false"})


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with one decimal; NULL when ``whole`` is zero."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), 1)


def truncated_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio of two whole numbers cut (not rounded) after two decimals.

    NULL when a side is missing or the denominator is zero. The division is
    made exact by taking the remainder off first.
    """
    hundredfold = numerator.cast("bigint") * F.lit(100)
    divisor = F.nullif(denominator.cast("bigint"), F.lit(0))
    return F.try_divide(hundredfold - F.try_mod(hundredfold, divisor), divisor) / F.lit(100.0)


def cosine_similarity(left: Column, right: Column) -> Column:
    """Cosine of two arrays of equal length; NULL when one has length zero."""
    def dot(a: Column, b: Column) -> Column:
        products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)

    return F.try_divide(dot(left, right), F.sqrt(dot(left, left)) * F.sqrt(dot(right, right)))
