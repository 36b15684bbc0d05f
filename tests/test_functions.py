import pytest
from pyspark.sql import functions as F

from facetforge.functions import (
    accuracy_value,
    binary_label,
    class_name,
    cosine_similarity,
    document_id,
    elapsed_ms,
    failed_document_json,
    percent,
    phase_name,
    truncated_ratio,
)


def one(spark, expression, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(0).alias("_"))
    return row.select(expression).first()[0]


@pytest.mark.parametrize(
    "value, mode, expected",
    [("p", "keep", 1.0), ("e", "keep", 0.0), ("P", "keep", 0.0), (" p", "keep", 0.0),
     (None, "keep", None), (None, "negative", 0.0)],
)
def test_label_is_exact(spark, value, mode, expected):
    column = F.lit(value).cast("string")
    assert one(spark, binary_label(column, "p", mode)) == expected


@pytest.mark.parametrize(
    "value, expected", [(0.49, "no"), (0.5, "yes"), (1.0, "yes"), (None, None)]
)
def test_class_name_cuts_at_half(spark, value, expected):
    assert one(spark, class_name(F.lit(value).cast("double"), "no", "yes")) == expected


@pytest.mark.parametrize(
    "a, b, expected",
    [(18000, 5300, 3.39), (2500, 2300, 1.08), (1, 0, None), (0, 5, 0.0), (None, 5, None), (5, None, None)],
)
def test_ratio_is_truncated(spark, a, b, expected):
    ratio = truncated_ratio(F.lit(a).cast("bigint"), F.lit(b).cast("bigint"))
    assert one(spark, ratio) == expected


def test_percent(spark):
    assert one(spark, percent(F.lit(1), F.lit(3))) == 33.3
    assert one(spark, percent(F.lit(1), F.lit(0))) is None


def test_ids_are_stable_and_unambiguous(spark):
    def id_of(*parts):
        return one(spark, document_id("t", *[F.lit(p).cast("string") for p in parts]))

    assert id_of("a", "b") == id_of("a", "b")
    different = [("a", "b"), ("a|b",), ("a", None), (None, "a"), ("a\\", "b"), ("a\\|b",), ("\\N",), (None,)]
    assert len({id_of(*p) for p in different}) == len(different)


def test_failed_document_is_escaped(spark):
    line = one(spark, failed_document_json("a", "b"), a='say "hi"\n', b=1.5)
    assert line == '{"a":"say \\"hi\\"\\n","b":1.5}'


@pytest.mark.parametrize(
    "line, ms, phase, accuracy",
    [
        ("INFO Data loading and preparation completed in 2500 ms", 2500, "prepare", None),
        ("INFO Model training completed in 12 ms", 12, "train", None),
        ("Processing completed successfully in 7 ms", 7, "total", None),
        ("Model Accuracy: 0.75", None, None, 0.75),
        ("Model Accuracy: broken", None, None, None),
        ("nothing completed in time", None, None, None),
    ],
)
def test_log_lines(spark, line, ms, phase, accuracy):
    text = F.lit(line)
    assert one(spark, elapsed_ms(text)) == ms
    assert one(spark, phase_name(text)) == phase
    assert one(spark, accuracy_value(text)) == accuracy


def test_cosine(spark):
    def cosine(a, b):
        return one(spark, cosine_similarity(F.array(*map(F.lit, a)), F.array(*map(F.lit, b))))

    assert cosine([1.0, 0.0], [2.0, 0.0]) == 1.0
    assert cosine([1.0, 0.0], [0.0, 3.0]) == 0.0
    assert cosine([0.0, 0.0], [0.0, 3.0]) is None
