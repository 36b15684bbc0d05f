import random
from collections import Counter

import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from facetforge.operators import encoding
from facetforge.operators.documents import vector_entries
from facetforge.operators.encoding import (
    encode,
    encode_rows,
    encoder,
    fit_vocabulary,
    one_hot_positions,
)


def vectors(df, model, attributes, key="k"):
    out = encode(df, model, attributes, [key, "features"])
    return {r[0]: list(r[1]) for r in out.select(key, vector_to_array("features")).collect()}


def test_ranking_by_frequency_then_text(spark):
    df = spark.createDataFrame([(v,) for v in "bbaaccc?"] + [(None,)], "v string")
    table = fit_vocabulary(df, ["v"]).table
    assert [r["category"] for r in table.orderBy("idx").collect()] == ["c", "a", "b", "?"]
    assert sum(r["n"] for r in table.collect()) == 8


def test_constant_null_and_unseen(spark):
    fitted = spark.createDataFrame([(1, "x", "a"), (2, "x", "b"), (3, "x", "b")], "k int, c string, v string")
    model = encoder(fitted, fit_vocabulary(fitted, ["c", "v"]))
    new = spark.createDataFrame([(1, "x", "b"), (2, None, "zzz"), (3, "x", None)], fitted.schema)
    assert vectors(new, model, ["c", "v"]) == {1: [1, 1, 0], 2: [0, 0, 0], 3: [1, 0, 0]}


def test_types_are_encoded_by_their_text(spark):
    df = spark.createDataFrame(
        [(1, True, "t", 900.0, 5), (2, False, "f", 1.5, 5)], "k int, b boolean, s string, d double, i int"
    )
    vocabulary = fit_vocabulary(df, ["b", "s", "d", "i"])
    assert {(r["attribute"], r["category"]) for r in vocabulary.table.collect()} == {
        ("b", "true"), ("b", "false"), ("s", "t"), ("s", "f"), ("d", "900.0"), ("d", "1.5"), ("i", "5"),
    }
    got = vectors(df, encoder(df, vocabulary), ["b", "s", "d", "i"])
    assert all(sum(v) == 4 and len(v) == 7 for v in got.values())


def test_all_null_attribute_has_no_block(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "y", None)], "k int, a string, b string")
    model = encoder(df, fit_vocabulary(df, ["a", "b"]))
    assert vectors(df, model, ["a", "b"]) == {1: [1, 0], 2: [0, 1]}


def test_dotted_attribute_is_refused(spark):
    df = spark.createDataFrame([("x",)], "`a.b` string")
    with pytest.raises(ValueError, match="dots"):
        fit_vocabulary(df, ["a.b"])


def test_dashes_in_names(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k int, `cap-shape` string")
    assert vectors(df, encoder(df, fit_vocabulary(df, ["cap-shape"])), ["cap-shape"]) == {1: [1, 0], 2: [0, 1]}


def test_same_vectors_as_library_estimators(spark):
    draw = random.Random(3)
    rows = [(i, draw.choice("abcdé?"), draw.choice(["x", "y", None])) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    stages = [
        StringIndexer(inputCols=["a", "b"], outputCols=["ai", "bi"], handleInvalid="keep"),
        OneHotEncoder(inputCols=["ai", "bi"], outputCols=["ae", "be"]),
        VectorAssembler(inputCols=["ae", "be"], outputCol="features"),
    ]
    library = Pipeline(stages=stages).fit(df).transform(df)
    wanted = {r[0]: list(r[1]) for r in library.select("k", vector_to_array("features")).collect()}
    assert vectors(df, encoder(df, fit_vocabulary(df, ["a", "b"])), ["a", "b"]) == wanted


@pytest.mark.parametrize("limit", [3, 1000])
def test_positions_equal_brute_force_with_a_hot_category(spark, limit):
    draw = random.Random(4)
    rows = [(i, "hot" if draw.random() < 0.4 else f"v{draw.randrange(40)}", draw.choice(["x", "y", None]))
            for i in range(800)]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    vocabulary = fit_vocabulary(df, ["a", "b"], local_limit=limit)
    assert vocabulary.is_local() == (limit == 1000)

    wanted, offset = set(), 0
    for attribute, place in (("a", 1), ("b", 2)):
        counts = Counter(r[place] for r in rows if r[place] is not None)
        ranked = sorted(counts, key=lambda v: (-counts[v], v))
        for r in rows:
            if r[place] is not None:
                wanted.add((r[0], attribute, offset + ranked.index(r[place])))
        offset += len(ranked)
    got = [tuple(r) for r in one_hot_positions(df, ["k"], vocabulary).collect()]
    assert len(got) == len(wanted) and set(got) == wanted

    unseen = df.withColumn("a", F.lit("never seen"))
    found = one_hot_positions(unseen, ["k"], vocabulary)
    assert {r["attribute"] for r in found.collect()} == {"b"}


def test_long_categories_are_not_local(spark, monkeypatch):
    monkeypatch.setattr(encoding, "MAX_LOCAL_BYTES", 100)
    monkeypatch.setattr(encoding, "SHORT_CATEGORY_BYTES", 10)
    rows = [(i, "long" * 40 if i % 3 else f"s{i % 2}") for i in range(60)]
    df = spark.createDataFrame(rows, "k int, a string")
    vocabulary = fit_vocabulary(df, ["a"])
    assert not vocabulary.is_local()
    got = {r["k"]: r["pos"] for r in one_hot_positions(df, ["k"], vocabulary).collect()}
    assert got == {i: 0 if i % 3 else 1 + i % 2 for i in range(60)}


def test_key_may_be_an_attribute(spark):
    df = spark.createDataFrame([("x",), ("y",)], "a string")
    got = one_hot_positions(df, ["a"], fit_vocabulary(df, ["a"])).collect()
    assert sorted(tuple(r) for r in got) == [("x", "a", 0), ("y", "a", 1)]


def test_too_many_categories_for_a_vector(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("a"))
    with pytest.raises(ValueError, match="too many"):
        encoder(df, fit_vocabulary(df, ["a"], local_limit=10))


def test_vectors_of_any_vocabulary_are_those_of_the_encoder(spark, monkeypatch):
    monkeypatch.setattr(encoding, "SHORT_CATEGORY_BYTES", 40)
    draw = random.Random(6)
    pool = ["hot", "long " * 60, *[f"v{i}" for i in range(50)], *["x" * 50 + str(i) for i in range(5)], None]
    rows = [
        (i, draw.choice(["long " * 60, *pool]), draw.choice(["x", "y", None])) for i in range(400)
    ]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    wanted = vectors(df, encoder(df, fit_vocabulary(df, ["a", "b"])), ["a", "b"])
    found = encode_rows(df, fit_vocabulary(df, ["a", "b"], local_limit=20), ["k"])
    got = {r[0]: list(r[1]) for r in found.select("k", vector_to_array("features")).collect()}
    assert got == wanted
    unseen = df.withColumn("a", F.lit("never seen"))
    found = encode_rows(unseen, fit_vocabulary(df, ["a", "b"], local_limit=20), ["k"])
    for r in found.select("k", vector_to_array("features").alias("v")).collect():
        assert r["v"] == [0.0] * (len(r["v"]) - 2) + wanted[r["k"]][-2:]


def test_vectors_over_more_categories_than_label_lists_hold(spark):
    df = spark.range(100_001).select(F.col("id").cast("string").alias("a"), "id")
    vocabulary = fit_vocabulary(df, ["a"])
    assert not vocabulary.is_local()
    row = encode_rows(df, vocabulary, ["id"]).filter("id = 7").first()
    assert row["features"].size == 100_001 and row["features"].numNonzeros() == 1


def test_vector_entries_are_those_that_are_not_zero(spark):
    rows = [
        (1, Vectors.sparse(10**6, [3, 999_999], [1.5, -2.0])),
        (2, Vectors.dense([0.0, 7.25, 1e-300])),
        (3, Vectors.sparse(5, [], [])),
        (4, Vectors.dense([])),
        (5, None),
        (6, Vectors.sparse(4, [1, 2], [0.0, 0.1])),
    ]
    table = spark.createDataFrame(rows, StructType([StructField("k", LongType()), StructField("v", VectorUDT())]))
    found = vector_entries(table, "k", "v")
    assert found.columns == ["k", "pos", "value"]
    assert sorted(tuple(r) for r in found.collect()) == [
        (1, 3, 1.5), (1, 999_999, -2.0), (2, 1, 7.25), (2, 2, 1e-300), (6, 2, 0.1),
    ]
    arrays = spark.createDataFrame([(1, [0.0, 2.0])], "k long, v array<double>")
    assert [tuple(r) for r in vector_entries(arrays, "k", "v").collect()] == [(1, 1, 2.0)]
