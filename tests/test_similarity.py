import numpy as np
import pytest
from pyspark.sql import functions as F

from facetforge.functions import cosine_similarity
from facetforge.operators import similarity
from facetforge.operators.similarity import nearest_documents


def brute_force(docs, queries, k):
    found = set()
    for name, q in queries:
        scored = []
        for id_, v in docs:
            if v is None or not np.linalg.norm(v) or not np.linalg.norm(q):
                continue
            cosine = np.dot(v, q) / (np.linalg.norm(v) * np.linalg.norm(q))
            scored.append((-round(float(cosine), 9), id_))
        found |= {(name, rank, id_, -s) for rank, (s, id_) in enumerate(sorted(scored)[:k], 1)}
    return found


@pytest.fixture(scope="module")
def data():
    draw = np.random.default_rng(7)
    docs = [(f"d{i:04d}", draw.normal(size=8).tolist()) for i in range(600)]
    # A third of the documents are copies of one vector, in no particular place.
    docs += [(f"c{i:04d}", docs[0][1]) for i in range(300)]
    docs += [("zero", [0.0] * 8), ("none", None)]
    queries = [(i, draw.normal(size=8).tolist()) for i in range(5)] + [(5, docs[0][1]), (6, [0.0] * 8)]
    return docs, queries


@pytest.mark.parametrize("per_pass", [1024, 2])
def test_exact_top_k_with_ties_and_copies(spark, data, monkeypatch, per_pass):
    monkeypatch.setattr(similarity, "QUERIES_PER_PASS", per_pass)
    docs, queries = data
    d = spark.createDataFrame(docs, "id string, features array<double>").repartition(6)
    q = spark.createDataFrame(queries, "query_id int, query_vector array<double>")
    got = [tuple(r) for r in nearest_documents(d, q, 7).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_force(docs, queries, 7)


def test_agrees_with_the_column_expression(spark, data):
    docs, queries = data
    d = spark.createDataFrame(docs[:50], "id string, features array<double>")
    q = F.array(*[F.lit(x) for x in queries[0][1]])
    wanted = {r[0]: r[1] for r in d.select("id", cosine_similarity(F.col("features"), q)).collect()}
    one = spark.createDataFrame(queries[:1], "query_id int, query_vector array<double>")
    for r in nearest_documents(d, one, 10).collect():
        assert r["similarity"] == pytest.approx(wanted[r["id"]], abs=1e-8)


def test_no_queries_and_wrong_length(spark, data):
    d = spark.createDataFrame(data[0][:5], "id string, features array<double>")
    none = spark.createDataFrame([], "query_id int, query_vector array<double>")
    assert nearest_documents(d, none, 3).count() == 0
    short = spark.createDataFrame([(1, [1.0])], "query_id int, query_vector array<double>")
    with pytest.raises(Exception, match="elements"):
        nearest_documents(d, short, 3).collect()
