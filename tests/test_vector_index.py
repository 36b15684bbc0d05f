import numpy as np
import pytest
from pyspark.sql import functions as F

from facetforge.operators import vector_index
from facetforge.operators.similarity import nearest_documents
from facetforge.operators.vector_index import add_to_index, build_index, open_index, search_index
from facetforge.operators.vector_tiles import nearest_for_many

SCHEMA = "id long, features array<double>"


def make_vectors(n, width=8, seed=1, centres=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, width))
    return (middle[rng.integers(0, centres, n)] + 0.4 * rng.normal(size=(n, width))).tolist()


def nearest(rows, queries, k):
    found = set()
    for q, v in queries:
        scored = []
        for i, w in rows:
            if v is None or w is None or not any(v) or not any(w):
                continue
            cosine = np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w)
            scored.append((-round(float(cosine), 9), i))
        found |= {(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)}
    return found


def as_set(df):
    return {(r[0], r[1], r[2], round(r[3], 9)) for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    vectors = make_vectors(600)
    vectors[5] = vectors[7] = vectors[9] = vectors[3]  # ties
    vectors[20], vectors[21] = [0.0] * 8, None
    vectors[100:300] = [vectors[40]] * 200  # a third in one place
    return list(enumerate(vectors))


@pytest.fixture(scope="module")
def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def some_queries(spark, rows):
    asked = [(i, v) for i, v in rows if i % 20 in (0, 1)]
    return asked, spark.createDataFrame(asked, "query_id long, query_vector array<double>")


@pytest.mark.parametrize("tile_bytes", [1 << 24, 64 * 40])
def test_many_queries_equal_brute_force(spark, rows, documents, tile_bytes):
    asked, queries = some_queries(spark, rows)
    result = nearest_for_many(documents, queries, 7, tile_bytes=tile_bytes)
    assert result.columns == ["query_id", "rank", "id", "similarity"]
    got = as_set(result)
    assert got == nearest(rows, asked, 7)
    assert got == as_set(nearest_documents(documents, queries, 7))


@pytest.mark.parametrize("tile_bytes", [1 << 24, 64 * 40])
def test_index_is_exact(spark, rows, documents, tmp_path, tile_bytes):
    asked, queries = some_queries(spark, rows)
    build_index(documents, str(tmp_path / "i"), cells=16)
    index = open_index(spark, str(tmp_path / "i"))
    assert index.rows(spark).count() == 599  # one has no vector
    for probes in (1, 4):
        assert as_set(search_index(index, queries, 7, probes=probes, tile_bytes=tile_bytes)) == nearest(
            rows, asked, 7
        )
    # More rows asked for than probed cells hold.
    assert as_set(search_index(index, queries, 450, probes=1)) == nearest(rows, asked, 450)


def test_recall_of_nearest_cells(spark, tmp_path):
    rows = list(enumerate(make_vectors(3000, 16, 4, 30)))
    documents = spark.createDataFrame(rows, SCHEMA)
    index = build_index(documents, str(tmp_path / "i"), sample_rows=800)
    assert index.cells == 54
    asked = [(i, v) for i, v in rows if i % 20 == 0]
    queries = spark.createDataFrame(asked, "query_id long, query_vector array<double>")
    wanted = nearest(rows, asked, 10)
    found = as_set(search_index(index, queries, 10, exact=False))
    recall = len({x[::2] for x in found} & {x[::2] for x in wanted}) / len(wanted)
    assert recall >= 0.9
    assert as_set(search_index(index, queries, 10)) == wanted


def test_rows_added_later_are_found(spark, rows, tmp_path):
    first = spark.createDataFrame(rows[:400], SCHEMA)
    index = build_index(first, str(tmp_path / "i"), cells=10)
    far = [(9000 + i, [50.0 * (i + 1)] + [-1.0] * 7) for i in range(3)]
    add_to_index(index, spark.createDataFrame(rows[400:] + far, SCHEMA))
    asked, queries = some_queries(spark, rows + far)
    assert as_set(search_index(index, queries, 5, probes=2)) == nearest(rows + far, asked, 5)


def test_edge_cases(spark, documents, tmp_path):
    none = spark.createDataFrame([], "query_id long, query_vector array<double>")
    nothing = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(1, [1.0] * 8), (2, [0.0] * 8)], "query_id long, query_vector array<double>")
    assert nearest_for_many(documents, none, 3).count() == 0
    assert nearest_for_many(nothing, one, 3).count() == 0
    assert {r[0] for r in nearest_for_many(documents, one, 3).collect()} == {1}
    index = build_index(documents, str(tmp_path / "i"), cells=5)
    assert search_index(index, none, 3).count() == 0
    assert {r[0] for r in search_index(index, one, 3).collect()} == {1}
    short = spark.createDataFrame([(1, [1.0])], "query_id long, query_vector array<double>")
    with pytest.raises(Exception, match="elements"):
        nearest_for_many(documents, short, 3).collect()


def test_centres_are_fitted_by_many_tasks(spark, monkeypatch):
    fitted = []

    class Watched(vector_index.KMeans):
        def fit(self, sample):
            fitted.append((self.getSolver(), sample))
            return super().fit(sample)

    monkeypatch.setattr(vector_index, "KMeans", Watched)
    rows = list(enumerate(make_vectors(9000)))
    documents = spark.createDataFrame(rows, SCHEMA).repartition(4)
    index_rows = documents.withColumnRenamed("features", "vector")
    assert vector_index.fit_centres(index_rows, cells=6, sample_rows=8000).shape == (6, 8)
    ((solver, sample),) = fitted
    assert solver == "block"
    sizes = [r["count"] for r in sample.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 8000
    assert len(sizes) == 4 and max(sizes) < 2100


def test_exact_step_sends_a_query_to_a_block_once(spark, tmp_path, monkeypatch):
    written = {}
    materialise = vector_index.materialise
    monkeypatch.setattr(
        vector_index, "materialise", lambda df, name: written.setdefault(name, materialise(df, name))
    )
    monkeypatch.setattr(vector_index, "_LEAST_BLOCKS", 4)
    # Vectors without clusters: the bound rules out next to no cell.
    vectors = np.random.default_rng(3).normal(size=(800, 16)).tolist()
    vectors[300:340] = [vectors[20]] * 40  # more copies than are asked for
    rows = list(enumerate(vectors))
    documents = spark.createDataFrame(rows, SCHEMA).repartition(4)
    asked, queries = some_queries(spark, rows)
    index = build_index(documents, str(tmp_path / "i"), cells=32)
    assert as_set(search_index(index, queries, 7, probes=2)) == nearest(rows, asked, 7)
    cells = index.rows(spark).select("cell").distinct().count()
    further = written["further"]
    looked_into = further.agg(F.sum(F.size("wanted"))).first()[0]
    assert looked_into > len(asked) * (cells - 2) * 0.8
    assert further.count() <= 6 * len(asked)


def test_blocks_are_runs_of_cells():
    held = {0: 3, 1: 3, 3: 20, 4: 5, 5: 5, 6: 1}
    assert vector_index._blocks(held, 8, 10) == [0, 0, 0, 1, 2, 2, 3, 3]
