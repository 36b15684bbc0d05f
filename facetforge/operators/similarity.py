"""Nearest stored documents by cosine similarity, exact."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetforge.functions.columns import column
from facetforge.operators.ordering import number_rows
from facetforge.storage import fresh_path

# Query vectors searched in one pass over the documents. They travel with the
# tasks, so their number is checked; more queries take more passes.
QUERIES_PER_PASS = 1024
# Similarities are compared after rounding, so that equal vectors tie whatever
# the order of additions was.
SIMILARITY_DECIMALS = 9


def nearest_documents(
    documents: DataFrame,
    queries: DataFrame,
    k: int,
    id_column: str = "id",
    vector_column: str = "features",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
) -> DataFrame:
    """(query_id, rank, id, similarity): the ``k`` most similar documents.

    Ties are ordered by id. Vectors of length zero or NULL are similar to
    nothing. Each task keeps its own best k per query, so what is shuffled is
    tasks x queries x k rows, not documents x queries.
    """
    wanted = queries.select(
        column(query_id).alias("query_id"), column(query_vector).cast("array<double>").alias("vector")
    ).filter(F.col("vector").isNotNull())
    spark = documents.sparkSession
    query_type = wanted.schema["query_id"].dataType
    found_schema = T.StructType(
        [
            T.StructField("query_id", query_type),
            T.StructField("rank", T.IntegerType()),
            T.StructField("_id", documents.schema[id_column].dataType),
            T.StructField("similarity", T.DoubleType()),
        ]
    )

    def search(rows: list) -> DataFrame:
        if not rows:
            return spark.createDataFrame([], found_schema)
        return _search(documents, rows, k, id_column, vector_column, query_type)

    first = wanted.take(QUERIES_PER_PASS + 1)
    if len(first) <= QUERIES_PER_PASS:
        found = search(first)
    else:
        # One pass at a time, its result written before the next block of
        # queries is fetched: the driver never holds more than one block.
        numbered = number_rows(wanted, [F.col("query_id")], "_number")
        block = F.floor((F.col("_number") - 1) / F.lit(QUERIES_PER_PASS))
        path = fresh_path(spark, "nearest")
        for b in range(-(-numbered.count() // QUERIES_PER_PASS)):
            rows = numbered.filter(block == b).select("query_id", "vector").collect()
            search(rows).write.mode("append").parquet(path)
        found = spark.read.schema(found_schema).parquet(path)
    return found.withColumnsRenamed({"query_id": query_id, "_id": id_column})


def _search(
    documents: DataFrame, rows: list, k: int, id_column: str, vector_column: str, query_type: T.DataType
) -> DataFrame:
    names = [r["query_id"] for r in rows]
    lengths = {len(r["vector"]) for r in rows}
    if len(lengths) != 1:
        raise ValueError(f"query vectors differ in length: {sorted(lengths)}")
    matrix = np.array([r["vector"] for r in rows], dtype=np.float64)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix = np.divide(matrix, norms, out=np.full_like(matrix, np.nan), where=norms > 0)
    size = matrix.shape[1]

    candidates = documents.select(
        column(id_column).alias("_id"), column(vector_column).alias("vector")
    ).filter(F.col("vector").isNotNull())
    schema = T.StructType(
        [
            T.StructField("_query", T.IntegerType()),
            T.StructField("_id", candidates.schema["_id"].dataType),
            T.StructField("similarity", T.DoubleType()),
        ]
    )

    def best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, pa.Array]] = {}
        # Similarity a document must reach to be among the best k of a query.
        entry = np.full(len(matrix), -np.inf)
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
            if (sizes != size).any():
                raise ValueError(f"stored vectors must have {size} elements like the queries")
            block = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            block = block.reshape(-1, size)
            with np.errstate(divide="ignore", invalid="ignore"):
                similarity = (matrix @ block.T) / np.linalg.norm(block, axis=1)
            similarity = np.round(similarity, SIMILARITY_DECIMALS)
            # Comparisons with NaN are false, which leaves zero vectors out.
            reached = similarity >= entry[:, None]
            for q in np.flatnonzero(reached.any(axis=1)):
                places = np.flatnonzero(reached[q])
                scores, found = similarity[q, places], ids.take(pa.array(places))
                if q in kept:
                    scores = np.concatenate([kept[q][0], scores])
                    found = pa.concat_arrays([kept[q][1], found])
                kept[q] = _best(scores, found, k)
                if len(kept[q][0]) == k:
                    entry[q] = kept[q][0][-1]
        for q, (scores, found) in kept.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(scores), q, dtype=np.int32)), found, pa.array(scores)],
                names=["_query", "_id", "similarity"],
            )

    by_similarity = Window.partitionBy("_query").orderBy(F.col("similarity").desc(), F.col("_id"))
    ranked = (
        candidates.mapInArrow(best_of_task, schema)
        .withColumn("rank", F.row_number().over(by_similarity))
        .filter(F.col("rank") <= k)
    )
    query_names = documents.sparkSession.createDataFrame(
        list(enumerate(names)),
        T.StructType([T.StructField("_query", T.IntegerType()), T.StructField("query_id", query_type)]),
    )
    return ranked.join(F.broadcast(query_names), "_query").select(
        "query_id", "rank", "_id", "similarity"
    )


def _best(scores: np.ndarray, ids: pa.Array, k: int) -> tuple[np.ndarray, pa.Array]:
    """The k highest scores from high to low, equal ones by id."""
    order = pa.table({"score": scores, "id": ids}).sort_by(
        [("score", "descending"), ("id", "ascending")]
    )
    best = order.slice(0, k)
    return best["score"].to_numpy(), best["id"].combine_chunks()
