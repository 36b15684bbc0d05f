"""Nearest vectors for every vector whose id is divisible by 20."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetforge.operators.vector_index import build_index, search_index
from facetforge.operators.vector_tiles import nearest_for_many
from facetforge.plans.queries.common import table
from facetforge.storage import fresh_path

BEST = 10


def _asked(embeddings: DataFrame) -> DataFrame:
    return embeddings.filter(F.col("vec_id") % 20 == 0).select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector")
    )


def vector_topk_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of all vectors, by the tiled join."""
    embeddings = table(spark, sf_dir, "embeddings")
    found = nearest_for_many(embeddings, _asked(embeddings), BEST, "vec_id", "embedding")
    return found.withColumn("similarity", F.round("similarity", 6))


def vector_index_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, by an index fitted and stored before; bounds make it exact."""
    embeddings = table(spark, sf_dir, "embeddings")
    index = build_index(embeddings, fresh_path(spark, "index"), "vec_id", "embedding")
    found = search_index(index, _asked(embeddings), BEST)
    return found.withColumnRenamed("id", "vec_id").withColumn("similarity", F.round("similarity", 6))


def vector_index_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every row is stored once in the index, by label."""
    embeddings = table(spark, sf_dir, "embeddings")
    index = build_index(embeddings, fresh_path(spark, "index"), "vec_id", "embedding")
    stored = index.rows(spark).select(F.col("id").alias("vec_id"))
    return (
        embeddings.join(stored, "vec_id")
        .groupBy("label")
        .agg(F.count("*").alias("rows"), F.count_distinct("vec_id").alias("ids"))
    )


QUERIES = {
    "vector_topk_many": vector_topk_many,
    "vector_index_topk": vector_index_topk,
    "vector_index_cells": vector_index_cells,
}

_NEAREST = f"""
    WITH compared AS (
        SELECT q.vec_id AS query_id, e.vec_id, round(list_cosine_similarity(
            CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])), 9) AS similarity
        FROM embeddings q CROSS JOIN embeddings e WHERE q.vec_id % 20 = 0),
    ranked AS (SELECT *, row_number() OVER
               (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS rank FROM compared)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(similarity, 6) AS similarity
    FROM ranked WHERE rank <= {BEST}
"""

SQL = {
    "vector_topk_many": _NEAREST,
    "vector_index_topk": _NEAREST,
    "vector_index_cells": """
        SELECT label, count(*) AS rows, count(*) AS ids FROM embeddings GROUP BY label
    """,
}
