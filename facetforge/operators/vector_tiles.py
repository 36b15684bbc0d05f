"""Nearest vectors for many queries: a tiled join.

Queries and documents are cut into tiles of bounded size. A tile of queries
meets a tile of documents in one task, which multiplies the two matrices and
keeps the best k of each query; only these are shuffled and merged. Neither side
goes to the driver or into a broadcast, and no pass is made per block of queries.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetforge.functions.columns import column
from facetforge.operators.similarity import SIMILARITY_DECIMALS

# Vectors of a tile, on either side, in bytes. A task holds one of each.
TILE_BYTES = 16 << 20
# Similarities that a task holds at once.
_CELLS = 1 << 22


def vectors_of(values: pa.Array | pa.ChunkedArray, size: int | None = None) -> np.ndarray:
    """A list column as a matrix of unit vectors; rows of zeros become NaN."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if not len(values):
        return np.zeros((0, size or 0))
    lengths = pc.list_value_length(values)
    width = size if size is not None else lengths[0].as_py()
    if pc.any(pc.not_equal(lengths, width)).as_py():
        raise ValueError(f"vectors must all have {width} elements")
    matrix = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.full_like(matrix, np.nan), where=norms > 0)


def best_of_tile(
    left: np.ndarray,
    right: np.ndarray,
    right_ids: pa.Array,
    k: int,
    entry: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of left, row of right, similarity) of the k most similar rows of
    ``right`` for each row of ``left``; ties by id. ``entry`` has the similarity
    that each row of ``left`` asks for at least, -inf for none."""
    # Places of the right side by id, so that a stable sort settles ties.
    by_id = pc.sort_indices(right_ids).to_numpy()
    right = right[by_id]
    rows, found, scores = [], [], []
    step = max(1, _CELLS // max(1, len(right)))
    for first in range(0, len(left), step):
        similarity = left[first : first + step] @ right.T
        if entry is None:
            least = np.full(len(similarity), -np.inf)
        else:
            least = entry[first : first + step].copy()
        unbound = np.flatnonzero(least == -np.inf)
        if len(unbound) and k < similarity.shape[1]:
            # All that reach the k-th similarity, ties included. NaN, of vectors
            # of length zero, is similar to nothing.
            some = np.round(similarity[unbound], SIMILARITY_DECIMALS)
            some = np.where(np.isnan(some), -np.inf, some)
            least[unbound] = -np.partition(-some, k - 1, axis=1)[:, k - 1]
        # Only what may reach it is rounded.
        row, place = np.nonzero(similarity >= (least - 10.0**-SIMILARITY_DECIMALS)[:, None])
        score = np.round(similarity[row, place], SIMILARITY_DECIMALS)
        reached = score >= least[row]
        row, place, score = row[reached], place[reached], score[reached]
        order = np.lexsort((place, -score, row))
        row, place, score = row[order], place[order], score[order]
        start = np.searchsorted(row, row)
        kept = np.arange(len(row)) - start < k
        rows.append(row[kept] + first)
        found.append(by_id[place[kept]])
        scores.append(score[kept])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(rows), np.concatenate(found), np.concatenate(scores)


def best_of_parts(
    left: np.ndarray,
    right: np.ndarray,
    right_ids: pa.Array,
    k: int,
    entry: np.ndarray,
    wanted: pa.ListArray,
    part: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like ``best_of_tile``, but a row of ``left`` meets only the rows of
    ``right`` whose part is among those it wants."""
    owner = np.repeat(np.arange(len(left)), pc.list_value_length(wanted).to_numpy(zero_copy_only=False))
    asked = wanted.flatten().to_numpy(zero_copy_only=False)
    by_part, by_asked = np.argsort(part, kind="stable"), np.argsort(asked, kind="stable")
    part, asked, owner = part[by_part], asked[by_asked], owner[by_asked]
    rows, found, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for p in np.unique(part):
        who = owner[np.searchsorted(asked, p) : np.searchsorted(asked, p, "right")]
        places = by_part[np.searchsorted(part, p) : np.searchsorted(part, p, "right")]
        row, place, score = best_of_tile(
            left[who], right[places], right_ids.take(pa.array(places)), k, entry[who]
        )
        rows.append(who[row])
        found.append(places[place])
        scores.append(score)
    row, place, score = np.concatenate(rows), np.concatenate(found), np.concatenate(scores)
    rank = np.empty(len(right), np.int64)
    rank[pc.sort_indices(right_ids).to_numpy()] = np.arange(len(right))
    order = np.lexsort((rank[place], -score, row))
    row, place, score = row[order], place[order], score[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[kept], place[kept], score[kept]


def _tiles(counts: Mapping[int, int], width: int, tile_bytes: int) -> dict[int, int]:
    rows = max(1, tile_bytes // (8 * max(1, width)))
    return {cell: -(-n // rows) for cell, n in counts.items()}


def _count(df: DataFrame) -> dict[int, int]:
    """Rows by cell: one number for each cell of an index at most."""
    return {r["cell"]: r["n"] for r in df.groupBy("cell").agg(F.count("*").alias("n")).collect()}


def of_cell(values: Mapping[int, int]) -> Column:
    """The value of the row's cell. Cells are numbers from 0 on."""
    listed = [values.get(c, 0) for c in range(max(values) + 1)]
    return F.get(F.split(F.lit(",".join(map(str, listed))), ",").cast("array<int>"), F.col("cell"))


def tiled_best(
    queries: DataFrame, documents: DataFrame, k: int, width: int, tile_bytes: int = TILE_BYTES
) -> DataFrame:
    """(query_id, rank, id, similarity) for queries (cell, query_id, vector) and
    documents (cell, id, vector): the best k documents of the query's cells.

    Any number of rows may share a cell: cells are cut into tiles by hashes. If
    documents have a ``part``, queries have the list of the parts they look into
    (``wanted``) and the similarity they ask for at least (``entry``).
    """
    parted = "part" in documents.columns
    asked, held = _count(queries), _count(documents)
    both = asked.keys() & held.keys()
    schema = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("id", documents.schema["id"].dataType),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
    ranked = T.StructType([schema["query_id"], T.StructField("rank", T.IntegerType()), *schema.fields[1:]])
    if not both:
        return queries.sparkSession.createDataFrame([], ranked)
    above = _tiles({c: asked[c] for c in both}, width, tile_bytes)
    beside = _tiles({c: held[c] for c in both}, width, tile_bytes)

    def dealt(
        df: DataFrame, key: str, own: dict, other: dict, mine: str, theirs: str, *extra: str
    ) -> DataFrame:
        """Each row in its own tile, once for every tile of the other side."""
        met = df.filter(F.col("cell").isin(*both)) if len(both) < max(len(asked), len(held)) else df
        return met.select(
            "cell",
            key,
            "vector",
            *extra,
            F.pmod(F.xxhash64(key), of_cell(own).cast("long")).cast("int").alias(mine),
            F.explode(F.sequence(F.lit(0), of_cell(other) - F.lit(1))).alias(theirs),
        )

    bounds = ("entry", "wanted") if parted else ()
    left = dealt(queries, "query_id", above, beside, "above", "beside", *bounds)
    right = dealt(documents, "id", beside, above, "beside", "above", *(("part",) if parted else ()))

    def compare(some: pa.Table, others: pa.Table) -> pa.Table:
        ids = others["id"].combine_chunks()
        both = vectors_of(some["vector"], width), vectors_of(others["vector"], width), ids, k
        if parted:
            row, place, score = best_of_parts(
                *both,
                some["entry"].to_numpy(),
                some["wanted"].combine_chunks(),
                others["part"].to_numpy(),
            )
        else:
            row, place, score = best_of_tile(*both)
        return pa.table(
            {
                "query_id": some["query_id"].combine_chunks().take(pa.array(row)),
                "id": ids.take(pa.array(place)),
                "similarity": pa.array(score),
            }
        )

    key = ["cell", "above", "beside"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(compare, schema)
    return best_of_each(found, k)


def best_of_each(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, id, similarity): the best k rows of each query."""
    # Spark cuts each task's rows of a query to k before it shuffles them.
    by_similarity = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), F.col("id"))
    return (
        found.withColumn("rank", F.row_number().over(by_similarity))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "id", "similarity")
    )


def width_of(vectors: DataFrame, name: str = "vector") -> int:
    """The number of elements of the first vector; 0 for none."""
    first = vectors.select(F.size(name).alias("n")).first()
    return first["n"] if first is not None else 0


def nearest_for_many(
    documents: DataFrame,
    queries: DataFrame,
    k: int,
    id_column: str = "id",
    vector_column: str = "features",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """(query_id, rank, id, similarity): the ``k`` documents most similar to each
    query by cosine, for any number of queries. Query ids must differ.

    Ties are ordered by id. Vectors of length zero or NULL are similar to
    nothing. Vectors of different lengths are an error. The work is queries x
    documents; what is shuffled is each document once for every tile of queries,
    each query once for every tile of documents, and k rows for each query and
    tile of documents.
    """
    asked = queries.select(
        F.lit(0).alias("cell"),
        column(query_id).alias("query_id"),
        column(query_vector).cast("array<double>").alias("vector"),
    ).filter(F.col("vector").isNotNull())
    held = documents.select(
        F.lit(0).alias("cell"),
        column(id_column).alias("id"),
        column(vector_column).cast("array<double>").alias("vector"),
    ).filter(F.col("vector").isNotNull())
    found = tiled_best(asked, held, k, width_of(asked), tile_bytes)
    return found.withColumnsRenamed({"query_id": query_id, "id": id_column})
