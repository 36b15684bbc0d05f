"""A cell index over stored vectors, searched exactly or by the nearest cells.

Cells are those of k-means, fitted on a bounded sample; every row is stored, in
the folder of the cell whose centre is nearest. With unit vectors, the distance
between a query and a row is at least that between query and centre less the
radius of the cell. A search looks into the nearest cells first; with ``exact``
it then looks into all further cells that this bound does not rule out.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetforge.functions.columns import column
from facetforge.operators.vector_tiles import (
    SIMILARITY_DECIMALS,
    TILE_BYTES,
    best_of_each,
    of_cell,
    tiled_best,
    vectors_of,
    width_of,
)
from facetforge.storage import materialise

# Rows that the centres are fitted on, at most. Rows are taken by a hash of their
# id, so a repeated fit takes the same.
SAMPLE_ROWS = 100_000
# Rows of a part of the sample. The limit leaves them in one file, which would
# make every pass of k-means a single task.
_PART_ROWS = 2048
# Cells, and bytes of their centres, which travel with the tasks.
MAX_CELLS = 4096
MAX_CENTRE_BYTES = 64 << 20
# Cells looked into at first.
PROBES = 8
# Blocks that the exact step deals cells into: so many at least, for as many
# tasks, and none of more than this part of a tile.
_LEAST_BLOCKS = 64
_PART_OF_TILE = 4
# What rounding may take from a bound.
_SLACK = 10.0 ** (1 - SIMILARITY_DECIMALS)


@dataclass(frozen=True)
class VectorIndex:
    path: str
    centres: np.ndarray  # cells x elements, unit vectors need not be

    @property
    def cells(self) -> int:
        return len(self.centres)

    def rows(self, spark: SparkSession) -> DataFrame:
        """cell, id, vector, distance (to the centre) of every stored row. Vectors
        of length zero have no cell: they are in folder -1 and never found."""
        return spark.read.parquet(f"{self.path}/rows")


def _unit(documents: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    return documents.select(
        column(id_column).alias("id"), column(vector_column).cast("array<double>").alias("vector")
    ).filter(F.col("vector").isNotNull())


def fit_centres(
    rows: DataFrame, cells: int | None = None, sample_rows: int = SAMPLE_ROWS, seed: int = 7
) -> np.ndarray:
    """The centres of k-means on at most ``sample_rows`` of rows (id, vector).
    Without ``cells`` there are as many as the square root of the number of rows,
    at most MAX_CELLS."""
    spark = rows.sparkSession
    number = rows.count()
    if not number:
        return np.zeros((0, 0))
    width = width_of(rows)
    wanted = cells if cells is not None else int(number**0.5)
    wanted = max(1, min(wanted, MAX_CELLS, MAX_CENTRE_BYTES // (8 * max(1, width))))
    # About a tenth more than asked for, then cut: the sort stays small.
    share = min(1.0, 1.1 * sample_rows / number)
    draw = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.filter(draw < share) if share < 1 else rows
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    unit = F.transform("vector", lambda x: x / F.col("norm"))
    sample = (
        drawn.withColumn("norm", norm)
        .filter("norm > 0")
        .orderBy(F.xxhash64(F.lit(seed), "id"), "id")
        .limit(sample_rows)
        .select(array_to_vector(unit).alias("features"))
    )
    sample = materialise(sample.repartition(-(-min(number, sample_rows) // _PART_ROWS)), "index-sample")
    if sample.isEmpty():
        return np.zeros((1, width))
    # By blocks, because the solver by rows compares all centres with each other
    # before every pass, in one task for each centre.
    model = KMeans(k=max(2, wanted), seed=seed, maxIter=20, solver="block").fit(sample)
    return np.array(model.clusterCenters())


def _placed(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """(cell, id, vector, distance): unit vectors in the cell of the nearest
    centre; vectors of length zero in cell -1."""
    sent = rows.sparkSession.sparkContext.broadcast(centres)
    schema = T.StructType(
        [
            T.StructField("cell", T.IntegerType()),
            rows.schema["id"],
            T.StructField("vector", T.ArrayType(T.DoubleType())),
            T.StructField("distance", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = sent.value
        lengths = (centres * centres).sum(axis=1)
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                unit = vectors_of(part.column(1), centres.shape[1])
                square = np.maximum(1.0 - 2.0 * unit @ centres.T + lengths, 0.0)
                known = ~np.isnan(square).any(axis=1)
                square[~known] = 0.0
                cell = np.where(known, square.argmin(axis=1), -1)
                offsets = np.arange(len(unit) + 1, dtype=np.int32) * centres.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cell, pa.int32()),
                        part.column(0),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(unit.ravel())),
                        pa.array(np.sqrt(square.min(axis=1))),
                    ],
                    names=schema.names,
                )

    return rows.select("id", "vector").mapInArrow(run, schema)


def _write(placed: DataFrame, path: str) -> None:
    # A cell's rows go to a few tasks by their ids, so a full cell is no hot task,
    # and a cell does not get a file from every task.
    spread = F.pmod(F.xxhash64("id"), F.lit(8))
    placed.repartition(F.col("cell"), spread).write.mode("append").partitionBy("cell").parquet(
        f"{path}/rows"
    )


def build_index(
    documents: DataFrame,
    path: str,
    id_column: str = "id",
    vector_column: str = "features",
    cells: int | None = None,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 7,
) -> VectorIndex:
    """Fit centres and store every row of ``documents`` that has a vector."""
    rows = _unit(documents, id_column, vector_column)
    centres = fit_centres(rows, cells, sample_rows, seed)
    spark = documents.sparkSession
    written = json.dumps(centres.tolist())
    spark.createDataFrame([(written,)], "value string").write.text(f"{path}/centres")
    index = VectorIndex(path, centres)
    if len(centres):
        _write(_placed(rows, centres), path)
    return index


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    centres = json.loads(spark.read.text(f"{path}/centres").first()["value"])
    return VectorIndex(path, np.array(centres, dtype=np.float64).reshape(len(centres), -1))


def add_to_index(
    index: VectorIndex, documents: DataFrame, id_column: str = "id", vector_column: str = "features"
) -> None:
    """Store further rows in the cells there are."""
    _write(_placed(_unit(documents, id_column, vector_column), index.centres), index.path)


def _distances(vectors: pa.Array, centres: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """From each vector to each centre; infinite for vectors of length zero and to
    empty cells."""
    unit = vectors_of(vectors, centres.shape[1])
    distance = np.sqrt(np.maximum(1.0 - 2.0 * unit @ centres.T + (centres * centres).sum(axis=1), 0.0))
    return np.where(np.isnan(distance) | ~filled, np.inf, distance)


def _nearest(distance: np.ndarray, probes: int) -> np.ndarray:
    rank = np.argsort(np.argsort(distance, axis=1, kind="stable"), axis=1, kind="stable")
    return (rank < probes) & np.isfinite(distance)


def _cells_of_queries(
    queries: DataFrame, index: VectorIndex, radii: list[float], probes: int
) -> DataFrame:
    """(cell, query_id, vector) for the ``probes`` cells nearest to each query."""
    sent = queries.sparkSession.sparkContext.broadcast((index.centres, np.array(radii)))
    schema = T.StructType(
        [
            T.StructField("cell", T.IntegerType()),
            queries.schema["query_id"],
            T.StructField("vector", T.ArrayType(T.DoubleType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, radii = sent.value
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                row, cell = np.nonzero(_nearest(_distances(part.column(1), centres, radii >= 0), probes))
                taken = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cell, pa.int32()),
                        part.column(0).take(taken),
                        part.column(1).take(taken),
                    ],
                    names=schema.names,
                )

    return queries.select("query_id", "vector").mapInArrow(run, schema)


def _blocks(held: Mapping[int, int], cells: int, rows: int) -> list[int]:
    """The block of each cell: runs of cells of about ``rows`` rows together. A
    fuller cell is a block of its own."""
    blocks, block, taken = [], 0, 0
    for cell in range(cells):
        own = held.get(cell, 0)
        if taken and taken + own > rows:
            block, taken = block + 1, 0
        taken += own
        blocks.append(block)
    return blocks


def _further_blocks(
    queries: DataFrame, index: VectorIndex, radii: list[float], probes: int, blocks: list[int]
) -> DataFrame:
    """(cell, query_id, vector, entry, wanted) for the blocks (as ``cell``) that
    have cells beyond the nearest ``probes`` which ``reach`` does not rule out;
    ``wanted`` are these cells. A query goes to a block once, however many of its
    cells it looks into."""
    sent = queries.sparkSession.sparkContext.broadcast((index.centres, np.array(radii), np.array(blocks)))
    schema = T.StructType(
        [
            T.StructField("cell", T.IntegerType()),
            queries.schema["query_id"],
            T.StructField("vector", T.ArrayType(T.DoubleType())),
            T.StructField("entry", T.DoubleType()),
            T.StructField("wanted", T.ArrayType(T.IntegerType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, radii, blocks = sent.value
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                distance = _distances(part.column(1), centres, radii >= 0)
                reach = part.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
                reach = np.where(np.isnan(reach), np.inf, reach)
                entry = part.column(3).to_numpy(zero_copy_only=False).astype(np.float64)
                entry = np.where(np.isnan(entry), -np.inf, entry)
                wanted = ~_nearest(distance, probes) & np.isfinite(distance)
                row, cell = np.nonzero(wanted & (distance - radii <= reach[:, None]))
                # Cells of a block follow each other, so the lists are slices.
                start = np.flatnonzero(np.diff(row * len(blocks) + blocks[cell], prepend=-1))
                taken = pa.array(row[start])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(blocks[cell[start]], pa.int32()),
                        part.column(0).take(taken),
                        part.column(1).take(taken),
                        pa.array(entry[row[start]]),
                        pa.ListArray.from_arrays(
                            pa.array(np.append(start, len(cell)), pa.int32()), pa.array(cell, pa.int32())
                        ),
                    ],
                    names=schema.names,
                )

    return queries.select("query_id", "vector", "reach", "entry").mapInArrow(run, schema)


def search_index(
    index: VectorIndex,
    queries: DataFrame,
    k: int,
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    probes: int = PROBES,
    exact: bool = True,
    tile_bytes: int = TILE_BYTES,
) -> DataFrame:
    """(query_id, rank, id, similarity): the ``k`` stored rows most similar to
    each query. Without ``exact`` only the nearest ``probes`` cells are looked
    into, and some of the k may be missed. Ties are ordered by id; query ids must
    differ; vectors of length zero or NULL find nothing."""
    spark = queries.sparkSession
    asked = queries.select(
        column(query_id).alias("query_id"),
        column(query_vector).cast("array<double>").alias("vector"),
    ).filter(F.col("vector").isNotNull())
    rows = index.rows(spark).filter("cell >= 0")
    # Two numbers for each cell.
    found = {
        r["cell"]: r
        for r in rows.groupBy("cell").agg(F.max("distance").alias("radius"), F.count("*").alias("n")).collect()
    }
    radii = [found[c]["radius"] if c in found else -1.0 for c in range(index.cells)]
    width = index.centres.shape[1]
    stored = rows.select("cell", "id", "vector")
    near = materialise(_cells_of_queries(asked, index, radii, probes), "probed")
    best = tiled_best(near, stored, k, width, tile_bytes)
    if exact:
        best = materialise(best, "probed-best")
        # The k-th row found so far and its distance; with fewer, no bound.
        last = best.filter(F.col("rank") == k).select(
            "query_id",
            F.col("similarity").alias("entry"),
            F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("similarity")) + F.lit(2 * _SLACK)).alias("reach"),
        )
        bounded = asked.join(last, "query_id", "left").withColumn("reach", F.col("reach") + F.lit(_SLACK))
        held = {c: r["n"] for c, r in found.items()}
        most = tile_bytes // (8 * _PART_OF_TILE * max(1, width))
        blocks = _blocks(held, index.cells, min(most, -(-sum(held.values()) // _LEAST_BLOCKS)))
        beyond = materialise(_further_blocks(bounded, index, radii, probes, blocks), "further")
        in_blocks = stored.select(
            of_cell(dict(enumerate(blocks))).alias("cell"), "id", "vector", F.col("cell").alias("part")
        )
        more = tiled_best(beyond, in_blocks, k, width, tile_bytes)
        best = best_of_each(best.drop("rank").unionByName(more.drop("rank")), k)
    return best.withColumnsRenamed({"query_id": query_id})
