"""Numbering and running totals over a whole table.

A window without PARTITION BY moves every row into one task. Here the table is
range-sorted instead, each range is handled by its own task, and only one total
per range is combined at the end.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetforge.functions.columns import column
from facetforge.storage import materialise

# monotonically_increasing_id() keeps the partition above bit 33 and the
# position inside the partition below it.
_POSITION_BITS = 33
_POSITION_MASK = (1 << _POSITION_BITS) - 1


def _range_sorted(df: DataFrame, order_by: Sequence[Column]) -> DataFrame:
    """The table in global order, each row with its range and place in it.

    Written out once: the ranges come from sampling, so both readers below must
    see the same ones even if tasks are repeated.
    """
    placed = df.orderBy(*order_by).withColumn("_slot", F.monotonically_increasing_id())
    stored = materialise(placed, "ordered")
    return stored.withColumn("_range", F.shiftright("_slot", _POSITION_BITS))


def _before_each_range(totals: DataFrame, names: Sequence[str]) -> DataFrame:
    """Totals of all earlier ranges. One row per sort partition, so this window
    (and its broadcast) is bounded by spark.sql.shuffle.partitions."""
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "_range", *[F.sum(n).over(earlier).alias(f"_before_{n}") for n in names]
    )


def number_rows(df: DataFrame, order_by: Sequence[Column], name: str = "row_number") -> DataFrame:
    """Exact row numbers 1, 2, 3, … in the given order; one shuffle.

    The order must be total (end it with a unique key) for stable numbers.
    """
    ordered = _range_sorted(df, order_by)
    counts = ordered.groupBy("_range").agg(F.count("*").alias("_rows"))
    offsets = _before_each_range(counts, ["_rows"])
    position = F.col("_slot").bitwiseAND(F.lit(_POSITION_MASK))
    return (
        ordered.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.coalesce(F.col("_before__rows"), F.lit(0)) + position + F.lit(1))
        .drop("_range", "_slot", "_before__rows")
    )


def running_totals(
    df: DataFrame, order_by: Sequence[Column], totals: Mapping[str, Column]
) -> DataFrame:
    """Add, for each entry, the running sum of a column in the given order.

    The order must be total; NULL adds nothing. Every task of the sort adds up
    its own range while it writes it, batch by batch, so the ordered table is
    not shuffled again and no task holds its range in memory. Reading it, the
    totals of the earlier ranges are added.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    summed = df.limit(0).agg(*[F.sum(c).alias(n) for n, c in totals.items()]).schema
    kinds = [f.dataType for f in summed.fields]
    count, size = len(df.columns), len(totals)
    # Positional names, so that any column name may pass through Arrow.
    names = [f"c{i}" for i in range(count)]
    sums, within = [f"_part_{i}" for i in range(size)], [f"_within_{i}" for i in range(size)]
    # The projection above the sort keeps its order.
    ordered = df.orderBy(*order_by).select(
        *[column(c).alias(n) for c, n in zip(df.columns, names)],
        *[
            F.coalesce(c.cast(k), F.lit(0).cast(k)).alias(n)
            for n, c, k in zip(sums, totals.values(), kinds)
        ],
    )
    schema = T.StructType(
        [
            *ordered.schema.fields,
            *[T.StructField(n, k) for n, k in zip(within, kinds)],
            T.StructField("_range", T.IntegerType()),
        ]
    )
    arrow_kinds = [to_arrow_type(k) for k in kinds]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        so_far = [pa.scalar(0, pa.int64()).cast(k) for k in arrow_kinds]
        for batch in batches:
            if not batch.num_rows:
                continue
            running = [
                pc.cumulative_sum(batch.column(count + i).cast(k), start=so_far[i])
                for i, k in enumerate(arrow_kinds)
            ]
            so_far = [r[-1] for r in running]
            where = pa.array([place] * batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, *running, where], names=schema.names)

    stored = materialise(ordered.mapInArrow(add_up, schema), "ordered")
    ranges = stored.groupBy("_range").agg(*[F.sum(n).alias(n) for n in sums])
    offsets = _before_each_range(ranges, sums)
    joined = stored.join(F.broadcast(offsets), "_range")
    return joined.select(
        *[F.col(n).alias(c) for n, c in zip(names, df.columns)],
        *[
            (F.coalesce(F.col(f"_before_{s}"), F.lit(0)) + F.col(w)).cast(k).alias(n)
            for n, s, w, k in zip(totals, sums, within, kinds)
        ],
    )


def batch_numbers(
    df: DataFrame, order_by: Sequence[Column], batch_size: int = 25, name: str = "batch_no"
) -> DataFrame:
    """Number of the fixed-size batch each row falls into, from 1, exact over the
    whole table. Writers that need only *some* batching chunk their own
    partition instead and pay no sort."""
    numbered = number_rows(df, order_by, "_number")
    before = F.col("_number") - F.lit(1)
    # Taking the remainder off first keeps the division exact for any row count.
    batch = ((before - before % F.lit(batch_size)) / F.lit(batch_size)).cast("bigint") + F.lit(1)
    return numbered.withColumn(name, batch).drop("_number")


def number_copies(df: DataFrame, name: str = "copy_no", run_length: int = 100_000) -> DataFrame:
    """Number equal rows 1..n. The columns must be groupable.

    Equal rows cannot be told apart, so they are counted (with partial counts
    before the shuffle) and written out again from the count. A row with very
    many copies is first cut into runs that are spread over the tasks.
    """
    kept = [column(c) for c in df.columns]
    counted = df.groupBy(*kept).agg(F.count("*").alias("_copies"))
    few = counted.filter(F.col("_copies") <= run_length).select(
        *kept, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))).alias(name)
    )
    run_starts = F.sequence(
        F.lit(1).cast("bigint"), F.col("_copies"), F.lit(run_length).cast("bigint")
    )
    runs = counted.filter(F.col("_copies") > run_length).select(
        *kept, "_copies", F.explode(run_starts).alias("_first")
    )
    last = F.least(F.col("_copies"), F.col("_first") + F.lit(run_length - 1))
    many = runs.repartition(*kept, F.col("_first")).select(
        *kept, F.explode(F.sequence(F.col("_first"), last)).alias(name)
    )
    return few.unionByName(many)
