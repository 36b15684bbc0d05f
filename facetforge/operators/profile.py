"""Table inspection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetforge.functions.columns import column


def profile(df: DataFrame, distinct: str = "exact") -> DataFrame:
    """One row per column: position, type, rows, nulls and distinct values.

    ``distinct="exact"`` shuffles the (pre-aggregated) values of each column;
    ``"approximate"`` keeps a fixed-size sketch and shuffles next to nothing.
    """
    if distinct not in ("exact", "approximate"):
        raise ValueError("distinct must be exact or approximate")
    count_values = F.count_distinct if distinct == "exact" else F.approx_count_distinct
    measures = [F.count("*").alias("rows")]
    for i, name in enumerate(df.columns):
        measures.append(F.count(column(name)).alias(f"filled_{i}"))
        measures.append(count_values(column(name)).alias(f"distinct_{i}"))
    lines = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("column_type"),
                F.col("rows"),
                (F.col("rows") - F.col(f"filled_{i}")).alias("nulls"),
                F.col(f"distinct_{i}").alias("distinct_values"),
            )
            for i, field in enumerate(df.schema.fields)
        ]
    )
    return df.agg(*measures).select(F.inline(lines))


def first_rows(df: DataFrame, n: int, order_by: Sequence[Column] = ()) -> DataFrame:
    """A few rows to look at: any ``n``, or the first in an order (each task then
    keeps only its own first ``n``; the table is not sorted)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
