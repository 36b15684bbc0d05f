"""Scored rows as vector documents."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetforge.config import ClassificationTask
from facetforge.functions.columns import class_name, column, document_id, epoch_ms_now
from facetforge.operators.ordering import number_copies


def feature_array(df: DataFrame, name: str = "features") -> Column:
    """The feature column as array<double>, whether it is an ML vector or not."""
    if isinstance(df.schema[name].dataType, VectorUDT):
        return vector_to_array(column(name))
    return column(name).cast("array<double>")


def vector_documents(
    scored: DataFrame,
    task: ClassificationTask,
    created_at_ms: int | None = None,
    id_mode: str | None = None,
) -> DataFrame:
    """Project rows with features and prediction to the six document fields.

    ``id_mode``
      "key"      hash of tag and key columns; no shuffle (default with keys)
      "content"  hash of tag, features, prediction and the number of the copy;
                 shuffles the rows (default without keys)
      "random"   a new id on every run; reloading then makes duplicates
    ``created_at_ms`` fixes the time stamp of the batch; default is now.
    """
    mode = id_mode or ("key" if task.keys else "content")
    if mode == "key" and not task.keys:
        raise ValueError("id_mode='key' needs key columns")
    keys = [column(k).alias(f"_key_{i}") for i, k in enumerate(task.keys)] if mode == "key" else []
    rows = scored.select(
        *keys, feature_array(scored).alias("features"), column("prediction").cast("double").alias("prediction")
    )
    if mode == "key":
        id_ = document_id(task.dataset_type, *[F.col(f"_key_{i}") for i in range(len(keys))])
    elif mode == "content":
        rows = number_copies(rows)
        id_ = document_id(
            task.dataset_type,
            F.to_json(F.struct("features", "prediction"), {"ignoreNullFields": "false"}),
            F.col("copy_no"),
        )
    elif mode == "random":
        id_ = F.uuid()
    else:
        raise ValueError(f"unknown id_mode {mode!r}")
    stamp = F.lit(created_at_ms).cast("bigint") if created_at_ms is not None else epoch_ms_now()
    return rows.select(
        id_.alias("id"),
        "features",
        "prediction",
        class_name(F.col("prediction"), task.negative_name, task.positive_name).alias("predicted_class"),
        stamp.alias("created_at_ms"),
        F.lit(task.dataset_type).alias("dataset_type"),
    )


def long_vectors(df: DataFrame, key: str, vector: str = "features", name: str = "value") -> DataFrame:
    """(key, pos, value): one row per vector element."""
    return df.select(column(key), F.posexplode(feature_array(df, vector)).alias("pos", name))


# How an ML vector is stored: type 0 is sparse, type 1 dense with values only.
_STORED_VECTOR = "v struct<type:int,size:int,indices:array<int>,values:array<double>>"


def vector_entries(df: DataFrame, key: str, vector: str = "features", name: str = "value") -> DataFrame:
    """(key, pos, value): one row per element that is not zero. A sparse vector
    costs its entries only, however wide it is. NULL vectors have none."""
    if not isinstance(df.schema[vector].dataType, VectorUDT):
        return long_vectors(df, key, vector, name).filter(F.col(name) != 0)
    # Spark has no expression that opens a sparse vector; its JSON does.
    stored = F.from_json(F.to_json(F.struct(column(vector).alias("v"))), _STORED_VECTOR)["v"]
    opened = df.select(column(key), stored.alias("_stored")).filter("_stored IS NOT NULL")
    values = F.col("_stored.values")
    count = F.size(values)
    places = F.when(F.col("_stored.type") == 0, F.col("_stored.indices")).when(
        count > 0, F.sequence(F.lit(0), count - 1)
    )
    entries = F.arrays_zip(places.alias("pos"), values.alias(name))
    return opened.select(column(key), F.inline(entries)).filter(F.col(name) != 0)
