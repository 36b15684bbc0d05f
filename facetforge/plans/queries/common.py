from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetforge.config import ClassificationTask


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_attributes(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """Order lines with the attributes of their part. Both sides are pruned to
    the columns used; the size of the part side decides the join strategy."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus"
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        "l_linestatus",
        "p_brand",
        "p_type",
        "p_size",
        *extra,
    )


FLAG_TASK = ClassificationTask(
    target="l_returnflag",
    positive="R",
    keys=("l_orderkey", "l_linenumber"),
    features=("l_linestatus", "p_brand", "p_type", "p_size"),
    dataset_type="order-lines",
    positive_name="returned",
    negative_name="kept",
)


def rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines labelled by their flag and "predicted" by their discount."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        (F.col("l_discount") > 0.05).cast("double").alias("prediction"),
    )
