"""Labels, vocabularies and encodings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetforge.config import ClassificationTask
from facetforge.functions.columns import binary_label
from facetforge.operators.documents import long_vectors, vector_entries
from facetforge.operators.encoding import (
    category_counts,
    encode,
    encode_rows,
    encoder,
    fit_vocabulary,
    one_hot_positions,
    with_label,
)
from facetforge.plans.queries.common import table

PART_ATTRIBUTES = ("p_brand", "p_type", "p_size")
# A limit below the size of o_custkey makes a query take the distributed ways.
SMALL_LIMIT = 100


def label_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    task = ClassificationTask("l_returnflag", "R")
    return with_label(table(spark, sf_dir, "lineitem"), task).select(
        "l_orderkey", "l_linenumber", "l_returnflag", "label"
    )


def label_null_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.nullif(F.col("l_returnflag"), F.lit("N"))
    lines = table(spark, sf_dir, "lineitem").select(
        *[binary_label(target, "R", mode).alias(mode) for mode in ("keep", "negative")]
    )
    return lines.groupBy("keep", "negative").agg(
        F.count("*").alias("rows"), F.count("keep").alias("rows_after_drop")
    )


def category_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return category_counts(lines, ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity"])


def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", *PART_ATTRIBUTES)
    model = encoder(part, fit_vocabulary(part, PART_ATTRIBUTES))
    return model.transform(part.withColumn("p_size", F.col("p_size").cast("string"))).select(
        "p_partkey", *[f"{a}_indexed" for a in PART_ATTRIBUTES]
    )


def category_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_vocabulary(table(spark, sf_dir, "part"), PART_ATTRIBUTES).table


def category_ranking_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    attributes = ["o_orderpriority", "o_custkey"]
    return fit_vocabulary(orders, attributes, local_limit=SMALL_LIMIT).table


def one_hot_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return one_hot_positions(part, ["p_partkey"], fit_vocabulary(part, PART_ATTRIBUTES))


def one_hot_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    attributes = ["o_orderpriority", "o_custkey"]
    vocabulary = fit_vocabulary(orders, attributes, local_limit=SMALL_LIMIT)
    return one_hot_positions(orders, ["o_orderkey"], vocabulary)


def assembled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", *PART_ATTRIBUTES)
    model = encoder(part, fit_vocabulary(part, PART_ATTRIBUTES))
    encoded = encode(part, model, PART_ATTRIBUTES, ["p_partkey", "features"])
    return long_vectors(encoded, "p_partkey")


def assembled_features_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors over a vocabulary above the limit for label lists."""
    orders = table(spark, sf_dir, "orders")
    attributes = ["o_orderpriority", "o_custkey"]
    vocabulary = fit_vocabulary(orders, attributes, local_limit=SMALL_LIMIT)
    return vector_entries(encode_rows(orders, vocabulary, ["o_orderkey"]), "o_orderkey")


def unseen_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the smaller parts, applied to all: larger sizes are unseen."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    attributes = ("p_brand", "p_size")
    model = encoder(part, fit_vocabulary(part.filter(F.col("p_size") < 40), attributes))
    encoded = encode(part, model, attributes, ["p_partkey", "features"])
    return long_vectors(encoded, "p_partkey")


QUERIES = {
    "label_derive": label_derive,
    "label_null_modes": label_null_modes,
    "category_frequency": category_frequency,
    "category_index": category_index,
    "category_ranking": category_ranking,
    "category_ranking_distributed": category_ranking_distributed,
    "one_hot_long": one_hot_long,
    "one_hot_distributed": one_hot_distributed,
    "assembled_features": assembled_features,
    "assembled_features_large": assembled_features_large,
    "unseen_category": unseen_category,
}


def _counts_sql(source: str, attributes: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS attribute, CAST({a} AS VARCHAR) AS category, count(*) AS n "
        f"FROM {source} WHERE {a} IS NOT NULL GROUP BY {a}"
        for a in attributes
    )


def _ranking_sql(source: str, attributes: list[str]) -> str:
    return (
        "SELECT attribute, category, n, row_number() OVER "
        "(PARTITION BY attribute ORDER BY n DESC, category ASC) - 1 AS idx "
        f"FROM ({_counts_sql(source, attributes)})"
    )


def _positions_sql(source: str, key: str, attributes: list[str], fitted_on: str | None = None) -> str:
    """WITH clauses: vocab (attribute, category, pos) and ones (key, attribute, pos)."""
    order = ", ".join(f"('{a}', {i})" for i, a in enumerate(attributes))
    rows = " UNION ALL ".join(
        f"SELECT {key}, '{a}' AS attribute, CAST({a} AS VARCHAR) AS category FROM {source}"
        for a in attributes
    )
    return f"""
        WITH ranked AS ({_ranking_sql(fitted_on or source, attributes)}),
        place AS (SELECT * FROM (VALUES {order}) AS t(attribute, nth)),
        sizes AS (SELECT attribute, nth, count(*) AS size
                  FROM ranked JOIN place USING (attribute) GROUP BY ALL),
        starts AS (SELECT attribute, coalesce(sum(size) OVER
                   (ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
                   FROM sizes),
        vocab AS (SELECT attribute, category, CAST(first + idx AS BIGINT) AS pos
                  FROM ranked JOIN starts USING (attribute)),
        ones AS (SELECT {key}, attribute, pos FROM ({rows}) JOIN vocab USING (attribute, category))
    """


def _matrix_sql(source: str, key: str, attributes: list[str], fitted_on: str | None = None) -> str:
    return (
        _positions_sql(source, key, attributes, fitted_on)
        + f"""
        SELECT r.{key}, CAST(v.pos AS INTEGER) AS pos,
               CASE WHEN o.pos IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS value
        FROM {source} r CROSS JOIN vocab v
        LEFT JOIN ones o ON o.{key} = r.{key} AND o.pos = v.pos
        """
    )


def _index_sql(attribute: str) -> str:
    return (
        f"SELECT {attribute} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, "
        f"CAST({attribute} AS VARCHAR)) - 1 AS DOUBLE) AS i FROM part GROUP BY 1"
    )


SQL = {
    "label_derive": """
        SELECT l_orderkey, l_linenumber, l_returnflag,
               CAST(l_returnflag = 'R' AS DOUBLE) AS label
        FROM lineitem
    """,
    "label_null_modes": """
        SELECT CAST(nullif(l_returnflag, 'N') = 'R' AS DOUBLE) AS keep,
               coalesce(CAST(nullif(l_returnflag, 'N') = 'R' AS DOUBLE), 0.0) AS negative,
               count(*) AS rows, count(nullif(l_returnflag, 'N')) AS rows_after_drop
        FROM lineitem GROUP BY 1, 2
    """,
    "category_frequency": _counts_sql(
        "lineitem", ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity"]
    ),
    "category_index": f"""
        SELECT p_partkey, b.i AS p_brand_indexed, t.i AS p_type_indexed, s.i AS p_size_indexed
        FROM part
        JOIN ({_index_sql("p_brand")}) b ON p_brand = b.v
        JOIN ({_index_sql("p_type")}) t ON p_type = t.v
        JOIN ({_index_sql("p_size")}) s ON p_size = s.v
    """,
    "category_ranking": _ranking_sql("part", list(PART_ATTRIBUTES)),
    "category_ranking_distributed": _ranking_sql("orders", ["o_orderpriority", "o_custkey"]),
    "one_hot_long": _positions_sql("part", "p_partkey", list(PART_ATTRIBUTES)) + "SELECT * FROM ones",
    "one_hot_distributed": _positions_sql("orders", "o_orderkey", ["o_orderpriority", "o_custkey"])
    + "SELECT * FROM ones",
    "assembled_features_large": _positions_sql(
        "orders", "o_orderkey", ["o_orderpriority", "o_custkey"]
    )
    + "SELECT o_orderkey, CAST(pos AS INTEGER) AS pos, 1.0::DOUBLE AS value FROM ones",
    "assembled_features": _matrix_sql("part", "p_partkey", list(PART_ATTRIBUTES)),
    "unseen_category": _matrix_sql(
        "part",
        "p_partkey",
        ["p_brand", "p_size"],
        "(SELECT * FROM part WHERE p_size < 40) AS fitted",
    ),
}
