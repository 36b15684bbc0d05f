"""Scans, publication and inspection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetforge.config import ClassificationTask
from facetforge.operators.encoding import feature_columns
from facetforge.operators.profile import first_rows, profile
from facetforge.plans.queries.common import table
from facetforge.sources import attach_header, publish, read_headed_csv
from facetforge.storage import fresh_path


def csv_scan_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "customer-csv")
    publish(table(spark, sf_dir, "customer"), path)
    return read_headed_csv(spark, path)


def csv_scan_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    path = fresh_path(spark, "orders-csv")
    publish(orders, path)
    return read_headed_csv(spark, path, schema=orders.schema)


def csv_reordered_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns are found by their names, whatever the order of the schema."""
    customers = table(spark, sf_dir, "customer")
    path = fresh_path(spark, "reordered-csv")
    publish(customers.select("c_acctbal", "c_nationkey", "c_name", "c_custkey"), path)
    return read_headed_csv(spark, path, schema="c_custkey bigint, c_name string, c_acctbal double")


def csv_corrupt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a field too many or a word for a number are kept as text."""
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    line = (
        F.when(F.col("c_nationkey") % 5 == 0, F.concat_ws(",", key, name, F.lit("extra")))
        .when(F.col("c_nationkey") % 5 == 1, F.concat_ws(",", F.lit("none"), name))
        .otherwise(F.concat_ws(",", key, name))
    )
    path = fresh_path(spark, "corrupt-csv")
    # One column whose name is the header line; a tab separates nothing.
    lines = table(spark, sf_dir, "customer").select(line.alias("c_custkey,c_name"))
    lines.write.option("header", True).option("sep", "\t").csv(path)
    rows = read_headed_csv(
        spark, path, schema="c_custkey bigint, c_name string", corrupt_column="corrupt"
    )
    corrupt = F.col("corrupt")
    return rows.select(
        F.when(corrupt.isNull(), F.col("c_custkey")).alias("c_custkey"),
        F.when(corrupt.isNull(), F.col("c_name")).alias("c_name"),
        "corrupt",
    )


def headerless_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    raw, headed = fresh_path(spark, "raw"), fresh_path(spark, "headed")
    customers.write.option("header", False).csv(raw)
    publish(attach_header(spark, raw, customers.columns), headed)
    return read_headed_csv(spark, headed, infer=False)


def publish_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = fresh_path(spark, "published")
    publish(orders, path, "parquet")
    publish(orders.filter(F.col("o_orderstatus") == "O"), path, "parquet", ["o_orderpriority"])
    return spark.read.schema(orders.schema).parquet(path)


def publish_self(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table published, and then published again from what is left of itself."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = fresh_path(spark, "published")
    publish(orders, path, "parquet")
    publish(spark.read.parquet(path).filter(F.col("o_orderstatus") != "O"), path, "parquet")
    return spark.read.schema(orders.schema).parquet(path)


def profile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(table(spark, sf_dir, "orders"))


def feature_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    task = ClassificationTask(target="p_type", positive="LARGE", keys=("p_partkey",))
    return profile(part.select(*feature_columns(part, task)))


def first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return first_rows(orders, 10, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


QUERIES = {
    "csv_scan_infer": csv_scan_infer,
    "csv_scan_schema": csv_scan_schema,
    "csv_reordered_header": csv_reordered_header,
    "csv_corrupt_rows": csv_corrupt_rows,
    "headerless_ingest": headerless_ingest,
    "publish_overwrite": publish_overwrite,
    "publish_self": publish_self,
    "profile_table": profile_table,
    "feature_profile": feature_profile,
    "first_orders": first_orders,
}


def _profile_sql(name: str, columns: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{column}' AS column_name, "
        f"'{type_}' AS column_type, count(*) AS rows, "
        f"count(*) - count({column}) AS nulls, count(DISTINCT {column}) AS distinct_values "
        f"FROM {name}"
        for i, (column, type_) in enumerate(columns, start=1)
    )


SQL = {
    "first_orders": """
        SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
    """,
    "csv_scan_infer": """
        SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name,
               CAST(c_nationkey AS INTEGER) AS c_nationkey, c_acctbal, c_mktsegment
        FROM customer
    """,
    "csv_reordered_header": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "csv_corrupt_rows": """
        SELECT CASE WHEN c_nationkey % 5 > 1 THEN c_custkey END AS c_custkey,
               CASE WHEN c_nationkey % 5 > 1 THEN c_name END AS c_name,
               CASE c_nationkey % 5 WHEN 0 THEN c_custkey || ',' || c_name || ',extra'
                                    WHEN 1 THEN 'none,' || c_name END AS corrupt
        FROM customer
    """,
    "csv_scan_schema": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders
    """,
    "headerless_ingest": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
               CAST(c_nationkey AS VARCHAR) AS c_nationkey,
               CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
        FROM customer
    """,
    "publish_overwrite": """
        SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'O'
    """,
    "publish_self": """
        SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'O'
    """,
    "profile_table": _profile_sql(
        "orders",
        [
            ("o_orderkey", "bigint"),
            ("o_custkey", "bigint"),
            ("o_orderstatus", "string"),
            ("o_totalprice", "double"),
            ("o_orderdate", "timestamp_ntz"),
            ("o_orderpriority", "string"),
        ],
    ),
    "feature_profile": _profile_sql(
        "part",
        [
            ("p_name", "string"),
            ("p_brand", "string"),
            ("p_size", "int"),
            ("p_retailprice", "double"),
        ],
    ),
}
