"""Table sources and sinks. Paths may be on any file system Hadoop knows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetforge.functions.columns import column
from facetforge.storage import delete_folder, swap_folder

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("features", T.ArrayType(T.DoubleType())),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("predicted_class", T.StringType()),
        T.StructField("created_at_ms", T.LongType()),
        T.StructField("dataset_type", T.StringType()),
    ]
)


def read_headed_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    infer: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    """CSV with a header row.

    Give ``schema`` for large inputs: inference reads the whole input one extra
    time. ``infer=False`` skips that pass as well and leaves every column a
    string, which is all that categorical encoding needs.

    A given schema is matched to the header by name, in any order; a column that
    no header has is an error, and so are files whose headers differ. Rows that
    do not fit (more or fewer fields, values of another type) fail the read, or
    with ``corrupt_column`` are kept there as text.
    """
    names = spark.read.option("header", True).csv(path).columns
    # Without pruning every field is looked at, whatever is selected later.
    reader = spark.read.option("header", True).option("columnPruning", False)
    wanted = None
    if schema is not None:
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        fields = {f.name: f for f in wanted.fields}
        absent = [n for n in fields if n not in names]
        if absent:
            raise ValueError(f"the header has no column {', '.join(absent)}")
    elif infer and corrupt_column is None:
        return reader.option("mode", "FAILFAST").option("inferSchema", True).csv(path)
    elif infer:
        inferred = reader.option("inferSchema", True).csv(path).schema
        fields = {f.name: f for f in inferred.fields}
    else:
        fields = {}
    found = T.StructType([fields.get(n, T.StructField(n, T.StringType())) for n in names])
    shown = list(wanted.names if wanted is not None else names)
    reader = reader.option("enforceSchema", False)
    if corrupt_column is None:
        table = reader.option("mode", "FAILFAST").schema(found).csv(path)
    else:
        found = found.add(corrupt_column, T.StringType())
        kept = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
        table = kept.schema(found).csv(path)
        shown.append(corrupt_column)
    return table.select(*[column(n) for n in shown])


def attach_header(spark: SparkSession, raw_path: str, names: Sequence[str]) -> DataFrame:
    """Comma file without header, read as strings under the given names."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    # A row with more or fewer fields than names would be cut or filled with
    # NULLs under the default mode; fail instead of losing data.
    return spark.read.schema(schema).option("header", False).option("mode", "FAILFAST").csv(raw_path)


def publish(
    df: DataFrame, path: str, format: str = "csv", partition_by: Sequence[str] = ()
) -> int:
    """Replace the table at ``path``; CSV output carries a header in every file.
    Returns the number of rows.

    The table is written beside ``path`` and its rows are counted there; only then
    it takes the place of the old one. A job that fails leaves the old table, and
    a table may be published from itself. Between two renames there is no table
    for a moment; where a store has no renames, readers should not read meanwhile.
    """
    spark = df.sparkSession
    fresh = f"{path.rstrip('/')}._fresh-{uuid.uuid4().hex}"
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(format)
    if format == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.save(fresh)
        rows = seen.get.get("rows", 0)
        if df.columns and rows:
            # A row of CSV may span lines.
            csv = {"header": True, "multiLine": True} if format == "csv" else {}
            reader = spark.read.format(format).options(**csv)
            found = reader.schema(df.schema).load(fresh).count()
            if found != rows:
                raise RuntimeError(f"{found} of {rows} rows were written")
        swap_folder(spark, fresh, path.rstrip("/"))
    except Exception:
        delete_folder(spark, fresh)
        raise
    return rows


def read_documents(spark: SparkSession, path: str | Sequence[str], format: str = "json") -> DataFrame:
    """Stored, diverted or dead-lettered documents, ready to be loaded again."""
    documents = spark.read.schema(DOCUMENT_SCHEMA).format(format).load(path)
    # Leaves out folder columns such as the run of a dead letter.
    return documents.select(*DOCUMENT_SCHEMA.names)
