"""What the text operators share."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The white space that separates words and surrounds lines, as a pattern for
# Spark and as bytes for Python.
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"


def spare_name(df: DataFrame, stem: str, taken: Iterable[str] = ()) -> str:
    """``stem``, lengthened until no column of ``df`` has that name in any case."""
    used = {c.lower() for c in [*df.columns, *taken]}
    name = stem
    while name.lower() in used:
        name += "_"
    return name


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(schema: T.StructType, names: Iterable[str]) -> list[T.StructField]:
    """Fields whose names differ, in any case, from all of ``names``."""
    gone = {n.lower() for n in names}
    return [f for f in schema.fields if f.name.lower() not in gone]


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """The table with columns named like any of ``names``, in any case, under
    spare names, and the spare name of each column by its own."""
    names = list(names)
    taken = {n.lower() for n in names}
    renamed: dict[str, str] = {}
    for c in df.columns:
        renamed[c] = spare_name(df, f"_own_{c}", renamed.values()) if c.lower() in taken else c
    return df.select(*[quoted(c).alias(n) for c, n in renamed.items()]), renamed


def plain_text(text: str) -> Column:
    """The text column as a string that is never NULL."""
    return F.coalesce(quoted(text).cast("string"), F.lit(""))


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; NULL is empty."""
    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]


def as_text(column: pa.Array) -> list[str]:
    """Strings of a column; NULL is empty."""
    return ["" if v is None else v for v in column.to_pylist()]


def map_in_arrow(df: DataFrame, function, schema: T.StructType) -> DataFrame:
    """``df.mapInArrow`` for any column names; the function goes by position."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(function, schema)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row.

    Inside a higher-order function a plain reference to an expression would be
    computed again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
