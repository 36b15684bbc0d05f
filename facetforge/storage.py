"""Shared working folder: the place where intermediate tables are written so
that a lost executor never forces the whole lineage to be computed again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
# The parts of the application's folder that new tables go to.
_SCOPES: ContextVar[tuple[str, ...]] = ContextVar("scopes", default=())


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may run without the setting; it gets a temporary
    folder of its own. On a cluster a missing setting is an error, because a
    folder of one machine would not be visible to the executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = _LOCAL_FOLDERS.get(context.applicationId)
    if folder is None:
        folder = tempfile.mkdtemp(prefix="facetforge-")
        _LOCAL_FOLDERS[context.applicationId] = folder
    return folder


def enable_checkpoints(spark: SparkSession) -> None:
    """Give MLlib's periodic checkpoints a directory if they have none yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/facetforge-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path not used before. All paths of one application lie under one
    folder, and those made inside ``temporary_copies`` in a part of it that is
    deleted at the end.
    """
    return "/".join([_application_folder(spark), *_SCOPES.get(), f"{name}-{uuid.uuid4().hex}"])


@contextmanager
def temporary_copies(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that are written inside the block when it ends.

    Results are lazy and may read these tables, so write them elsewhere before.
    Blocks may be nested; each deletes its own.
    """
    scopes = (*_SCOPES.get(), f"scope-{uuid.uuid4().hex}")
    token = _SCOPES.set(scopes)
    try:
        yield
    finally:
        _SCOPES.reset(token)
        delete_folder(spark, "/".join([_application_folder(spark), *scopes]))


def _file_system(spark: SparkSession, path: str):
    java = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return java, java.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    java, files = _file_system(spark, path)
    files.delete(java, True)


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Rename the data files of one folder into another of the same file system.

    Names that Spark gives to files are never used twice, so nothing is replaced.
    """
    start, files = _file_system(spark, source)
    end, _ = _file_system(spark, target)
    files.mkdirs(end)
    for status in files.listStatus(start):
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        place = _file_system(spark, f"{target}/{name}")[0]
        if not files.rename(status.getPath(), place):
            raise OSError(f"could not move {status.getPath()} to {target}")
    files.delete(start, True)


def swap_folder(spark: SparkSession, fresh: str, path: str) -> None:
    """Put the folder ``fresh`` in the place of ``path``. What was there is set
    aside first and deleted last; it comes back if the second rename fails."""
    new, files = _file_system(spark, fresh)
    place, _ = _file_system(spark, path)
    aside = None
    if files.exists(place):
        aside = _file_system(spark, f"{path}._replaced-{uuid.uuid4().hex}")[0]
        if not files.rename(place, aside):
            raise OSError(f"could not set {path} aside")
    if not files.rename(new, place):
        if aside is not None:
            files.rename(aside, place)
        raise OSError(f"could not move {fresh} to {path}")
    if aside is not None:
        files.delete(aside, True)


# Characters that are written as %XX in partition folder names.
_ESCAPED_IN_FOLDERS = "\"#%'*/:=?\\{[]^\x7f"


def partition_folder(path: str, name: str, value: str) -> str:
    """The folder of one partition value below a partitioned table.

    Writing rows of a single value straight into it spares the sort by the
    partition column that a partitioned write makes in every task.
    """
    if not value:
        raise ValueError(f"{name} must not be empty")
    escaped = "".join(
        f"%{ord(c):02X}" if c < " " or c in _ESCAPED_IN_FOLDERS else c for c in value
    )
    return f"{path}/{name}={escaped}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back.

    Unlike an RDD checkpoint the copy is columnar, so later steps still prune
    columns and push filters down. ML column metadata survives.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
