from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.ml.linalg import VectorUDT

from facetforge.operators.boosting import prepare_training
from facetforge.config import ClassificationTask
from facetforge.storage import fresh_path, materialise, shared_folder, temporary_copies


def session(master, setting):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: setting or default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"{master}-{setting}"),
    )


def test_configured_folder_wins_everywhere():
    for master in ("local[2]", "spark://host:7077"):
        assert shared_folder(session(master, "hdfs:///shared/")) == "hdfs:///shared"


def test_cluster_without_setting_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn", None))


def test_local_session_without_setting_keeps_one_folder():
    local = session("local[2]", None)
    assert shared_folder(local) == shared_folder(local)
    assert fresh_path(local, "x") != fresh_path(local, "x")


def test_materialised_table_keeps_vectors_and_their_metadata(spark):
    df = spark.createDataFrame([("p", "x", "y"), ("e", "z", "y")], "class string, a string, b string")
    rows = prepare_training(df, ClassificationTask("class", "p")).rows
    stored = materialise(rows, "vectors")
    assert isinstance(stored.schema["features"].dataType, VectorUDT)
    assert stored.schema["features"].metadata == rows.schema["features"].metadata != {}
    assert sorted(map(str, stored.collect())) == sorted(map(str, rows.collect()))


def test_copies_of_a_block_are_deleted_at_its_end(spark):
    def copies():
        return {p for p in Path(shared_folder(spark)).rglob("*.parquet")}

    before = copies()
    with temporary_copies(spark):
        outer = materialise(spark.range(3), "outer")
        with pytest.raises(KeyError), temporary_copies(spark):
            inner = materialise(spark.range(5), "inner")
            assert inner.count() == 5
            raise KeyError
        assert outer.count() == 3
    assert copies() == before
    with temporary_copies(spark):
        pass
