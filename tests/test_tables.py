import pytest

from facetforge.config import ClassificationTask
from facetforge.operators.encoding import feature_columns
from facetforge.operators.profile import first_rows, profile
from facetforge.sources import attach_header, publish, read_headed_csv


def test_headed_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text("class,cap-shape,bruises,n\np,x,t,1\ne,?,f,2\np,,t,3\n")
    df = read_headed_csv(spark, str(tmp_path / "t.csv"))
    assert dict(df.dtypes) == {"class": "string", "cap-shape": "string", "bruises": "string", "n": "int"}
    # An empty cell is NULL; a question mark is an ordinary value.
    assert [r["cap-shape"] for r in df.orderBy("n").collect()] == ["x", "?", None]
    assert set(dict(read_headed_csv(spark, str(tmp_path / "t.csv"), infer=False).dtypes).values()) == {"string"}


def test_headed_csv_loses_no_field(spark, tmp_path):
    path = tmp_path / "t.csv"
    for text in ("a,b\n1,2,3\n", "a,b\n1\n", "a,b\n1,2\nx,4\n"):
        path.write_text(text)
        with pytest.raises(Exception, match="(?i)malformed|cannot parse|input string"):
            read_headed_csv(spark, str(path), schema="a int, b int").select("a").collect()
        kept = read_headed_csv(spark, str(path), schema="a int, b int", corrupt_column="bad").collect()
        assert [r["bad"] for r in kept if r["bad"]] == [text.strip().split("\n")[-1]]


def test_headed_csv_goes_by_names(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c\n1,2,3\n")
    read = read_headed_csv(spark, str(path), schema="b int, a int")
    assert [tuple(r) for r in read.collect()] == [(2, 1)] and read.columns == ["b", "a"]
    with pytest.raises(ValueError, match="no column d"):
        read_headed_csv(spark, str(path), schema="a int, d int")


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,2\n")
    (tmp_path / "two.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_headed_csv(spark, str(tmp_path), schema="a int, b int").collect()


def test_headerless_ingest_keeps_every_row(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for i in range(3):
        (raw / f"part{i}.data").write_text("p,x,s\ne,b,y\n")
    named = attach_header(spark, str(raw), ["class", "cap-shape", "cap-surface"])
    publish(named, str(tmp_path / "out"))
    again = read_headed_csv(spark, str(tmp_path / "out"))
    assert again.count() == 6 and again.columns == ["class", "cap-shape", "cap-surface"]


def test_headerless_ingest_refuses_ragged_rows(spark, tmp_path):
    (tmp_path / "raw").write_text("p,x,s\ne,b,y,extra\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        attach_header(spark, str(tmp_path / "raw"), ["a", "b", "c"]).collect()


def test_publish_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    publish(spark.range(10), path, "parquet")
    publish(spark.range(3), path, "parquet")
    assert spark.read.parquet(path).count() == 3


def test_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3)], "x string, `y.z` int")
    rows = {r["column_name"]: r.asDict() for r in profile(df).collect()}
    assert rows["x"]["nulls"] == 1 and rows["x"]["distinct_values"] == 1
    assert rows["y.z"]["nulls"] == 1 and rows["y.z"]["distinct_values"] == 2
    assert {r["rows"] for r in rows.values()} == {3}
    assert [r["distinct_values"] for r in profile(df, "approximate").collect()] == [1, 2]
    assert [r["rows"] for r in profile(df.filter("false")).collect()] == [0, 0]


def test_feature_columns(spark):
    df = spark.createDataFrame([(1, "p", "x", "y")], "k int, class string, a string, b string")
    assert feature_columns(df, ClassificationTask("class", "p", keys=("k",))) == ["a", "b"]
    assert feature_columns(df, ClassificationTask("class", "p", features=("b",))) == ["b"]


def test_names_of_the_job_are_refused(spark):
    df = spark.createDataFrame([("p", "x")], "class string, weight string")
    with pytest.raises(ValueError, match="weight"):
        feature_columns(df, ClassificationTask("class", "p"))


def test_first_rows(spark):
    df = spark.range(100).repartition(5)
    assert first_rows(df, 3).count() == 3
    assert [r[0] for r in first_rows(df, 3, [df.id.desc()]).collect()] == [99, 98, 97]
