import json
from pathlib import Path

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from facetforge.config import ClassificationTask, DeliveryPolicy
from facetforge.operators.delivery import (
    chunks,
    deliver,
    delivery_progress,
    delivery_totals,
    failed_documents,
    is_loaded,
    load_documents,
    loaded_tags,
    open_store,
    replay,
    send_batches,
    split_documents,
    write_dead_letters,
    write_fallback,
)
from facetforge.operators.documents import vector_documents
from facetforge.sources.document_store import DocumentStoreSource
from facetforge.storage import fresh_path, shared_folder
from store_clients import FolderStore

TASK = ClassificationTask("class", "p", keys=("k",), dataset_type="docs")
QUICK = DeliveryPolicy(backoff_ms=0, pause_ms=0)


def documents(spark, n, task=TASK, **kwargs):
    scored = spark.createDataFrame(
        [(i, Vectors.sparse(3, {i % 3: 1.0}), float(i % 2)) for i in range(n)],
        ["k", "features", "prediction"],
    )
    return vector_documents(scored, task, created_at_ms=1, **kwargs)


def load(docs, base, run="r", **kwargs):
    return load_documents(docs, f"{base}/store", f"{base}/fallback", f"{base}/dead", "docs", run, **kwargs)


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_document_fields(spark):
    rows = {r["id"]: r for r in documents(spark, 4).collect()}
    assert len(rows) == 4
    assert {(tuple(r["features"]), r["prediction"], r["predicted_class"]) for r in rows.values()} == {
        ((1, 0, 0), 0.0, "negative"), ((0, 1, 0), 1.0, "positive"),
        ((0, 0, 1), 0.0, "negative"), ((1, 0, 0), 1.0, "positive"),
    }
    assert set(rows) == {r["id"] for r in documents(spark, 4).collect()}


def test_ids_without_keys_tell_copies_apart(spark):
    task = ClassificationTask("class", "p", dataset_type="docs")
    ids = [r["id"] for r in documents(spark, 24, task).collect()]
    assert len(set(ids)) == 24
    assert sorted(ids) == sorted(r["id"] for r in documents(spark, 24, task).collect())
    random_ids = {r["id"] for r in documents(spark, 24, TASK, id_mode="random").collect()}
    assert len(random_ids) == 24 and not random_ids & set(ids)


@pytest.mark.parametrize("n, loaded", [(10, False), (11, True)])
def test_guard_edge(spark, n, loaded):
    docs = documents(spark, n)
    assert is_loaded(docs, "docs") is loaded
    assert not is_loaded(docs, "other")
    assert loaded_tags(docs).first()["loaded"] is loaded


def test_missing_store_is_empty_but_a_broken_one_fails(spark, tmp_path):
    assert open_store(spark, str(tmp_path / "nothing")).count() == 0
    (tmp_path / "part-0.parquet").write_text("not parquet at all")
    with pytest.raises(Exception, match="(?i)parquet"):
        is_loaded(open_store(spark, str(tmp_path)), "docs")


def test_rerun_adds_nothing_and_interrupted_load_is_completed(spark):
    base = fresh_path(spark, "rerun")
    docs = documents(spark, 60)
    assert load(docs.limit(20), base, when_present="resume").written == 20
    assert load(docs, base, when_present="resume").written == 40
    assert load(docs, base, when_present="resume").written == 0
    stored = open_store(spark, f"{base}/store")
    assert stored.count() == 60 and stored.select("id").distinct().count() == 60


def test_loaded_tag_is_diverted(spark):
    base = fresh_path(spark, "divert")
    assert load(documents(spark, 30), base).status == "loaded"
    result = load(documents(spark, 30), base)
    assert (result.status, result.written) == ("diverted", 30)
    assert open_store(spark, f"{base}/store").count() == 30
    assert replay(spark, f"{base}/fallback").count() == 30


def test_no_store_goes_to_the_fallback(spark):
    base = fresh_path(spark, "nostore")
    result = load_documents(documents(spark, 7), None, f"{base}/fb", f"{base}/dead", "docs", "r")
    assert (result.status, result.written) == ("diverted", 7)


def test_failed_load_falls_back_and_raises(spark):
    base = fresh_path(spark, "failed")
    docs = documents(spark, 12)
    bomb = F.when(F.col("prediction") > 0, F.raise_error(F.lit("boom")))
    with pytest.raises(Exception, match="boom"):
        load(docs, base, problem=bomb.cast("string"))
    assert replay(spark, f"{base}/fallback").count() == 12


def test_bad_rows_are_dead_lettered_and_can_be_replayed(spark):
    base = fresh_path(spark, "dead")
    docs = documents(spark, 50).withColumn(
        "prediction", F.when(F.col("prediction") == 1, F.lit(float("nan"))).otherwise(F.col("prediction"))
    )
    result = load(docs, base, run="one")
    assert (result.written, result.dead_lettered) == (25, 25)
    again = load(docs, base, run="two", when_present="resume")
    assert (again.written, again.dead_lettered) == (0, 25)
    dead = spark.read.json(f"{base}/dead")
    assert dead.groupBy("run_id").count().count() == 2
    assert {r[0] for r in dead.select("error").distinct().collect()} == {"missing prediction"}
    mended = replay(spark, f"{base}/dead/run_id=one").withColumn("prediction", F.lit(1.0))
    assert load(mended, base, when_present="resume").written == 25
    stored = open_store(spark, f"{base}/store")
    assert stored.count() == 50
    assert stored.filter(F.size("features") == 3).count() == 50


def test_documents_of_another_tag_are_dead_lettered(spark):
    base = fresh_path(spark, "tags")
    other = ClassificationTask("class", "p", keys=("k",), dataset_type="others")
    mixed = documents(spark, 20).unionByName(documents(spark, 5, other))
    for written in (20, 0):
        result = load(mixed, base, when_present="resume")
        assert (result.written, result.dead_lettered) == (written, 5)
    back = replay(spark, f"{base}/dead")
    assert back.columns == documents(spark, 1).columns
    assert {r[0] for r in back.select("dataset_type").distinct().collect()} == {"others"}


@pytest.mark.parametrize("tag", ["7", "a/b=c:d%", "größe [x] 'y' \"z\"", "tab\there"])
def test_any_tag_can_be_stored_and_found_again(spark, tag):
    base = fresh_path(spark, "tag")
    docs = documents(spark, 15, ClassificationTask("class", "p", keys=("k",), dataset_type=tag))

    def store():
        return load_documents(docs, f"{base}/store", f"{base}/fb", f"{base}/dead", tag, tag, when_present="resume")

    assert (store().written, store().written) == (15, 0)
    assert sorted(map(tuple, open_store(spark, f"{base}/store").collect())) == sorted(map(tuple, docs.collect()))


def test_split_is_complete(spark):
    docs = documents(spark, 10).withColumn("features", F.when(F.col("prediction") == 1, F.col("features")))
    good, bad = split_documents(docs)
    assert good.columns == docs.columns
    assert good.count() == 5 and {r["error"] for r in bad.collect()} == {"missing features"}


def test_fallback_keeps_vectors_and_special_numbers(spark):
    path = fresh_path(spark, "fallback")
    docs = documents(spark, 3).withColumn("prediction", F.lit(float("inf")))
    write_fallback(docs, path, "one")
    back = replay(spark, path)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)
    write_fallback(docs, path, "two")
    assert replay(spark, path).count() == 6


def test_runs_diverted_to_one_fallback_keep_their_documents(spark):
    base = fresh_path(spark, "runs")
    load(documents(spark, 30), base)
    load(documents(spark, 25), base, run="one")
    load(documents(spark, 20), base, run="two")
    assert replay(spark, f"{base}/fallback/run_id=one").count() == 25
    assert replay(spark, f"{base}/fallback/run_id=two").count() == 20


def test_replay_into_its_own_fallback_deletes_nothing(spark):
    base = fresh_path(spark, "own")
    load(documents(spark, 30), base)
    load(documents(spark, 30), base, run="one")
    back = replay(spark, f"{base}/fallback")
    assert load(back, base, run="two").status == "diverted"
    assert replay(spark, f"{base}/fallback/run_id=one").count() == 30
    assert load(back, base, run="three", when_present="resume").written == 0


def test_broken_stores_leave_a_fallback(spark, tmp_path):
    base = fresh_path(spark, "broken")
    docs = documents(spark, 12)
    store = tmp_path / "store" / "dataset_type=docs"
    store.mkdir(parents=True)
    (store / "part-0.parquet").write_text("not parquet at all")
    for run, path in (("one", str(tmp_path / "store")), ("two", "nosuchscheme://x/store")):
        with pytest.raises(Exception):
            load_documents(docs, path, f"{base}/fallback", f"{base}/dead", "docs", run)
        assert replay(spark, f"{base}/fallback/run_id={run}").count() == 12


def test_one_document_of_each_id_is_stored(spark):
    base = fresh_path(spark, "duplicates")
    docs = documents(spark, 5)
    result = load(docs.union(docs).union(docs.limit(1)), base)
    assert (result.written, result.dead_lettered, result.duplicates) == (5, 6, 6)
    stored = open_store(spark, f"{base}/store")
    assert stored.count() == 5 and stored.select("id").distinct().count() == 5
    assert {r[0] for r in spark.read.json(f"{base}/dead").select("error").distinct().collect()} == {
        "duplicate id"
    }


def test_outcomes_of_an_earlier_delivery_are_not_replaced(spark, tmp_path):
    path = fresh_path(spark, "outcome")
    folder = str(tmp_path)
    deliver(documents(spark, 3), lambda: FolderStore(folder, lambda d: None), path, QUICK)
    with pytest.raises(Exception, match="(?i)exist"):
        deliver(documents(spark, 3), lambda: FolderStore(folder, lambda d: None), path, QUICK)


def test_chunks():
    assert [len(c) for c in chunks(range(51), 25)] == [25, 25, 1]
    assert list(chunks([], 25)) == []


class Flaky:
    """Refuses each document until its n-th try."""

    def __init__(self, needed):
        self.needed, self.tries, self.calls = needed, {}, []

    def upsert(self, docs):
        self.calls.append([d["id"] for d in docs])
        for d in docs:
            self.tries[d["id"]] = self.tries.get(d["id"], 0) + 1
        return [None if self.tries[d["id"]] >= self.needed.get(d["id"], 1) else "busy" for d in docs]

    def close(self):
        pass


def test_only_refused_documents_are_tried_again():
    client, slept = Flaky({"b": 2, "c": 9}), []
    docs = [{"id": i} for i in "abc"]
    outcome = list(send_batches(docs, client, DeliveryPolicy(), slept.append))
    assert client.calls == [["a", "b", "c"], ["b", "c"], ["c"]]
    assert slept == [2.0, 4.0, 0.1]
    assert (outcome[0].attempts, outcome[0].succeeded) == (3, 2)
    assert outcome[0].failures == [({"id": "c"}, "busy")]


def test_client_errors_count_as_refusals():
    class Broken(Flaky):
        def upsert(self, docs):
            raise ConnectionError("down")

    outcome = list(send_batches([{"id": "a"}], Broken({}), QUICK))
    assert outcome[0].failures == [({"id": "a"}, "ConnectionError: down")]


def test_deliver_reports_every_document(spark, tmp_path):
    docs = documents(spark, 120)
    folder = str(tmp_path)

    def client():
        return FolderStore(folder, lambda d: "full" if d["prediction"] > 0.5 else None)

    outcomes = deliver(docs, client, fresh_path(spark, "outcome"), QUICK, senders=3)
    assert tuple(delivery_totals(outcomes).first())[1:] == (60, 60)
    assert outcomes.filter(F.col("succeeded") + F.col("failed") > 25).count() == 0
    assert outcomes.filter(F.col("attempts") == 3).count() > 0
    assert outcomes.select("task").distinct().count() == 3
    stored = {json.loads(p.read_text())["id"] for p in Path(folder).glob("doc-*")}
    failed = failed_documents(outcomes)
    refused = {r["id"] for r in failed.collect()}
    assert len(stored) == len(refused) == 60 and not stored & refused
    assert failed.columns == [*docs.columns, "error"]
    dead = fresh_path(spark, "dead")
    write_dead_letters(failed, dead, "r1")
    assert replay(spark, dead).count() == 60
    progress = delivery_progress(outcomes, F.lit(120), [F.col("task"), F.col("batch_no")])
    last = progress.orderBy(F.col("done").desc(), F.col("batch_no").desc()).first()
    assert (last["done"], last["percent_done"]) == (60, 50.0)


def test_data_source_writer(spark, tmp_path):
    spark.dataSource.register(DocumentStoreSource)
    docs = documents(spark, 60).repartition(2)

    def write(client):
        return (
            docs.write.format("document_store").mode("append")
            .option("client", f"store_clients:{client}").option("folder", str(tmp_path))
            .option("backoff_ms", 0).option("pause_ms", 0).save()
        )

    write("open_folder")
    write("open_folder")
    assert len(list(tmp_path.glob("doc-*"))) == 60
    assert all(int(p.read_text()) <= 25 for p in tmp_path.glob("call-*"))
    with pytest.raises(Exception, match="refused"):
        write("open_refusing")
