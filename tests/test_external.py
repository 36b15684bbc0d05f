import threading
import time

import pytest
from pyspark.sql import functions as F

from facetforge.config import DeliveryPolicy
from facetforge.operators.delivery import deliver, load_documents, open_store, replay
from facetforge.operators.external import deliver_documents, deliver_staged, missing_in_store
from facetforge.operators.replays import read_ledger, replay_once
from facetforge.sources import publish
from facetforge.sources.document_store import DocumentStoreSource
from facetforge.sources.tables import DOCUMENT_SCHEMA
from store_clients import StagingStore

FAST = DeliveryPolicy(backoff_ms=0, pause_ms=0)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "store").mkdir()
    return tmp_path / "store"


def documents(spark, numbers, tag="t"):
    rows = [(f"d{i}", [float(i)], (i % 4) / 4, "c", 1, tag) for i in numbers]
    return spark.createDataFrame(rows, DOCUMENT_SCHEMA).repartition(3)


def held(folder):
    return sorted(f.name[4:] for f in folder.glob("doc-*"))


def places(tmp_path):
    return [str(tmp_path / n) for n in ("outcomes", "fallback", "dead")]


def test_resume_sends_only_what_is_missing(spark, folder, tmp_path):
    open_client = lambda: StagingStore(folder)
    first = deliver_documents(documents(spark, range(30)), open_client, *places(tmp_path / "a"), "t", "r1", policy=FAST)
    assert (first.status, first.sent, first.failed, first.present) == ("delivered", 30, 0, 0)
    before = len(list(folder.glob("look-*")))
    second = deliver_documents(
        documents(spark, range(50)), open_client, *places(tmp_path / "b"), "t", "r2", "resume", policy=FAST
    )
    assert (second.sent, second.present) == (20, 30)
    assert held(folder) == sorted(f"d{i}" for i in range(50))
    assert len(list(folder.glob("look-*"))) > before
    # Look-ups are made in lists of bounded length.
    left = missing_in_store(documents(spark, range(45, 60)).coalesce(1), open_client, look_up=4)
    assert sorted(r["id"] for r in left.collect()) == sorted(f"d{i}" for i in range(50, 60))


def test_loaded_tag_is_diverted(spark, folder, tmp_path):
    open_client = lambda: StagingStore(folder)
    deliver_documents(documents(spark, range(11)), open_client, *places(tmp_path / "a"), "t", "r1", policy=FAST)
    paths = places(tmp_path / "b")
    result = deliver_documents(documents(spark, range(40)), open_client, *paths, "t", "r2", policy=FAST)
    assert (result.status, result.sent, result.diverted) == ("diverted", 0, 40)
    assert replay(spark, paths[1]).count() == 40 and len(held(folder)) == 11


def test_ten_documents_are_not_a_loaded_tag(spark, folder, tmp_path):
    open_client = lambda: StagingStore(folder)
    deliver_documents(documents(spark, range(10)), open_client, *places(tmp_path / "a"), "t", "r1", policy=FAST)
    result = deliver_documents(documents(spark, range(12)), open_client, *places(tmp_path / "b"), "t", "r2", policy=FAST)
    assert result.status == "delivered" and len(held(folder)) == 12


def test_refused_and_unfit_documents_become_dead_letters(spark, folder, tmp_path):
    class Refusing(StagingStore):
        def upsert(self, some):
            self.refuse = lambda d: "full" if d["prediction"] > 0.5 else None
            return super().upsert(some)

    mixed = documents(spark, range(8)).union(documents(spark, [90], "other")).union(
        spark.createDataFrame([(None, [1.0], 0.0, "c", 1, "t")], DOCUMENT_SCHEMA)
    )
    paths = places(tmp_path)
    result = deliver_documents(mixed, lambda: Refusing(folder), *paths, "t", "r1", policy=FAST)
    assert (result.sent, result.failed) == (6, 4)
    errors = sorted((r["id"] or "", r["error"]) for r in spark.read.json(paths[2]).collect())
    assert errors == [("", "missing id"), ("d3", "full"), ("d7", "full"), ("d90", "other dataset type")]


def test_no_client_means_fallback(spark, tmp_path):
    def broken():
        raise ConnectionError("no store")

    paths = places(tmp_path)
    with pytest.raises(ConnectionError):
        deliver_documents(documents(spark, range(5)), broken, *paths, "t", "r1", policy=FAST)
    assert replay(spark, paths[1]).count() == 5


def test_staged_delivery_shows_all_or_nothing(spark, folder, tmp_path):
    outcomes = deliver_staged(documents(spark, range(20)), lambda: StagingStore(folder), str(tmp_path / "o"), "r1", FAST)
    assert outcomes.agg(F.sum("succeeded")).first()[0] == 20 and len(held(folder)) == 20
    assert not list((folder / "staged").glob("*/*"))

    def refusing():
        return StagingStore(folder, lambda d: "full" if d["id"] == "d105" else None)

    with pytest.raises(Exception, match="refused"):
        deliver_staged(documents(spark, range(100, 120)), refusing, str(tmp_path / "p"), "r2", FAST)
    assert len(held(folder)) == 20


def write_staged(docs, folder, client):
    docs.write.format("document_store").mode("append").options(
        client=f"store_clients:{client}", folder=str(folder), staged="true", backoff_ms=0, pause_ms=0
    ).save()


def test_data_source_commits_once_or_not_at_all(spark, folder):
    spark.dataSource.register(DocumentStoreSource)
    write_staged(documents(spark, range(20)), folder, "open_staging")
    assert len(held(folder)) == 20 and len(list(folder.glob("publish-*"))) == 1
    with pytest.raises(Exception, match="refused"):
        write_staged(documents(spark, range(30, 50)), folder, "open_staging_refusing")
    assert len(held(folder)) == 20 and len(list(folder.glob("publish-*"))) == 1


def test_attempt_that_broke_leaves_nothing(spark, folder, tmp_path):
    """What an attempt staged before it broke is not among what is published."""
    (folder / "staged" / "r1" / "0-0-old").mkdir(parents=True)
    (folder / "staged" / "r1" / "0-0-old" / "doc-ghost").write_text("{}")
    deliver_staged(documents(spark, range(9)), lambda: StagingStore(folder), str(tmp_path / "o"), "r1", FAST)
    assert held(folder) == sorted(f"d{i}" for i in range(9))
    assert not (folder / "staged" / "r1").exists()


def test_progress_is_told_before_the_end(spark, tmp_path):
    class Slow:
        def upsert(self, some):
            time.sleep(0.05)
            return [None] * len(some)

        def close(self):
            pass

    told, ended = [], []
    docs = documents(spark, range(800)).repartition(40)
    outcomes = deliver(
        docs, Slow, str(tmp_path / "o"), DeliveryPolicy(batch_size=5, pause_ms=0),
        progress=lambda b, d: told.append((b, d, bool(ended))), progress_seconds=0.05,
    )
    ended.append(True)
    assert outcomes.agg(F.sum("succeeded")).first()[0] == 800
    assert told[-1][1] == 800 and told == sorted(told)
    assert any(0 < d < 800 and not late for _, d, late in told)
    assert threading.active_count() < 50


def test_replays_are_made_once(spark, tmp_path):
    dead, ledger, store = (str(tmp_path / n) for n in ("dead", "ledger", "store"))
    documents(spark, range(10)).coalesce(2).write.json(dead + "/run_id=a")
    loads = []

    def load(docs):
        loads.append(docs.count())
        load_documents(docs, store, str(tmp_path / "f"), str(tmp_path / "d"), "t", f"r{len(loads)}", "resume")

    assert replay_once(spark, dead, ledger, "r1", load).count() == 2
    assert replay_once(spark, dead, ledger, "r2", load).count() == 0
    documents(spark, range(5, 15)).coalesce(1).write.json(dead + "/run_id=b")
    assert replay_once(spark, dead, ledger, "r3", load).count() == 1
    assert loads == [10, 10] and open_store(spark, store).count() == 15
    assert sorted(r["run_id"] for r in read_ledger(spark, ledger).collect()) == ["r1", "r1", "r3"]

    def breaks(docs):
        raise ConnectionError

    documents(spark, [99]).coalesce(1).write.json(dead + "/run_id=c")
    with pytest.raises(ConnectionError):
        replay_once(spark, dead, ledger, "r4", breaks)
    assert replay_once(spark, dead, ledger, "r5", load).count() == 1


def test_table_published_from_itself_and_after_a_failure(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(10).selectExpr("cast(id as string) a", "'x,\n\"y' b").write.option("header", True).csv(path)
    again = spark.read.option("header", True).option("multiLine", True).csv(path)
    assert publish(again.filter("a > 3"), path) == 6
    assert spark.read.option("header", True).option("multiLine", True).csv(path).count() == 6
    broken = spark.range(4).select(F.raise_error(F.lit("stop")).cast("string").alias("a"))
    with pytest.raises(Exception, match="stop"):
        publish(broken, path)
    assert spark.read.option("header", True).option("multiLine", True).csv(path).count() == 6
    assert [f.name for f in tmp_path.iterdir()] == ["table"]
    assert publish(spark.range(5).withColumn("p", F.col("id") % 2), path, "parquet", ["p"]) == 5
    assert spark.read.parquet(path).filter("p = 1").count() == 2


def test_failed_load_leaves_no_staged_files(spark, tmp_path):
    store = str(tmp_path / "store")
    broken = documents(spark, range(5)).withColumn(
        "features", F.when(F.col("id") == "d3", F.raise_error(F.lit("stop"))).otherwise(F.col("features"))
    )
    with pytest.raises(Exception):
        load_documents(broken, store, str(tmp_path / "f"), str(tmp_path / "d"), "t", "r1")
    assert open_store(spark, store).count() == 0
    assert not list((tmp_path / "store").glob("_staged*"))
