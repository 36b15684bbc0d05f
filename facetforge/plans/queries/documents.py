"""Vector documents: projection, loading, batches and search."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetforge.config import ClassificationTask, DeliveryPolicy
from facetforge.functions.columns import column, document_id, failed_document_json
from facetforge.operators.delivery import (
    deliver,
    delivery_progress,
    delivery_totals,
    failed_documents,
    load_documents,
    loaded_tags,
    not_yet_stored,
    open_store,
    replay,
    split_documents,
    tag_counts_or_zero,
    write_dead_letters,
    write_fallback,
)
from facetforge.operators.documents import long_vectors, vector_documents
from facetforge.operators.external import deliver_documents, deliver_staged, missing_in_store
from facetforge.operators.ordering import batch_numbers, number_copies
from facetforge.operators.replays import read_ledger, replay_once
from facetforge.operators.similarity import nearest_documents
from facetforge.plans.queries.common import table
from facetforge.storage import fresh_path

# Fixed time stamp: results must not depend on the clock.
BATCH_TIME = 1_700_000_000_000
NO_WAITING = DeliveryPolicy(backoff_ms=0, pause_ms=0)

EMBEDDING_TASK = ClassificationTask(
    target="label",
    positive="1",
    keys=("vec_id",),
    dataset_type="embeddings",
    positive_name="late",
    negative_name="early",
)
BALANCE_TASK = ClassificationTask(
    target="c_mktsegment",
    positive="MACHINERY",
    keys=("c_custkey",),
    dataset_type="customers",
    positive_name="in credit",
    negative_name="in debt",
)


def embedding_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.col("embedding").alias("features"),
        (F.col("label") / F.lit(10.0)).alias("prediction"),
    )
    return vector_documents(scored, EMBEDDING_TASK, created_at_ms=BATCH_TIME)


def customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    scored = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.array(balance, F.col("c_nationkey").cast("double")).alias("features"),
        (balance >= 0).cast("double").alias("prediction"),
    )
    return vector_documents(scored, BALANCE_TASK, created_at_ms=BATCH_TIME)


def in_debt() -> Column:
    return F.when(F.get("features", F.lit(0)) < 0, F.lit("negative balance"))


def vector_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = embedding_documents(spark, sf_dir)
    return documents.select(
        *[column(c) for c in documents.columns if c != "features"],
        F.posexplode("features").alias("pos", "value"),
    )


def copy_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids for rows without a key: equal rows are told apart by a copy number."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    numbered = number_copies(lines)
    keys = [F.col(c) for c in ("l_returnflag", "l_linestatus", "l_quantity", "copy_no")]
    return numbered.withColumn("id", document_id("lines", *keys))


def load_once_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_tags(
        table(spark, sf_dir, "events").select(F.col("event_type").alias("dataset_type"))
    )


def tag_count_or_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = table(spark, sf_dir, "events").select(F.col("event_type").alias("dataset_type"))
    return tag_counts_or_zero(tagged, ["click", "purchase", "never loaded"])


def resume_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        document_id("orders", F.col("o_orderkey")).alias("id"),
        F.lit("orders").alias("dataset_type"),
        "o_orderkey",
        "o_orderstatus",
    )
    return not_yet_stored(orders, orders.filter(F.col("o_orderstatus") == "F"))


def load_and_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load, then load again with resume: stored documents and dead letters."""
    base = fresh_path(spark, "load")
    store, dead = f"{base}/store", f"{base}/dead"
    documents = customer_documents(spark, sf_dir)
    for run in ("first", "second"):
        load_documents(
            documents, store, f"{base}/fallback", dead, "customers", run,
            when_present="resume", problem=in_debt(),
        )
    stored = open_store(spark, store).select(F.lit("store").alias("place"), "id", "prediction")
    return stored.groupBy("place", "prediction").agg(
        F.count("*").alias("documents"), F.count_distinct("id").alias("ids")
    )


def load_diverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load of a loaded tag goes to the fallback and not to the store."""
    base = fresh_path(spark, "divert")
    documents = customer_documents(spark, sf_dir)
    for run in ("first", "second"):
        load_documents(
            documents, f"{base}/store", f"{base}/fallback", f"{base}/dead", "customers", run
        )
    places = {
        "store": open_store(spark, f"{base}/store"),
        "fallback": replay(spark, f"{base}/fallback"),
    }
    counts = [
        found.groupBy("predicted_class").agg(
            F.lit(place).alias("place"), F.count("*").alias("documents")
        )
        for place, found in places.items()
    ]
    return counts[0].unionByName(counts[1])


def _places(spark: SparkSession, base: str) -> DataFrame:
    """Documents and different ids by place: store, fallback and dead letters."""
    found = {
        "store": open_store(spark, f"{base}/store"),
        "fallback": open_store(spark, f"{base}/fallback", "json"),
        "dead": open_store(spark, f"{base}/dead", "json"),
    }
    counts = [
        documents.agg(
            F.lit(place).alias("place"),
            F.count("*").alias("documents"),
            F.count_distinct("id").alias("ids"),
        )
        for place, documents in found.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def _load_customers(documents: DataFrame, base: str, run: str, store: str, **options) -> None:
    load_documents(documents, store, f"{base}/fallback", f"{base}/dead", "customers", run, **options)


def fallback_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs diverted to one fallback: each keeps its documents."""
    base = fresh_path(spark, "two-runs")
    documents = customer_documents(spark, sf_dir)
    late = F.col("predicted_class") == "in debt"
    for run, part in (("first", documents), ("second", documents), ("third", documents.filter(late))):
        _load_customers(part, base, run, f"{base}/store")
    return _places(spark, base)


def replay_after_divert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A diverted run, replayed with the same fallback path: diverted again, then
    loaded into another store; the fallback keeps what it had."""
    base = fresh_path(spark, "replay")
    documents = customer_documents(spark, sf_dir)
    for run in ("first", "second"):
        _load_customers(documents, base, run, f"{base}/other")
    diverted = replay(spark, f"{base}/fallback/run_id=second")
    _load_customers(diverted, base, "third", f"{base}/other")
    _load_customers(diverted, base, "fourth", f"{base}/store")
    return _places(spark, base)


def load_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which some come three times: one is stored, two are dead
    letters."""
    base = fresh_path(spark, "duplicates")
    documents = customer_documents(spark, sf_dir)
    again = documents.filter(F.col("predicted_class") == "in debt")
    _load_customers(documents.union(again).union(again), base, "first", f"{base}/store")
    return _places(spark, base)


def fallback_when_store_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store path cannot hold a table: the load fails, the fallback has all."""
    base = fresh_path(spark, "broken")
    documents = customer_documents(spark, sf_dir)
    try:
        _load_customers(documents, base, "first", "nosuchscheme://store/documents")
    except Exception as error:
        failed = "nosuchscheme" in str(error)
    else:
        failed = False
    return _places(spark, base).withColumn("failed", F.lit(failed))


def dead_letter_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = split_documents(customer_documents(spark, sf_dir), in_debt())
    both = good.withColumn("error", F.lit(None).cast("string")).unionByName(bad)
    return both.groupBy("predicted_class", "error").agg(F.count("*").alias("documents"))


def dead_letter_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = split_documents(customer_documents(spark, sf_dir), in_debt())[1]
    fields = (
        "id", "features", "prediction", "predicted_class", "created_at_ms", "dataset_type", "error",
    )
    return bad.select(failed_document_json(*fields).alias("line"))


def dead_letter_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "dead")
    bad = split_documents(customer_documents(spark, sf_dir), in_debt())[1]
    write_dead_letters(bad, path, "run-1")
    return long_vectors(replay(spark, path), "id")


def json_fallback_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "fallback")
    write_fallback(embedding_documents(spark, sf_dir), path, "run-1")
    return long_vectors(replay(spark, path), "id")


class HoldsHalf:
    """Store client that has the documents whose id begins with a digit below 8,
    and takes all others but those predicted 0."""

    def count(self, dataset_type: str, limit: int) -> int:
        return limit

    def existing(self, dataset_type: str, ids: list[str]) -> list[str]:
        return [i for i in ids if i < "8"]

    def upsert(self, documents: list[dict]) -> list[str | None]:
        return ["refused" if d["prediction"] == 0.0 else None for d in documents]

    def close(self) -> None:
        pass


class KeepsNothing(HoldsHalf):
    """Stages and publishes without a trace."""

    def stage(self, token: str, documents: list[dict]) -> list[str | None]:
        return [None] * len(documents)

    def publish(self, tokens: list[str]) -> None:
        pass

    def discard(self, prefix: str) -> None:
        pass


def _deliver_customers(spark: SparkSession, sf_dir: str, when_present: str) -> DataFrame:
    """A delivery to a store that has the tag: what became of the documents."""
    base = fresh_path(spark, "deliver")
    result = deliver_documents(
        customer_documents(spark, sf_dir), HoldsHalf, f"{base}/outcomes", f"{base}/fallback",
        f"{base}/dead", "customers", "run-1", when_present, policy=NO_WAITING,
    )
    return _places(spark, base).filter("place <> 'store'").select(
        "place",
        "documents",
        F.lit(result.status).alias("status"),
        F.lit(result.sent).cast("bigint").alias("sent"),
        F.lit(result.present).cast("bigint").alias("present"),
    )


def deliver_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only documents that the store lacks are sent; refused ones are dead letters."""
    return _deliver_customers(spark, sf_dir, "resume")


def deliver_diverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store has the tag, so the documents go to the fallback."""
    return _deliver_customers(spark, sf_dir, "divert")


def deliver_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_in_store(customer_documents(spark, sf_dir), HoldsHalf).select("id", "predicted_class")


def staged_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a delivery in two phases."""
    outcomes = deliver_staged(
        customer_documents(spark, sf_dir), KeepsNothing, fresh_path(spark, "staged"), "run-1", NO_WAITING
    )
    totals = delivery_totals(outcomes, F.min("attempts").alias("least"), F.sum("batches").alias("sent"))
    enough = F.col("sent") * 25 >= F.col("succeeded")
    return totals.select("succeeded", "failed", enough.alias("within_limit"))


def replay_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters replayed twice with a ledger, and more that came in between:
    each file is loaded once."""
    base = fresh_path(spark, "replays")
    bad = split_documents(customer_documents(spark, sf_dir), in_debt())[1]
    for run in ("first", "second", "third"):
        if run != "second":
            write_dead_letters(bad, f"{base}/dead", run)
        replay_once(
            spark, f"{base}/dead", f"{base}/ledger", run,
            lambda documents: _load_customers(
                documents, f"{base}/load", run, f"{base}/store", when_present="resume"
            ),
        )
    stored = open_store(spark, f"{base}/store").agg(F.count("*").alias("documents"))
    lines = read_ledger(spark, f"{base}/ledger").agg(
        F.sum("documents").alias("replayed"), F.count_distinct("run_id").alias("runs")
    )
    # Two tables of one row each.
    return stored.withColumn("one", F.lit(1)).join(lines.withColumn("one", F.lit(1)), "one").drop("one")


class RefusesDebtors:
    """Store client that keeps nothing and refuses documents predicted 0."""

    def upsert(self, documents: list[dict]) -> list[str | None]:
        return ["refused" if d["prediction"] == 0.0 else None for d in documents]

    def close(self) -> None:
        pass


def delivery_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sent to a store that refuses some documents: totals over all batches."""
    outcomes = deliver(
        customer_documents(spark, sf_dir), RefusesDebtors, fresh_path(spark, "sent"), NO_WAITING
    )
    batch = F.col("succeeded") + F.col("failed")
    return delivery_totals(outcomes, (F.max(batch) <= 25).alias("within_limit")).drop("batches")


def delivery_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = deliver(
        customer_documents(spark, sf_dir), RefusesDebtors, fresh_path(spark, "sent"), NO_WAITING
    )
    return failed_documents(outcomes).select("id", "predicted_class", "error")


def batch_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return batch_numbers(orders, [F.col("o_orderkey")])


def batch_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    stored = F.col("o_orderstatus") != "P"
    batches = (
        batch_numbers(orders, [F.col("o_orderkey")])
        .groupBy("batch_no")
        .agg(F.count_if(stored).alias("succeeded"), F.count_if(~stored).alias("failed"))
    )
    return delivery_progress(batches, F.lit(orders.count()), [F.col("batch_no")])


def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five vectors nearest to the mean vector of each label."""
    embeddings = table(spark, sf_dir, "embeddings")
    vector = array_to_vector(F.col("embedding").cast("array<double>"))
    means = embeddings.groupBy("label").agg(
        vector_to_array(Summarizer.mean(vector)).alias("mean_vector")
    )
    nearest = nearest_documents(
        embeddings, means, 5, "vec_id", "embedding", "label", "mean_vector"
    )
    return nearest.withColumn("similarity", F.round("similarity", 6))


QUERIES = {
    "vector_document": vector_document,
    "copy_ids": copy_ids,
    "load_once_guard": load_once_guard,
    "resume_load": resume_load,
    "tag_count_or_zero": tag_count_or_zero,
    "load_and_reload": load_and_reload,
    "load_diverted": load_diverted,
    "fallback_two_runs": fallback_two_runs,
    "replay_after_divert": replay_after_divert,
    "load_with_duplicates": load_with_duplicates,
    "fallback_when_store_broken": fallback_when_store_broken,
    "dead_letter_split": dead_letter_split,
    "dead_letter_json": dead_letter_json,
    "dead_letter_replay": dead_letter_replay,
    "json_fallback_roundtrip": json_fallback_roundtrip,
    "delivery_outcomes": delivery_outcomes,
    "delivery_failures": delivery_failures,
    "deliver_resume": deliver_resume,
    "deliver_diverted": deliver_diverted,
    "deliver_missing": deliver_missing,
    "staged_totals": staged_totals,
    "replay_twice": replay_twice,
    "batch_number": batch_number,
    "batch_progress": batch_progress,
    "vector_topk": vector_topk,
}

_ELEMENTS = """
    SELECT md5(concat_ws('|', 'embeddings', vec_id)) AS id,
           CAST(i - 1 AS INTEGER) AS pos, CAST(embedding[i] AS DOUBLE) AS value
    FROM embeddings, range(1, len(embedding) + 1) AS t(i)
"""
_CUSTOMER_ID = "md5(concat_ws('|', 'customers', c_custkey))"

SQL = {
    "vector_document": f"""
        SELECT id, pos, value, label / 10.0 AS prediction,
               CASE WHEN label < 5 THEN 'early' ELSE 'late' END AS predicted_class,
               {BATCH_TIME} AS created_at_ms, 'embeddings' AS dataset_type
        FROM ({_ELEMENTS}) JOIN embeddings ON id = md5(concat_ws('|', 'embeddings', vec_id))
    """,
    "copy_ids": """
        SELECT *, md5(concat_ws('|', 'lines', l_returnflag, l_linestatus, l_quantity, copy_no)) AS id
        FROM (SELECT l_returnflag, l_linestatus, l_quantity, row_number() OVER
              (PARTITION BY l_returnflag, l_linestatus, l_quantity) AS copy_no FROM lineitem)
    """,
    "load_once_guard": """
        SELECT event_type AS dataset_type, count(*) AS documents, count(*) > 10 AS loaded
        FROM events GROUP BY event_type
    """,
    "resume_load": """
        SELECT md5(concat_ws('|', 'orders', o_orderkey)) AS id, 'orders' AS dataset_type,
               o_orderkey, o_orderstatus
        FROM orders o
        WHERE NOT EXISTS (SELECT 1 FROM orders s
                          WHERE s.o_orderstatus = 'F' AND s.o_orderkey = o.o_orderkey)
    """,
    "load_and_reload": """
        SELECT 'store' AS place, 1.0::DOUBLE AS prediction, count(*) AS documents,
               count(DISTINCT c_custkey) AS ids
        FROM customer WHERE c_acctbal >= 0
    """,
    "tag_count_or_zero": """
        SELECT t.tag AS dataset_type, count(event_type) AS documents
        FROM (VALUES ('click'), ('purchase'), ('never loaded')) AS t(tag)
        LEFT JOIN events ON event_type = t.tag GROUP BY t.tag
    """,
    "load_diverted": """
        SELECT place, CASE WHEN c_acctbal < 0 THEN 'in debt' ELSE 'in credit' END AS predicted_class,
               count(*) AS documents
        FROM customer, (VALUES ('store'), ('fallback')) AS p(place) GROUP BY 1, 2
    """,
    "fallback_two_runs": """
        SELECT 'store' AS place, count(*) AS documents, count(*) AS ids FROM customer
        UNION ALL SELECT 'fallback', count(*) + count(*) FILTER (c_acctbal < 0), count(*) FROM customer
        UNION ALL SELECT 'dead', 0, 0
    """,
    "replay_after_divert": """
        SELECT 'store' AS place, count(*) AS documents, count(*) AS ids FROM customer
        UNION ALL SELECT 'fallback', 2 * count(*), count(*) FROM customer
        UNION ALL SELECT 'dead', 0, 0
    """,
    "load_with_duplicates": """
        SELECT 'store' AS place, count(*) AS documents, count(*) AS ids FROM customer
        UNION ALL SELECT 'fallback', 0, 0
        UNION ALL SELECT 'dead', 2 * count(*), count(*) FROM customer WHERE c_acctbal < 0
    """,
    "fallback_when_store_broken": """
        SELECT place, CASE place WHEN 'fallback' THEN count(*) ELSE 0 END AS documents,
               CASE place WHEN 'fallback' THEN count(*) ELSE 0 END AS ids, true AS failed
        FROM customer, (VALUES ('store'), ('fallback'), ('dead')) AS p(place) GROUP BY place
    """,
    "dead_letter_split": """
        SELECT CASE WHEN c_acctbal < 0 THEN 'in debt' ELSE 'in credit' END AS predicted_class,
               CASE WHEN c_acctbal < 0 THEN 'negative balance' END AS error, count(*) AS documents
        FROM customer GROUP BY 1, 2
    """,
    "dead_letter_json": f"""
        SELECT '{{"id":"' || {_CUSTOMER_ID} || '","features":[' || c_acctbal || ','
               || CAST(c_nationkey AS DOUBLE) || '],"prediction":0.0,"predicted_class":"in debt",'
               || '"created_at_ms":{BATCH_TIME},"dataset_type":"customers",'
               || '"error":"negative balance"}}' AS line
        FROM customer WHERE c_acctbal < 0
    """,
    "dead_letter_replay": f"""
        SELECT {_CUSTOMER_ID} AS id, 0 AS pos, c_acctbal AS value FROM customer WHERE c_acctbal < 0
        UNION ALL
        SELECT {_CUSTOMER_ID}, 1, CAST(c_nationkey AS DOUBLE) FROM customer WHERE c_acctbal < 0
    """,
    "json_fallback_roundtrip": _ELEMENTS,
    "delivery_outcomes": """
        SELECT count(*) FILTER (c_acctbal >= 0) AS succeeded,
               count(*) FILTER (c_acctbal < 0) AS failed, true AS within_limit
        FROM customer
    """,
    "delivery_failures": f"""
        SELECT {_CUSTOMER_ID} AS id, 'in debt' AS predicted_class, 'refused' AS error
        FROM customer WHERE c_acctbal < 0
    """,
    "deliver_resume": f"""
        WITH d AS (SELECT {_CUSTOMER_ID} AS id, c_acctbal < 0 AS debtor FROM customer)
        SELECT place, CASE place WHEN 'dead' THEN count(*) FILTER (debtor AND id >= '8') ELSE 0 END
               AS documents, 'delivered' AS status,
               count(*) FILTER (NOT debtor AND id >= '8') AS sent, count(*) FILTER (id < '8') AS present
        FROM d, (VALUES ('fallback'), ('dead')) AS p(place) GROUP BY place
    """,
    "deliver_diverted": """
        SELECT place, CASE place WHEN 'fallback' THEN count(*) ELSE 0 END AS documents,
               'diverted' AS status, 0::BIGINT AS sent, 0::BIGINT AS present
        FROM customer, (VALUES ('fallback'), ('dead')) AS p(place) GROUP BY place
    """,
    "deliver_missing": f"""
        SELECT * FROM (SELECT {_CUSTOMER_ID} AS id,
            CASE WHEN c_acctbal < 0 THEN 'in debt' ELSE 'in credit' END AS predicted_class
            FROM customer) WHERE id >= '8'
    """,
    "staged_totals": """
        SELECT count(*) AS succeeded, 0::BIGINT AS failed, true AS within_limit FROM customer
    """,
    "replay_twice": """
        SELECT count(*) AS documents, (2 * count(*))::BIGINT AS replayed, 2::BIGINT AS runs
        FROM customer WHERE c_acctbal < 0
    """,
    "batch_number": """
        SELECT o_orderkey,
               CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 25 + 1 AS BIGINT) AS batch_no
        FROM orders
    """,
    "batch_progress": """
        WITH numbered AS (
            SELECT o_orderstatus,
                   (row_number() OVER (ORDER BY o_orderkey) - 1) // 25 + 1 AS batch_no FROM orders),
        batches AS (SELECT batch_no, count(*) FILTER (o_orderstatus <> 'P') AS succeeded,
                           count(*) FILTER (o_orderstatus = 'P') AS failed
                    FROM numbered GROUP BY batch_no),
        done AS (SELECT *, CAST(sum(succeeded) OVER (ORDER BY batch_no) AS BIGINT) AS done
                 FROM batches)
        SELECT batch_no, succeeded, failed, done,
               round(100.0::DOUBLE * done / (SELECT count(*) FROM orders), 1) AS percent_done
        FROM done
    """,
    "vector_topk": """
        WITH elements AS (
            SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x
            FROM embeddings, range(1, len(embedding) + 1) AS t(i) GROUP BY label, i),
        means AS (SELECT label, list(x ORDER BY i) AS mean_vector FROM elements GROUP BY label),
        compared AS (
            SELECT m.label, e.vec_id, round(list_cosine_similarity(
                CAST(e.embedding AS DOUBLE[]), m.mean_vector), 9) AS similarity
            FROM embeddings e CROSS JOIN means m),
        ranked AS (SELECT label, vec_id, similarity, row_number() OVER
                   (PARTITION BY label ORDER BY similarity DESC, vec_id) AS rank FROM compared)
        SELECT label, CAST(rank AS INTEGER) AS rank, vec_id, round(similarity, 6) AS similarity
        FROM ranked WHERE rank <= 5
    """,
}
