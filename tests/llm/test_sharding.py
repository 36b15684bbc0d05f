import zlib
from collections import Counter

import pytest

from facetforge.llm import sharding
from facetforge.llm.queries import op13_sharding
from facetforge.llm.sharding import shard_documents, shuffle_records


def in_order(df):
    return sorted((r["shard"], r["slot"], r["doc_id"], r["text"]) for r in df.collect())


def check_shards(rows, shards):
    """Slots without gaps, numbers of rows at most one apart."""
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) <= set(range(shards))
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))


@pytest.mark.parametrize("bucket_bytes", [500, 20_000, 1 << 24])
def test_every_row_once_in_equal_shards(spark, bucket_bytes):
    docs = spark.createDataFrame(
        [(i, f"text {i} " * (i % 9)) for i in range(1003)], "doc_id long, text string"
    ).repartition(5)
    result = shuffle_records(docs, bucket_bytes=bucket_bytes)
    rows = result.collect()
    check_shards(rows, 8)
    assert sorted((r["doc_id"], r["text"]) for r in rows) == sorted(tuple(r) for r in docs.collect())
    # Another partitioning of the input changes nothing.
    again = shuffle_records(docs.repartition(2), bucket_bytes=bucket_bytes)
    assert in_order(result) == in_order(again)
    other = shuffle_records(docs, bucket_bytes=bucket_bytes, seed=99)
    assert in_order(result) != in_order(other)


def test_order_is_random(spark):
    """Neighbours in the new order are as far apart as chance has it, within a
    bucket and across buckets."""
    n = 4000
    docs = spark.createDataFrame([(i, "x" * 50) for i in range(n)], "doc_id long, text string")
    for bucket_bytes in (10_000, 1 << 24):
        order = [r[2] for r in sorted((r["shard"], r["slot"], r["doc_id"]) for r in
                                      shuffle_records(docs, bucket_bytes=bucket_bytes).collect())]
        steps = [abs(a - b) for a, b in zip(order, order[1:])]
        assert abs(sum(steps) / len(steps) - n / 3) < n / 30
        rising = sum(a < b for a, b in zip(order, order[1:]))
        assert abs(rising - n / 2) < 150
        fixed = sum(i == x for i, x in enumerate(order))
        assert fixed < 12


def test_equal_rows_do_not_share_a_bucket(spark, tmp_path):
    rows = [(1, "same text")] * 6000 + [(i, f"t{i}") for i in range(2, 3000)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    shuffled = shuffle_records(docs, bucket_bytes=20_000)
    result = shuffled.collect()
    check_shards(result, 8)
    assert sorted(tuple(r)[:2] for r in result) == sorted(rows)
    share = Counter(r["shard"] for r in result if r["doc_id"] == 1)
    assert len(share) == 8 and max(share.values()) < 1.3 * 6000 / 8


def test_written_shards_hold_the_texts(hard_docs, no_docs):
    result = shard_documents(hard_docs)
    assert result.columns == [*hard_docs.columns, "shard", "slot"]
    rows = result.collect()
    check_shards(rows, 8)
    key = lambda r: (str(r["doc_id"]), r["text"] or "", r["n_lines"])
    assert sorted(map(key, rows)) == sorted(map(key, hard_docs.collect()))
    assert shard_documents(no_docs).count() == 0


def test_clashing_names(spark):
    docs = spark.createDataFrame(
        [(i, "t", 5, i) for i in range(20)], "doc_id long, text string, SHARD int, _bucket long"
    )
    result = shuffle_records(docs, shards=3)
    assert result.columns == ["doc_id", "text", "_bucket", "shard", "slot"]
    rows = result.collect()
    check_shards(rows, 3)
    assert all(r["_bucket"] == r["doc_id"] for r in rows)
    with pytest.raises(ValueError):
        shuffle_records(docs, shard_column="text")


def test_query(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(["é", None, "", "long " * 5000, "a", "a"])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = op13_sharding(spark, str(tmp_path)).collect()
    check_shards(found, 8)
    for r in found:
        raw = (rows[r["doc_id"]][1] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        assert r["law"] == sharding.LAW == "rows" and r["grown_shard"] is None
