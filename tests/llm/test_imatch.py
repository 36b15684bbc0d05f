import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from facetforge.llm.imatch import (
    HALVINGS,
    SUBSETS_EACH,
    band_lexicon,
    compare_with_edited,
    fingerprints,
    likeness,
)


def prose(seed, count):
    rng = random.Random(seed)
    vocabulary = [f"term{i}" for i in range(4000)]
    weights = [1 / (i + 1) for i in range(4000)]
    return [" ".join(rng.choices(vocabulary, weights, k=rng.randrange(40, 250))) for _ in range(count)]


def test_lexicon_is_the_band(spark, make_docs):
    texts = prose(1, 200)
    frequency = {}
    for t in texts:
        for w in set(t.split()):
            frequency[w] = frequency.get(w, 0) + 1
    low, high = math.log(20), math.log(100)
    band = [w for w, n in frequency.items() if low <= math.log(200 / n) <= high]
    words = spark.createDataFrame([(w,) for w in band], "w string")
    hashes = {r[0] for r in words.select(F.xxhash64("w")).collect()}
    rows = band_lexicon(make_docs(texts), min_idf=low, max_idf=high).collect()
    found = {r["term"] for r in rows}
    assert found <= hashes and len(found) >= 0.85 * len(hashes)
    # Each density holds its share of the terms.
    for place, halvings in enumerate(HALVINGS[:2]):
        window = ((1 << SUBSETS_EACH) - 1) << (SUBSETS_EACH * place)
        share = sum(bin(r["mask"] & window).count("1") for r in rows) / SUBSETS_EACH / len(hashes)
        assert share == pytest.approx(2.0**-halvings, rel=0.25)


def brute_edit(rows):
    ids = sorted({i for i, _ in rows if i is not None}, reverse=True)
    ids += [None] if any(i is None for i, _ in rows) else []
    out = []
    for i, text in rows:
        text = text or ""
        after = ids[(ids.index(i) + 1) % len(ids)]
        following = min((t or "" for j, t in rows if j == after), key=lambda t: t.encode())
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edited_texts_equal_brute_force(spark, make_docs, hard_docs):
    distinct = hard_docs.filter("doc_id IS NOT NULL")
    for docs in (make_docs(prose(2, 60), start=-20), distinct):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        found = compare_with_edited(docs, band_lexicon(docs)).collect()
        assert sorted(((r[0], r[1], r[2]) for r in found), key=repr) == brute_edit(rows)


def test_equal_texts_have_equal_fingerprints_and_edits_stay_like(make_docs):
    texts = prose(3, 300)
    docs = make_docs(texts + texts[:50])
    lexicon = band_lexicon(docs)
    by_id = {r["doc_id"]: r["fingerprint"] for r in fingerprints(docs, lexicon).collect()}
    assert all(by_id[i] == by_id[300 + i] for i in range(50))
    assert len(set(by_id.values())) == len(set(texts))
    rows = compare_with_edited(docs, lexicon).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == by_id
    assert all(0 <= r[n] <= 1 for r in rows for n in ("near_edited", "near_next"))
    mean = {n: sum(r[n] for r in rows) / len(rows) for n in ("near_edited", "near_next")}
    assert mean["near_edited"] > 0.2 > 0.1 > mean["near_next"]


def test_repeated_and_missing_ids(spark):
    rows = [(1, "b b"), (1, "a a a"), (2, "c d e f"), (None, "x y z"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = compare_with_edited(docs, band_lexicon(docs)).collect()
    assert sorted(((r[0], r[1], r[2]) for r in found), key=repr) == brute_edit(rows)


def test_single_and_empty_tables(make_docs, no_docs):
    one = make_docs(["some text"])
    assert compare_with_edited(one, band_lexicon(one)).first()["near_next"] == 1.0
    assert compare_with_edited(no_docs, band_lexicon(no_docs)).count() == 0


def test_text_ids_and_clashing_names(spark):
    docs = spark.createDataFrame([("a", "one two", 1), ("b", "three", 2)], "doc_id string, text string, row int")
    found = compare_with_edited(docs, band_lexicon(docs)).collect()
    assert sorted(r["doc_id"] for r in found) == ["a", "b"]


def test_likeness_ignores_what_both_lack(spark):
    empty, a, b = "0000", "00AA", "00BB"
    pad = [empty] * 8
    pairs = [
        (pad + [a] * 4 + [b] * 4 + [empty] * 48, pad + [a] * 4 + [a] * 4 + [empty] * 48, 0.5),
        ([a] * 2 + [empty] * 62, [b] * 2 + [empty] * 62, 0.0),
        ([a] * 16 + [b] * 16 + [empty] * 32, [b] * 16 + [b] * 16 + [empty] * 32, 1.0),
        ([a, b] + [empty] * 62, [a, a] + [empty] * 62, 0.5),
    ]
    rows = [("".join(x), "".join(y), z) for x, y, z in pairs] + [("all:1", "all:1", 1.0), ("all:1", "all:2", 0.0)]
    frame = spark.createDataFrame(rows, "a string, b string, want double")
    for r in frame.select("want", likeness(F.col("a"), F.col("b")).alias("got")).collect():
        assert r["got"] == r["want"]
