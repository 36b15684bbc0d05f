import random

import pytest

from facetforge.llm.source_mixing import mix_sources, repeat_by_copies, source_targets


def fill(sizes, weights, share=1.5, most=2.0):
    """Reshare what is above the limits, by hand."""
    total, capped = sum(sizes), set()
    while True:
        rest = share * total - sum(most * sizes[i] for i in capped)
        free = sum(w for i, w in enumerate(weights) if i not in capped)
        targets = [
            most * s if i in capped else rest * w / free for i, (s, w) in enumerate(zip(sizes, weights))
        ]
        over = {i for i, t in enumerate(targets) if t > most * sizes[i] + 1e-9}
        if not over:
            return targets
        capped |= over


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_resharing_by_hand(spark, seed):
    rng = random.Random(seed)
    names = sorted({f"source-{rng.randrange(100)}" for _ in range(9)}) + [None]
    sizes = [int(rng.paretovariate(0.7) * 100) for _ in names]
    table = spark.createDataFrame(list(zip(names, sizes)), "source string, size long")
    found = {r["source"]: r["target"] for r in source_targets(table).collect()}
    wanted = fill(sizes, [(3, 1, 2)[i % 3] for i in range(len(names))])
    assert found == pytest.approx(dict(zip(names, wanted)))
    assert sum(found.values()) == pytest.approx(1.5 * sum(sizes))


def test_taken_comes_near_the_target_and_reruns_agree(spark):
    rng = random.Random(3)
    rows = [
        (i, "word " * rng.randrange(1, 60), "big" if i % 2 else rng.choice(["a", "b", None]))
        for i in range(6000)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    mixed = mix_sources(docs).collect()
    assert sorted(map(repr, mixed)) == sorted(map(repr, mix_sources(docs.repartition(3)).collect()))
    for source in ("big", "a", "b", None):
        own = [r for r in mixed if r["source"] == source]
        taken = sum(r["size"] * r["copies"] for r in own)
        assert taken == pytest.approx(own[0]["target"], rel=0.06)
        assert max(r["copies"] for r in own) <= 2


def test_repeats_rows(spark):
    docs = spark.createDataFrame([(i, "a b", "s") for i in range(40)], "doc_id long, text string, source string")
    mixed = mix_sources(docs)
    copies = {r["doc_id"]: r["copies"] for r in mixed.collect()}
    rows = repeat_by_copies(mixed, docs.columns)
    assert rows.columns == docs.columns
    assert {r["doc_id"]: r["count"] for r in rows.groupBy("doc_id").count().collect()} == {
        k: v for k, v in copies.items() if v
    }


def test_hard_texts(hard_docs):
    mixed = mix_sources(hard_docs).collect()
    assert len(mixed) == hard_docs.count()
    assert all(r["size"] == 0 for r in mixed if not (r["text"] or "").strip(" \t\n\x0b"))
    assert all(0 <= r["copies"] <= 2 for r in mixed)


def test_empty_and_wordless_tables(no_docs, spark):
    assert mix_sources(no_docs).count() == 0
    wordless = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["copies"], r["target"]) for r in mix_sources(wordless).collect()] == [(0, 0.0)] * 2


def test_wrong_settings(no_docs):
    with pytest.raises(ValueError):
        mix_sources(no_docs, share=3.0)
    with pytest.raises(ValueError):
        mix_sources(no_docs, weights=(1, 0))
