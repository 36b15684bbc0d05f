import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from facetforge.llm.decision_lists import (
    STATISTICS,
    Condition,
    DecisionList,
    features,
    judge,
    label_poor,
    learn_decision_list,
    text_statistics,
)


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, dup, len(repeated)


def test_statistics_equal_brute_force(make_docs, hard_docs):
    rng = random.Random(1)
    pool = ["a", "b", "c", "é😀", "##", "\n", "\n", "  ", "\t", "x|y", "A!", " ", "\x1c", "\r"]
    texts = [" ".join(rng.choices(pool, k=rng.randrange(60))) for _ in range(300)]
    for docs in (make_docs(texts), hard_docs):
        for row in text_statistics(docs).collect():
            assert tuple(row[n] for n in STATISTICS) == brute(row["text"])
            failed = row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"]
            assert row["base_failed"] == failed


def text_rows(seed, count=900):
    """Good prose, and poor texts of two kinds; a few labels are wrong."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        words = [f"word{rng.randrange(900)}" for _ in range(rng.randrange(60, 120))]
        kind = rng.choice(["good", "good", "good", "symbols", "shout"])
        if kind == "symbols":
            words = [w + rng.choice("#$%") if rng.random() < 0.8 else w for w in words]
        if kind == "shout":
            words = [w.upper() + "!!" for w in words]
        poor = (kind != "good") != (rng.random() < 0.02)
        rows.append((i, " ".join(words), kind, 0 if poor else 1))
    return rows


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.createDataFrame(text_rows(3), "doc_id long, text string, kind string, quality int")
    statistics = text_statistics(docs)
    labelled = label_poor(statistics, docs.select("doc_id", "quality").filter("doc_id < 600"))
    return statistics, learn_decision_list(labelled, F.col("poor"))


def test_rules_separate_the_kinds(learned):
    statistics, rules = learned
    assert 1 <= len(rules.rules) <= 8
    assert all(1 <= len(rule) <= 4 for rule in rules.rules)
    rest = judge(statistics, rules).filter("doc_id >= 600").collect()
    right = [r["kept"] == (r["kind"] == "good") for r in rest]
    assert sum(right) >= 0.99 * len(right)
    assert str(rules).endswith("else: good")


def test_rules_are_spark_conditions_in_order(spark):
    rules = DecisionList(
        (
            (Condition("symbols_per_word", True, 0.5), Condition("chars_per_word", False, 4.0)),
            (Condition("symbols_per_word", True, 0.2),),
        )
    )
    docs = spark.createDataFrame([("ab# " * 60,), ("abcdefgh# " * 60,), ("ab " * 60,)], "text string")
    numbers = text_statistics(docs).select(rules.rule_number(features())).collect()
    assert [r[0] for r in numbers] == [1, 2, 0]


def test_without_labels_nothing_is_learned(spark, no_docs, make_docs):
    for docs in (no_docs, make_docs(["one two"])):
        statistics = text_statistics(docs.select("doc_id", "text"))
        none = statistics.withColumn("poor", F.lit(None).cast("boolean"))
        rules = learn_decision_list(none, F.col("poor"))
        assert rules.rules == ()
        assert judge(statistics, rules).count() == docs.count()
    one_kind = text_statistics(make_docs(["a " * 70] * 30)).withColumn("poor", F.lit(True))
    assert learn_decision_list(one_kind, F.col("poor")).rules == ()


def test_several_labels_of_an_id_and_missing_ids(spark, make_docs):
    docs = make_docs([" ".join(f"w{i}" for i in range(60))] * 3)
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 1), (None, 0)], "doc_id long, quality int")
    found = label_poor(text_statistics(docs), labels).orderBy("doc_id").collect()
    assert [r["poor"] for r in found] == [True, False, None]


def test_clashing_names(hard_docs):
    docs = hard_docs.withColumn("N_Words", F.lit("x")).withColumn("kept", F.lit("y"))
    result = judge(text_statistics(docs), DecisionList(()))
    names = [c.lower() for c in result.columns]
    assert len(names) == len(set(names)) and result.count() == docs.count()
