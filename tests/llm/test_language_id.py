import math
import random

import pytest

from facetforge.llm.language_id import (
    LanguageModel,
    WordScorer,
    fit_languages,
    identify_languages,
    read_vocabulary,
    words_of,
)


def all_segmentations(word, pieces):
    """Sum over every way to cut the word, by recursion."""
    if not word:
        return 1.0
    return sum(
        pieces[word[:n]] * all_segmentations(word[n:], pieces)
        for n in range(1, len(word) + 1)
        if word[:n] in pieces
    )


def test_forward_pass_sums_all_segmentations():
    rng = random.Random(1)
    letters = [b" ", b"a", b"b", b"c"]
    pieces = {x: 0.1 for x in letters}
    for _ in range(12):
        pieces[b"".join(rng.choices(letters, k=rng.randrange(2, 4)))] = rng.random()
    model = LanguageModel(("x", "y"), {k: (v, v / 3) for k, v in pieces.items()})
    scorer = WordScorer(model)
    third = {k: v / 3 for k, v in pieces.items()}
    for _ in range(60):
        word = "".join(rng.choices("abc", k=rng.randrange(1, 9)))
        wanted = [math.log(all_segmentations(b" " + word.encode(), p)) for p in (pieces, third)]
        scorer.learn([word])
        assert scorer.logs[scorer.known[word]] == pytest.approx(wanted)


def test_long_words_do_not_underflow():
    model = LanguageModel(("x", "y"), {b" ": (1e-3, 1e-3), b"a": (1e-4, 2e-4)})
    logs = WordScorer(model).texts(["a" * 5000])[0]
    assert logs[0] == pytest.approx(math.log(1e-3) + 5000 * math.log(1e-4))
    assert logs[1] - logs[0] == pytest.approx(5000 * math.log(2))


EN = "the house of the old man was near the river and the people of the town knew him well"
DE = "das haus des alten mannes stand am fluss und die leute der stadt kannten ihn sehr gut"


def labelled(spark):
    rng = random.Random(2)
    rows = [
        (i, " ".join(rng.choices(text.split(), k=12)), lang)
        for i in range(200)
        for lang, text in [rng.choice([("en", EN), ("de", DE)])]
    ]
    return spark.createDataFrame([*rows, (None, None, "en"), (7, "x y z", None)], "doc_id long, text string, lang string")


def test_held_out_accuracy(spark):
    docs = labelled(spark)
    model = fit_languages(docs.filter("doc_id % 3 <> 1"))
    assert model.languages == ("de", "en")
    for column in zip(*model.pieces.values()):
        assert sum(column) == pytest.approx(1.0)
    found = identify_languages(docs.filter("doc_id % 3 = 1 AND lang IS NOT NULL"), model).collect()
    right = [r["lang"] == r["lang_pred"] for r in found]
    assert len(right) > 50 and sum(right) >= 0.98 * len(right)
    assert all(0.5 <= r["score"] <= 1 for r in found)


def test_texts_without_a_letter_are_undetermined(spark):
    model = fit_languages(labelled(spark))
    texts = [None, "", " \n", "12 34 !?", "²³ ½", "😀"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [(r["lang_pred"], r["score"]) for r in identify_languages(docs, model).collect()] == [("und", 0.0)] * 6
    assert words_of("Don't 2x Ünder_score") == ["don", "t", "x", "ünder", "score"]


def test_without_labels_nothing_is_known(spark, no_docs):
    model = fit_languages(no_docs)
    assert model.languages == ()
    docs = spark.createDataFrame([("some text",)], "text string")
    assert identify_languages(docs, model).first()["lang_pred"] == "und"
    assert identify_languages(no_docs, model).count() == 0


def test_hard_texts_and_clashing_names(hard_docs):
    model = fit_languages(hard_docs)
    result = identify_languages(hard_docs, model)
    assert result.columns == ["doc_id", "text", "lang", "source", "n_lines", "a.key", "lang_pred", "score"]
    assert result.count() == hard_docs.count()


def test_words_are_scored_alike_alone_and_together():
    numbers = read_vocabulary()
    rng = random.Random(5)
    chances = {k: (rng.random(), rng.random(), rng.random()) for k in numbers}
    model = LanguageModel(("a", "b", "c"), chances)
    words = ["haus", "straße", "the", "é", "x" * 90, "internationalization", "日本語", "a"]
    together = WordScorer(model).texts([" ".join(words)])[0]
    alone = sum(WordScorer(model).texts([w])[0] for w in words)
    assert together == pytest.approx(alone)
    wanted = [math.log(all_segmentations(b" haus", {k: v[i] for k, v in chances.items()})) for i in range(3)]
    assert WordScorer(model).texts(["haus"])[0] == pytest.approx(wanted)


def test_vocabulary_has_every_byte():
    assert {bytes([i]) for i in range(256)} <= read_vocabulary().keys()
