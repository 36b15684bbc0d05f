import random
import re

import pytest

from facetforge.llm.licence_scan import TEMPLATES, scan_licences


def bigrams(text):
    words = re.sub(r"[^A-Za-z0-9]+", " ", text).lower().split()
    return set(zip(words, words[1:]))


def units_of(text):
    text = text or ""
    paragraphs = re.split(r"\n[ \t\r]*\n", text)
    whole = [text] if len(paragraphs) > 1 else []
    return text.split("\n") + [p for p in paragraphs if "\n" in p] + whole


def brute(text, similarity=0.8):
    hits = []
    for place, unit in enumerate(units_of(text)):
        own = bigrams(unit)
        scored = [
            (2 * len(own & bigrams(t)) / (len(own) + len(bigrams(t))), name) for name, t in TEMPLATES
        ]
        best = max(s for s, _ in scored)
        if own and best >= similarity:
            hits.append((place, min(n for s, n in scored if s == best), best))
    return hits


def hits_of(df):
    return [[tuple(h) for h in r["hits"]] for r in df.orderBy("doc_id").collect()]


def test_equals_brute_force(make_docs):
    rng = random.Random(1)
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            words = rng.choice(TEMPLATES)[1].split()
            for _ in range(rng.randrange(0, 4)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["extra", "ünd", "1"]))
            if rng.random() < 0.3:
                words = ["prose", "of", "any", "kind"] * rng.randrange(9)
            parts.append(rng.choice([" ", "\n", "  "]).join(words))
        texts.append(rng.choice(["\n", "\n\n", "\n \t\n"]).join(parts))
    found = hits_of(scan_licences(make_docs(texts)))
    assert found == [brute(t) for t in texts]
    assert sum(map(bool, found)) > 50


@pytest.mark.parametrize("name", sorted({n for n, _ in TEMPLATES}))
def test_every_notice_names_its_licence(make_docs, name):
    own = [t for n, t in TEMPLATES if n == name]
    found = hits_of(scan_licences(make_docs([f"Before.\n{t.upper()}\nAfter." for t in own])))
    assert all({h[1] for h in hits} == {name} and 1 in {h[0] for h in hits} for hits in found)


def test_wrapped_notice_is_found_as_a_paragraph(make_docs):
    words = max(TEMPLATES, key=lambda t: len(t[1]))[1].split()
    wrapped = "\n".join(" ".join(words[i : i + 8]) for i in range(0, len(words), 8))
    hits = hits_of(scan_licences(make_docs([f"Title\n\n{wrapped}\n\nThe end of it."])))[0]
    assert {h[1] for h in hits} == {"MIT"} and hits[0][2] == 1.0


def test_hard_texts(hard_docs, no_docs):
    result = scan_licences(hard_docs)
    assert result.columns == [*hard_docs.columns, "hits"]
    assert all(r["hits"] == [] for r in result.collect())
    assert scan_licences(no_docs).count() == 0


def test_one_word_template_is_refused(no_docs):
    with pytest.raises(ValueError):
        scan_licences(no_docs, templates=[("x", "word")])
