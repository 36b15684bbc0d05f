import random
from collections import Counter

import numpy as np
import pytest

from facetforge.llm.order_minhash import (
    components,
    edit_distance_within,
    keep_one_of_each,
    kmer_hashes,
    kmer_similarity,
    label_occurrences,
    near_duplicates,
    order_sketches,
    parities,
    similar,
    words_of,
)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_banded_distance_equals_the_full_table():
    rng = random.Random(1)
    for _ in range(600):
        a = [rng.randrange(4) for _ in range(rng.randrange(12))]
        b = [rng.randrange(4) for _ in range(rng.randrange(12))]
        true = edit_distance(a, b)
        for limit in (0, 1, 3, 12):
            assert edit_distance_within(a, b, limit) == (true if true <= limit else None)


def test_occurrences_get_labels_of_their_own():
    kmers = np.array([5, 7, 5, 5, 7, 9], np.uint64)
    labelled = label_occurrences(kmers)
    assert len(set(labelled.tolist())) == 6
    assert labelled[0] == 5 and labelled[1] == 7 and labelled[5] == 9


def test_sketches_follow_order_and_similarity():
    rng = random.Random(2)
    words = [f"w{rng.randrange(5000)}" for _ in range(400)]
    swapped = words[200:] + words[:200]
    near = list(words)
    for i in range(0, 400, 100):
        near[i] = "changed"

    def agree(a, b):
        x, y = (order_sketches(kmer_hashes(w), 256) for w in (a, b))
        return (x == y).mean()

    assert agree(words, words) == 1
    # Similarity s, three minima: about s ** 3; halves swapped lose the order.
    s = kmer_similarity(words, near)
    assert agree(words, near) == pytest.approx(s**3, abs=0.12)
    assert agree(words, swapped) < 0.5 < kmer_similarity(words, swapped)


def brute_classes(rows):
    texts = sorted({t or "" for _, t in rows})
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            if similar(a, b):
                parent[find(a)] = find(b)
    low = {}
    for doc, t in rows:
        low.setdefault(find(t or ""), []).append(doc)
    return {doc: (min(low[find(t or "")]), len(low[find(t or "")])) for doc, t in rows}


def near_rows(seed):
    """Groups of edited copies, copies of copies, and a shared passage."""
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=60)
    texts = []
    for group in range(25):
        base = rng.choices(vocabulary, k=rng.randrange(30, 200))
        if group % 2:
            base[10:10] = passage
        family = [base]
        for _ in range(rng.randrange(0, 8)):
            copy = list(rng.choice(family))
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            family.append(copy)
        texts += [" ".join(w) for w in family]
    rng.shuffle(texts)
    return list(enumerate(texts))


def classes_of(df):
    return {r["doc_id"]: (r["class_id"], r["class_size"]) for r in df.collect()}


def test_classes_equal_brute_force(spark):
    rows = near_rows(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = near_duplicates(docs)
    assert classes_of(found) == brute_classes(rows)
    kept = [r["doc_id"] for r in found.filter("kept").collect()]
    assert sorted(kept) == sorted({c for c, _ in brute_classes(rows).values()})


def test_chains_become_one_component(spark):
    links = [(bytes([i]), bytes([i + 1])) for i in range(40)] + [(b"x", b"y")]
    found = components(spark.createDataFrame(links, "key binary, head binary")).collect()
    sizes = Counter(bytes(r["component"]) for r in found)
    assert sizes == {b"\x00": 41, b"x": 2}


def test_hard_texts(hard_docs):
    rows = near_duplicates(hard_docs).collect()
    assert len(rows) == hard_docs.count()
    kept = keep_one_of_each(hard_docs)
    assert kept.columns == hard_docs.columns
    texts = [r["text"] for r in kept.collect()]
    # NULL and "" are equal texts; each other text occurs twice.
    assert len(texts) == len({t or "" for t in texts})
    assert {t or "" for t in texts} <= {r["text"] or "" for r in hard_docs.collect()}


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "a b"), (None, "z")], "doc_id long, text string")
    assert sorted(map(repr, keep_one_of_each(docs).collect())) == sorted(
        ["Row(doc_id=1, text='a b')", "Row(doc_id=None, text='z')"]
    )


def test_short_texts_and_case():
    assert similar("One two", "one TWO") and not similar("one two", "one three")
    assert similar("", " \n") and not similar("", "a")
    assert words_of(" A\tb ") == ["a", "b"]


def test_empty_table(no_docs):
    assert near_duplicates(no_docs).count() == 0
    assert keep_one_of_each(no_docs).count() == 0


@pytest.mark.parametrize("shared", [75, 80])
def test_pairs_among_texts_that_share_a_passage(spark, shared):
    """1,000 texts of 100 k-mers, most of them of one passage; each has one copy
    with the last words changed, and none is near any other."""
    rng = random.Random(shared)
    passage = [f"p{i}" for i in range(shared + 4)]
    texts = []
    for i in range(500):
        own = [f"o{i}x{j}" for j in range(100 - shared)]
        other = own[:-11] + [f"c{i}x{j}" for j in range(11)]
        texts += [passage + own, passage + other]
    rng.shuffle(texts)
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    # Brute force over the k-mer sets; alignment only for pairs that pass.
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in texts]
    number = {kmer: i for i, kmer in enumerate(set().union(*sets))}
    cells = np.zeros((len(sets), len(number)), np.float32)
    for i, kmers in enumerate(sets):
        cells[i, [number[kmer] for kmer in kmers]] = 1
    both, size = cells @ cells.T, cells.sum(axis=1)
    near = both / (size[:, None] + size[None, :] - both) >= 0.8
    pairs = [(a, b) for a, b in np.argwhere(near).tolist() if a < b and similar(rows[a][1], rows[b][1])]
    assert len(pairs) == 500
    wanted = {doc: (min(pair), 2) for pair in pairs for doc in pair}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert classes_of(near_duplicates(docs)) == wanted


def test_parities_never_rule_out_similar_texts():
    rng = random.Random(11)
    for _ in range(300):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(5, 300))]
        other = list(words)
        for _ in range(rng.randrange(1, 12)):
            other[rng.randrange(len(other))] = f"x{rng.randrange(9)}"
        a, b = (np.unique(kmer_hashes(w)) for w in (words, other))
        differ = int(np.bitwise_count((parities(a) ^ parities(b)).view(np.uint64)).sum())
        assert differ <= len(np.setxor1d(a, b))
    far = [np.unique(kmer_hashes([f"{t}{i}" for i in range(150)])) for t in "ab"]
    assert np.bitwise_count((parities(far[0]) ^ parities(far[1])).view(np.uint64)).sum() > 60


def test_similar_texts_that_share_few_sketches(spark):
    """Pairs of 9 words and the first 8 of them, of similarity 0.8 exactly: all
    that share a sketch are linked."""
    texts = [[f"w{i}x{j}" for j in range(9)] for i in range(1500)]
    shares = [
        len(np.intersect1d(*(order_sketches(kmer_hashes(w)) for w in (t, t[:8])))) for t in texts
    ]
    assert sum(0 < n < 3 for n in shares) >= 5
    rows = [(2 * i + j, " ".join(t[: 9 - j])) for i, t in enumerate(texts) for j in (0, 1)]
    found = classes_of(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found == {d: (d - d % 2, 2) if shares[d // 2] else (d, 1) for d, _ in rows}
