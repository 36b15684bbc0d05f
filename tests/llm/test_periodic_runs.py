import hashlib
import random
import zlib

import numpy as np
import pytest

from facetforge.llm.periodic_runs import extend, find_runs, mirrored, plant_tail, recompress, runs_of
from facetforge.llm.queries import op11_periodic_runs


def plain_runs(words, least=12):
    """Every period tried at every place."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i < n - p:
            s = i
            while i < n - p and words[i] == words[i + p]:
                i += 1
            if i > s and i + p - s >= max(least, 2 * p):
                found.setdefault((s, i + p - s), p)
            i += i == s
    return sorted((s, length, p) for (s, length), p in found.items())


def collapsed(words, runs):
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def random_texts(seed, count):
    rng = random.Random(seed)
    texts = []
    for _ in range(count):
        k = rng.choice([1, 2, 3, 5, 20])
        words = [rng.randrange(k) for _ in range(rng.randrange(0, 120))]
        for _ in range(rng.randrange(3)):
            unit = [rng.randrange(k) for _ in range(rng.randrange(1, 9))]
            at = rng.randrange(0, len(words) + 1)
            words[at:at] = unit * rng.randrange(2, 8) + unit[: rng.randrange(len(unit))]
        texts.append(words)
    return [*texts, fibonacci(500), [0] * 700, [0, 1] * 200 + [2] + [1, 0] * 40]


@pytest.mark.parametrize("least", [2, 12])
def test_runs_equal_brute_force(least):
    texts = random_texts(least, 150)
    for words, runs in zip(texts, runs_of([np.array(t, np.int64) for t in texts], least), strict=True):
        assert [tuple(r) for r in runs.tolist()] == plain_runs(words, least)


def test_extensions_are_exact():
    rng = random.Random(5)
    for k in (1, 2, 4):
        words = [rng.randrange(k) for _ in range(400)]
        sequence = np.array([9, *words, 8])
        levels = recompress(sequence, 400)
        turned, end = mirrored(levels), len(sequence) - 1
        pairs = [rng.sample(range(1, 401), 2) for _ in range(500)]
        x, y = np.array(pairs).T

        def common(i, j, step):
            n = 0
            while sequence[i] == sequence[j]:
                n, i, j = n + 1, i + step, j + step
            return n

        assert extend(levels, x, y).tolist() == [common(i, j, 1) for i, j in pairs]
        assert extend(turned, end - x, end - y).tolist() == [common(i, j, -1) for i, j in pairs]


def test_long_texts_take_the_way_without_a_table():
    rng = random.Random(2)
    words = [rng.randrange(4000) for _ in range(30_000)]
    words += words[-700:] * 3 + [1, 2] * 4000
    (runs,) = runs_of([np.array(words, np.int64)])
    start = len(words) - 8000
    found = {tuple(r) for r in runs.tolist()}
    assert any(p == 700 and length >= 2800 for _, length, p in found)
    assert any(p == 2 and s in (start - 1, start, start + 1) for s, _, p in found)


def test_planted_tail():
    words = [str(i) for i in range(50)]
    keys = [k for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0]
    assert keys
    for k in range(200):
        got = plant_tail(words, k)
        if k not in keys:
            assert got == words
            continue
        g = zlib.crc32(str(k).encode()) // 10
        a, n = g % 50, 50
        p = 1 + (n - a) // (3 + g % 8)
        assert got == [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    assert plant_tail([], keys[0]) == [] and plant_tail(words, None) == words


def test_hard_texts(hard_docs, no_docs):
    rows = find_runs(hard_docs).collect()
    assert len(rows) == 20
    for row in rows:
        words = [w.decode() for w in (row["text"] or "").encode().split()]
        if len(words) < 1000:
            runs = plain_runs(words)
        else:
            runs = [(0, 60_000, 1)]
        assert row["n_runs"] == len(runs)
        assert row["runs"] == "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        assert row["collapsed"] == collapsed(words, runs)
        assert row["a.key"] == "x"
        if runs:
            assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == (
                0, 60_000, 1, 60_000_000,
            )
        else:
            assert row["start"] is None and row["exponent_milli"] is None
    assert find_runs(no_docs).count() == 0


def test_clashing_names_are_replaced(spark):
    docs = spark.createDataFrame([("a b " * 8, 1, "y")], "text string, Period int, runs string")
    row = find_runs(docs).first()
    assert row["period"] == 2 and row["runs"] == "0,16,2\n" and "Period" not in row.asDict()


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, " ".join(map(str, t)) or None) for i, t in enumerate(random_texts(9, 120))]
    rows += [(500, " \n"), (None, "a a a a a a a a a a a a a")]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in op11_periodic_runs(spark, str(tmp_path)).collect()}
    for key, text in rows:
        words = plant_tail((text or "").split(), key)
        runs = plain_runs(words)
        longest = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert got[key] == (
            len(runs),
            *(longest or (None,) * 3),
            1000 * longest[1] // longest[2] if longest else None,
            digest("".join(f"{s},{length},{p}\n" for s, length, p in runs)),
            digest(collapsed(words, runs)),
        )
