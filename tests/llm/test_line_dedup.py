import hashlib
import random
import re

import numpy as np

from facetforge.llm.line_dedup import RepeatFilter, dedup_lines, may_contain, merge_filters


def brute(rows, min_docs=3, min_chars=20):
    def key(line):
        stripped = line.strip(" \t\n\x0b\x0c\r")
        return re.sub("[A-Z]", lambda m: m[0].lower(), stripped)

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            if len(k) >= min_chars and doc is not None:
                holders.setdefault(k, set()).add(doc)
    keeper = {k: max(d) for k, d in holders.items() if len(d) >= min_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(df):
    rows = df.select("doc_id", "n_lines", "n_dropped", "text").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def random_rows(seed, count=120):
    rng = random.Random(seed)
    pool = ["A line that recurs, number %d of them" % i for i in range(8)]
    pool += ["short", "", "ÄÖÜ line with umlauts, long enough", "exactly twenty chars"]
    rows = []
    for i in range(count):
        lines = [rng.choice(pool) for _ in range(rng.randrange(1, 5))]
        lines += ["own line %d of this document" % i]
        lines = [x.upper() if rng.random() < 0.2 else f"  {x}\t" if rng.random() < 0.2 else x for x in lines]
        rows.append((i, "\n".join(lines)))
    return rows


def test_equals_brute_force(spark):
    rows = random_rows(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(dedup_lines(docs)) == brute(rows)
    assert found(dedup_lines(docs, min_docs=20)) == brute(rows, min_docs=20)


def test_a_full_filter_only_suspects_more(spark):
    rows = random_rows(2, 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(dedup_lines(docs, max_filter_bits=64)) == brute(rows)


def test_hard_texts(hard_docs):
    rows = [(r["doc_id"], r["text"]) for r in hard_docs.collect()]
    result = dedup_lines(hard_docs)
    assert found(result) == brute(rows)
    assert result.columns == ["doc_id", "text", "lang", "source", "a.key", "Score", "n_lines", "n_dropped"]


def test_line_in_two_documents_stays_and_in_three_goes(make_docs):
    line = "this line has enough characters"
    two = make_docs([line, line, "other"])
    assert [r["n_dropped"] for r in dedup_lines(two).orderBy("doc_id").collect()] == [0, 0, 0]
    three = make_docs([line, f"{line}\n{line}", line + "\nrest", f"{line}\n{line}"])
    kept = dedup_lines(three).orderBy("doc_id").collect()
    assert [r["n_dropped"] for r in kept] == [1, 2, 1, 0]
    assert [r["text"] for r in kept] == ["", "", "rest", f"{line}\n{line}"]


def test_rows_of_one_id_are_one_document(spark):
    line = "this line has enough characters"
    docs = spark.createDataFrame([(1, line), (1, line), (2, line), (None, line)], "doc_id long, text string")
    assert sum(r["n_dropped"] for r in dedup_lines(docs).collect()) == 0
    more = docs.union(spark.createDataFrame([(3, line)], docs.schema))
    assert {(r["doc_id"], r["n_dropped"]) for r in dedup_lines(more).collect()} == {
        (None, 1), (1, 1), (2, 1), (3, 0)
    }


def test_empty_table(no_docs):
    assert dedup_lines(no_docs).count() == 0


def test_filters_never_miss_a_repeat():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 2**63, 4000).astype(np.uint64)
    parts = [rng.choice(keys, 1500, replace=False) for _ in range(4)]
    merged = None
    for part in parts:
        one = RepeatFilter(1024)
        for chunk in np.array_split(part, 3):
            one.add(chunk)
        pair = (one.once, one.twice)
        merged = pair if merged is None else merge_filters(*merged, *pair)
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    assert may_contain(merged[1], values[counts > 1]).all()
    assert may_contain(merged[0], values).all()
    assert may_contain(merged[1], values[counts == 1]).mean() < 0.5


def test_sha_of_query_is_of_the_kept_text(spark, make_docs):
    text = dedup_lines(make_docs(["ä\nb"])).first()["text"]
    assert hashlib.sha256(text.encode()).hexdigest() == hashlib.sha256("ä\nb".encode()).hexdigest()
