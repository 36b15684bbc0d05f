import pytest

from facetforge.operators.encoding import category_counts, encode_rows, fit_vocabulary
from facetforge.operators.vocabulary_state import merge_counts, merge_vocabulary, vocabulary_drift

A = ["a", "b"]


def table(spark, rows):
    return spark.createDataFrame(rows, "a string, b string")


def as_dict(df):
    return {(r["attribute"], r["category"]): (r["n"], r["idx"]) for r in df.collect()}


@pytest.mark.parametrize("limit", [100_000, 1])
def test_positions_stay_and_counts_add_up(spark, limit):
    first = [("x", "1"), ("x", "2"), ("y", None), ("z", "1")]
    more = [("y", "3"), ("w", "3"), ("w", "0"), ("v", "4"), ("y", None), ("y", "1")]
    old = fit_vocabulary(table(spark, first), A, None, limit)
    merged = merge_vocabulary(old.table, table(spark, more), A, None, limit)
    before, after = as_dict(old.table), as_dict(merged.table)
    assert all(after[k][1] == idx for k, (_, idx) in before.items())
    whole = fit_vocabulary(table(spark, first + more), A).table
    assert {k: n for k, (n, _) in after.items()} == {k: n for k, (n, _) in as_dict(whole).items()}
    # New categories follow the stored ones, the most frequent first.
    assert after["a", "w"] == (2, 3) and after["a", "v"] == (1, 4)
    assert after["b", "3"] == (2, 2) and after["b", "0"][1] == 3 and after["b", "4"][1] == 4
    assert merged.sizes == {"a": 5, "b": 5} and merged.width == 10
    # Vectors made with the old vocabulary keep their ones within each block.
    rows = table(spark, first).selectExpr("*", "a AS k")
    blocks = encode_rows(rows, merged, ["k"]).collect()
    assert all(r["features"].size == 10 for r in blocks)


def test_parts_merge_in_any_order(spark):
    parts = [table(spark, [(c, "1") for c in text]) for text in ("xxy", "yz", "", "x")]
    counts = [category_counts(p, A) for p in parts]
    wanted = {("a", "x", 3), ("a", "y", 2), ("a", "z", 1), ("b", "1", 6)}
    for order in (counts, counts[::-1]):
        assert {tuple(r) for r in merge_counts(*order).collect()} == wanted


def test_edge_cases(spark):
    old = fit_vocabulary(table(spark, [("x", "1")]), A)
    same = merge_vocabulary(old.table, table(spark, []), A)
    assert as_dict(same.table) == as_dict(old.table) and same.sizes == old.sizes
    empty = fit_vocabulary(table(spark, []), A)
    new = merge_vocabulary(empty.table, table(spark, [("x", None), ("y", None), ("y", None)]), A)
    assert as_dict(new.table) == {("a", "y"): (2, 0), ("a", "x"): (1, 1)}
    assert new.sizes == {"a": 2, "b": 0}


def test_drift(spark):
    old = fit_vocabulary(table(spark, [("x", "1"), ("x", "1"), ("y", "1"), ("y", "1")]), A).table
    new = category_counts(table(spark, [("x", "1"), ("z", None), ("z", "1"), ("x", "1")]), A)
    found = {r["attribute"]: tuple(r)[1:] for r in vocabulary_drift(old, new).collect()}
    assert found == {"a": (2, 2, 1, 1, 0.5, 0.5), "b": (1, 1, 0, 0, 0.0, 0.0)}
