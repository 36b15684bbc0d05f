"""Vocabularies that grow with the data.

A stored vocabulary, (attribute, category, n, idx), is merged with the counts of
new rows only. Categories keep their positions, so vectors and models made
before stay valid; new categories come after them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetforge.operators.encoding import (
    MAX_LOCAL_BYTES,
    MAX_LOCAL_CATEGORIES,
    Vocabulary,
    category_counts,
    rank_categories,
)
from facetforge.storage import materialise

_KEY = ["attribute", "category"]


def merge_counts(*counts: DataFrame) -> DataFrame:
    """(attribute, category, n) of several such tables, added up."""
    together = counts[0].select(*_KEY, "n")
    for more in counts[1:]:
        together = together.unionByName(more.select(*_KEY, "n"))
    return together.groupBy(*_KEY).agg(F.sum("n").alias("n"))


def merge_vocabulary(
    stored: DataFrame,
    rows: DataFrame,
    attributes: Sequence[str],
    weight: str | None = None,
    local_limit: int = MAX_LOCAL_CATEGORIES,
) -> Vocabulary:
    """The vocabulary of the rows that ``stored`` was made of and of ``rows``.

    Counts are those of all rows together. Positions of stored categories stay
    as they are, whatever their counts are now; new categories of an attribute
    follow, by falling frequency in the new rows, ties by rising text. Only the
    new rows are read, once. NULL is not a category; an empty table changes
    nothing; an attribute that is new gets positions from 0 on.
    """
    counts = materialise(category_counts(rows, attributes, weight), "new-counts")
    old = stored.filter(F.col("attribute").isin(*attributes)).select(*_KEY, "n", "idx")
    known = old.join(counts.select(*_KEY, F.col("n").alias("_more")), _KEY, "left").select(
        *_KEY, (F.col("n") + F.coalesce("_more", F.lit(0))).alias("n"), "idx"
    )
    fresh = materialise(counts.join(old.select(*_KEY), _KEY, "left_anti"), "new-categories")
    # One row per attribute.
    sizes = {
        r["attribute"]: r["size"]
        for r in old.groupBy("attribute").agg((F.max("idx") + 1).alias("size")).collect()
    }
    added = {
        r["attribute"]: (r["size"], r["bytes"] or 0)
        for r in fresh.groupBy("attribute")
        .agg(F.count("*").alias("size"), F.sum(F.octet_length("category")).alias("bytes"))
        .collect()
    }
    large = [a for a, (n, b) in added.items() if n > local_limit or b > MAX_LOCAL_BYTES]
    ranked = rank_categories(fresh, large)
    before = F.coalesce(
        *[F.when(F.col("attribute") == a, F.lit(int(n))) for a, n in sizes.items()], F.lit(0)
    )
    placed = ranked.select(*_KEY, "n", (F.col("idx") + before).cast("bigint").alias("idx"))
    table = materialise(known.unionByName(placed), "vocabulary")
    all_sizes = {a: int(sizes.get(a, 0)) + added.get(a, (0, 0))[0] for a in attributes}
    text = table.agg(F.sum(F.octet_length("category")).alias("bytes")).first()["bytes"] or 0
    return Vocabulary(tuple(attributes), table, all_sizes, text, local_limit)


def vocabulary_drift(stored: DataFrame, counts: DataFrame) -> DataFrame:
    """(attribute, stored, seen, added, missing, added_share, distance): categories
    stored, seen in the new counts, seen but not stored, stored but not seen; the
    share of new rows with a category that is not stored; and the total variation
    distance between the two distributions, from 0 (alike) to 1."""
    both = (
        stored.select(*_KEY, F.col("n").alias("old"))
        .join(counts.select(*_KEY, F.col("n").alias("new")), _KEY, "full_outer")
        .na.fill(0, ["old", "new"])
    )
    # One row per attribute.
    totals = both.groupBy("attribute").agg(
        F.sum("old").alias("all_old"), F.sum("new").alias("all_new")
    )
    part = lambda n, whole: F.coalesce(F.try_divide(n, whole), F.lit(0.0))
    gap = F.abs(part(F.col("old"), F.col("all_old")) - part(F.col("new"), F.col("all_new")))
    return (
        both.join(F.broadcast(totals), "attribute")
        .groupBy("attribute")
        .agg(
            F.count_if(F.col("old") > 0).alias("stored"),
            F.count_if(F.col("new") > 0).alias("seen"),
            F.count_if((F.col("old") == 0) & (F.col("new") > 0)).alias("added"),
            F.count_if((F.col("old") > 0) & (F.col("new") == 0)).alias("missing"),
            F.coalesce(
                F.try_divide(F.sum(F.when(F.col("old") == 0, F.col("new")).otherwise(0)), F.sum("new")),
                F.lit(0.0),
            ).alias("added_share"),
            (F.sum(gap) / 2).alias("distance"),
        )
    )
