"""I-Match fingerprints over randomised lexicons.

The lexicon holds the terms whose inverse document frequency lies in a band. A
fingerprint has one hash for each of several random subsets of the lexicon: the
hash of the text's different terms in the subset. Subsets of several densities
make the share of equal hashes a likeness for short and long texts alike.
Everything runs on DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetforge.llm.common import SPACE_PATTERN, let, plain_text, quoted
from facetforge.operators.ordering import number_rows
from facetforge.storage import materialise

# Terms in at least one document in a thousand and at most one in fifty.
MIN_IDF, MAX_IDF = math.log(50), math.log(1000)
# A term falls into a subset with probability 2 ** -halvings; 16 subsets each.
HALVINGS = (3, 5, 7, 9)
SUBSETS_EACH = 16
SUBSETS = SUBSETS_EACH * len(HALVINGS)
LEAST_USED = 4
HASH_CHARS = 4
EMPTY = "0" * HASH_CHARS
# A lexicon of more terms (24 MB) is joined without broadcast.
MAX_BROADCAST_TERMS = 1_000_000
# Stands for the text itself, so that texts without a term in the lexicon keep
# their row.
_HEADER = 0


def term_hashes(text: Column) -> Column:
    """64-bit hashes of the different words of the text in lower case, sorted."""
    words = F.array_remove(F.split(F.lower(text), SPACE_PATTERN), "")
    return F.sort_array(F.transform(F.array_distinct(words), lambda w: F.xxhash64(w)))


def _subset_mask(term: Column) -> Column:
    """One bit for each subset that the term belongs to."""
    mask, drawn = F.lit(0).cast("bigint"), None
    halved = 0
    for place, halvings in enumerate(HALVINGS):
        while halved < halvings:
            bits = F.xxhash64(F.lit(halved), term)
            drawn = bits if drawn is None else drawn.bitwiseAND(bits)
            halved += 1
        window = ((1 << SUBSETS_EACH) - 1) << (SUBSETS_EACH * place)
        if window >= 1 << 63:
            window -= 1 << 64
        mask = mask.bitwiseOR(drawn.bitwiseAND(F.lit(window).cast("bigint")))
    return mask


def band_lexicon(
    docs: DataFrame,
    text_column: str = "text",
    min_idf: float = MIN_IDF,
    max_idf: float = MAX_IDF,
) -> DataFrame:
    """(term, mask) of the terms with ``min_idf <= ln(rows / rows with the term)
    <= max_idf``, by their hashes, with the subsets they belong to.

    Every row counts. At most exp(max_idf) times the mean number of different
    terms of a text can be in the band, however many texts there are.
    """
    rows = docs.select(term_hashes(plain_text(text_column)).alias("terms"))
    total = docs.count()
    counts = (
        rows.select(F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("texts"))
    )
    idf = F.log(F.lit(float(max(total, 1))) / F.col("texts"))
    chosen = counts.filter(idf.between(min_idf - 1e-9, max_idf + 1e-9))
    masked = chosen.select("term", _subset_mask(F.col("term")).alias("mask"))
    return materialise(masked.filter("mask <> 0"), "lexicon")


def _with_lexicon(terms: DataFrame, lexicon: DataFrame) -> DataFrame:
    header = lexicon.sparkSession.range(1).select(
        F.lit(_HEADER).cast("bigint").alias("term"), F.lit(0).cast("bigint").alias("mask")
    )
    table = lexicon.unionByName(header)
    if lexicon.count() <= MAX_BROADCAST_TERMS:
        table = F.broadcast(table)
    return terms.join(table, "term")


def _subset_hashes(keys: list[str], texts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``keys`` and fingerprint, for rows of (keys, terms, whole).

    The hash of a subset is the exclusive or of its terms' hashes, mixed once
    more. Terms are different, so this tells sets of terms apart and needs no
    order; the sums have a fixed width, and rows that already lie together by
    their keys are not shuffled.
    """
    listed = F.concat(F.array(F.lit(_HEADER).cast("bigint")), "terms")
    terms = texts.select(*keys, "whole", F.explode(listed).alias("term"))
    member = [
        F.bit_xor(
            F.when(F.col("mask").bitwiseAND(F.lit(_bit(i)).cast("bigint")) != 0, F.col("term")).otherwise(
                F.lit(0).cast("bigint")
            )
        ).alias(f"_subset_{i}")
        for i in range(SUBSETS)
    ]
    summed = _with_lexicon(terms, lexicon).groupBy(*keys, "whole").agg(
        F.bit_or("mask").alias("_used"), *member
    )
    shown = [
        F.when(F.col("_used").bitwiseAND(F.lit(_bit(i)).cast("bigint")) == 0, F.lit(EMPTY)).otherwise(
            _short_hash(F.xxhash64(F.lit(i), f"_subset_{i}"))
        )
        for i in range(SUBSETS)
    ]
    # Without any term in a subset, all terms together are the fingerprint.
    alone = F.concat(F.lit("all:"), F.hex("whole"))
    return summed.select(
        *keys, F.when(F.col("_used") == 0, alone).otherwise(F.concat(*shown)).alias("fingerprint")
    )


def _bit(i: int) -> int:
    return (1 << i) - (1 << 64 if i == 63 else 0)


def _short_hash(value: Column) -> Column:
    """HASH_CHARS hex digits that are never EMPTY."""
    number = F.pmod(value, F.lit(16**HASH_CHARS - 1)) + 1
    return F.lpad(F.hex(number), HASH_CHARS, "0")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 if one of them has no subset. Otherwise the
    share of equal hashes among the subsets of which either text has a term, in
    that density of subsets where the share is largest: dense subsets always
    differ between long texts, sparse ones are mostly empty for short texts.
    Densities with fewer than LEAST_USED such subsets only count together.
    """

    def part(fingerprint: Column, i: Column) -> Column:
        return F.substring(fingerprint, i * HASH_CHARS + 1, F.lit(HASH_CHARS))

    def count(f: Column, first: Column, size: int) -> Column:
        """(used, equal) of the subsets from ``first`` on."""
        pairs = F.transform(
            F.sequence(first, first + (size - 1)),
            lambda i: F.struct(part(f["a"], i).alias("a"), part(f["b"], i).alias("b")),
        )
        used = let(pairs, lambda p: F.filter(p, lambda x: (x["a"] != EMPTY) | (x["b"] != EMPTY)))
        return let(
            used,
            lambda u: F.struct(
                F.size(u).alias("used"),
                F.size(F.filter(u, lambda x: x["a"] == x["b"])).alias("equal"),
            ),
        )

    def share(f: Column) -> Column:
        levels = F.transform(
            F.sequence(F.lit(0), F.lit(len(HALVINGS) - 1)),
            lambda i: count(f, i * SUBSETS_EACH, SUBSETS_EACH),
        )

        def largest(found: Column) -> Column:
            enough = F.filter(found, lambda x: x["used"] >= LEAST_USED)
            used = F.aggregate(found, F.lit(0), lambda t, x: t + x["used"])
            equal = F.aggregate(found, F.lit(0), lambda t, x: t + x["equal"])
            together = F.when(used > 0, equal / used).otherwise(0.0)
            return F.coalesce(
                F.array_max(F.transform(enough, lambda x: x["equal"] / x["used"])), together
            )

        return let(levels, largest)

    plain = a.startswith("all:") | b.startswith("all:")
    both = F.struct(a.alias("a"), b.alias("b"))
    return F.when(a == b, 1.0).when(plain, 0.0).otherwise(let(both, share))


def fingerprints(
    docs: DataFrame, lexicon: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, fingerprint), one row for each row. NULL texts count as empty; equal
    texts have equal fingerprints; texts without a term in any subset have a
    fingerprint of all their terms."""
    rows = docs.select(quoted(id_column).alias("id"), plain_text(text_column).alias("text"))
    terms = rows.select(
        "id", F.monotonically_increasing_id().alias("row"), term_hashes(F.col("text")).alias("terms")
    )
    whole = terms.withColumn("whole", F.xxhash64("terms"))
    return _subset_hashes(["id", "row"], whole, lexicon).select(
        F.col("id").alias(id_column), "fingerprint"
    )


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows of (k0, k1, text): the id as two columns that are never NULL."""
    kind = docs.schema[id_column].dataType
    key = quoted(id_column)
    absent = F.lit("0").cast(kind)
    return docs.select(
        key.isNull().alias("k0"), F.coalesce(key, absent).alias("k1"), plain_text(text_column).alias("text")
    )


def successors(rows: DataFrame) -> DataFrame:
    """(k0, k1, r0, r1, needed): each id is the next document of the id (r0, r1),
    in descending order, the first one following the last; ``needed`` is half
    the length of the longest text of that id."""
    ids = rows.groupBy("k0", "k1").agg(F.max(F.length("text")).alias("longest"))
    ranked = materialise(number_rows(ids, [F.col("k0"), F.col("k1").desc()], "rank"), "ranked-ids")
    total = ranked.count()
    before = F.when(F.col("rank") == 1, F.lit(total)).otherwise(F.col("rank") - 1)
    receivers = ranked.select(
        F.col("rank").alias("before"),
        F.col("k0").alias("r0"),
        F.col("k1").alias("r1"),
        F.floor(F.col("longest") / 2).cast("int").alias("needed"),
    )
    donors = ranked.select("k0", "k1", before.cast("bigint").alias("before"))
    return materialise(donors.join(receivers, "before").drop("before"), "successors")


def compare_with_edited(
    docs: DataFrame,
    lexicon: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Fingerprints of the texts, of the same texts with an edited end, and
    their likeness: id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the next document in descending order of ids; the
    first document follows the last. near_next compares with the next
    document's fingerprint.

    NULL texts count as empty. Rows without id come last. Rows with the same id
    all have the same next document; among several rows of the next id the
    smallest text, and the smallest fingerprint, stand for it. A single document
    is its own next one. An empty table gives an empty table.
    """
    rows = _keyed(docs, id_column, text_column)
    order = successors(rows)
    # Texts are shuffled once by id. What a text gives to its predecessor is cut
    # before the second shuffle; half of it at most is needed.
    given = (
        rows.join(order, ["k0", "k1"])
        .select("r0", "r1", F.substring("text", F.lit(1), F.col("needed")).alias("piece"))
        .groupBy("r0", "r1")
        .agg(F.min("piece").alias("piece"))
        .select(F.col("r0").alias("k0"), F.col("r1").alias("k1"), "piece")
    )
    n_chars = F.length("text")
    half = F.floor(n_chars / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n_chars - half), F.substring("piece", F.lit(1), half)
    )
    versions = (
        rows.join(given, ["k0", "k1"])
        .select(
            "k0", "k1", "text", edited.alias("edited"), F.monotonically_increasing_id().alias("row")
        )
        .select(
            "k0",
            "k1",
            "row",
            n_chars.cast("long").alias("n_chars"),
            F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("digest"),
            F.explode(
                F.array(
                    F.struct(F.lit(False).alias("changed"), F.col("text").alias("body")),
                    F.struct(F.lit(True).alias("changed"), F.col("edited").alias("body")),
                )
            ).alias("v"),
        )
        .select(
            "k0", "k1", "row", "n_chars", "digest", "v.changed", term_hashes(F.col("v.body")).alias("terms")
        )
        .withColumn("whole", F.xxhash64("terms"))
    )
    keys = ["k0", "k1", "row", "n_chars", "digest"]
    hashed = _subset_hashes([*keys, "changed"], versions, lexicon)
    done = materialise(
        hashed.groupBy(*keys).agg(
            F.max(F.when(~F.col("changed"), F.col("fingerprint"))).alias("fingerprint"),
            F.max(F.when(F.col("changed"), F.col("fingerprint"))).alias("edited_fingerprint"),
        ),
        "fingerprints",
    )
    following = (
        done.select("k0", "k1", "fingerprint")
        .join(order, ["k0", "k1"])
        .groupBy(F.col("r0").alias("k0"), F.col("r1").alias("k1"))
        .agg(F.min("fingerprint").alias("next_fingerprint"))
    )
    own = F.col("fingerprint")
    return done.join(following, ["k0", "k1"]).select(
        F.when(~F.col("k0"), F.col("k1")).alias(id_column),
        "n_chars",
        F.lower(F.hex("digest")).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(own, F.col("edited_fingerprint")).alias("near_edited"),
        likeness(own, F.col("next_fingerprint")).alias("near_next"),
    )
