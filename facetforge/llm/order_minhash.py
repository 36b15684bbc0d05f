"""Near-duplicate texts by order MinHash.

A sketch takes the few occurrence-labelled k-mers of words with the smallest
hashes and keeps them in the order of the text, so it tells texts apart that
share their words in another order. Texts that share sketches become candidates;
an exact k-mer comparison and a banded alignment of the words confirm them.
Where many texts share a long passage, the candidates come from their rarest
k-mers instead, by bounds that no similar pair escapes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetforge.llm.common import as_bytes, plain_text, quoted, spare_name
from facetforge.storage import materialise

K = 5  # words in a k-mer
SIMILARITY = 0.8  # of k-mer sets, and of the aligned words
SKETCHES = 16
MINIMA = 3  # k-mers in a sketch
# Sketches (of SKETCHES) that a text shares at least with a head it is compared
# with; texts of similarity 0.8 share 8 on average. Those that share fewer are
# left to the last step, which compares them by exact bounds.
AGREEING = 3
_CELLS = 1 << 20  # hashes computed at once
_SLOTS = 1 << 20  # counters of k-mer frequencies; collisions only cost time
# Words of 64 bits with the parities of the numbers of k-mers in hash cells.
PARITY_WORDS = 4
PARITIES = [f"parity_{i}" for i in range(PARITY_WORDS)]

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[str]:
    return text.lower().split()


def kmer_hashes(words: list[str], k: int = K) -> np.ndarray:
    """Hashes of the k-mers in text order. Fewer than k words are one k-mer; no
    word is none."""
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(
        (xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words)
    )
    size = min(k, len(words))
    folded = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        folded = _mix(folded + _STEP + hashed[i : len(words) - size + 1 + i])
    return folded


def label_occurrences(kmers: np.ndarray) -> np.ndarray:
    """Make the first, second, … occurrence of a k-mer different hashes."""
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    place = np.arange(len(kmers))
    fresh = np.ones(len(kmers), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    if fresh.all():
        return kmers
    number = place - np.maximum.accumulate(np.where(fresh, place, 0))
    labelled = np.empty_like(kmers)
    labelled[order] = np.where(fresh, ranked, _mix(ranked + number.astype(np.uint64) * _STEP))
    return labelled


def order_sketches(
    kmers: np.ndarray, sketches: int = SKETCHES, minima: int = MINIMA
) -> np.ndarray:
    """One 64-bit key for each sketch; sketches of different numbers never
    share keys. Texts with fewer k-mers use all they have."""
    if not len(kmers):
        return np.zeros(0, np.int64)
    labelled = label_occurrences(kmers)
    take = min(minima, len(labelled))
    out = np.empty(sketches, np.uint64)
    step = max(1, _CELLS // len(labelled))
    for first in range(0, sketches, step):
        seeds = _mix(np.arange(first + 1, min(first + step, sketches) + 1, dtype=np.uint64) * _STEP)
        values = _mix(labelled[None, :] ^ seeds[:, None])
        if take < len(labelled):
            lowest = np.argpartition(values, take - 1, axis=1)[:, :take]
        else:
            lowest = np.tile(np.arange(take), (len(seeds), 1))
        lowest.sort(axis=1)  # text order
        key = seeds.copy()
        for i in range(take):
            key = _mix(key * _STEP + labelled[lowest[:, i]])
        out[first : first + len(seeds)] = key
    return out.view(np.int64)


def kmer_similarity(a: list, b: list, k: int = K) -> float:
    """Jaccard similarity of the k-mer sets; fewer than k words are one k-mer."""
    left, right = ({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} for w in (a, b))
    if min(len(left), len(right)) < SIMILARITY * max(len(left), len(right)) / 2:
        return 0.0
    both = len(left & right)
    return both / (len(left) + len(right) - both)


def edit_distance_within(a: list, b: list, limit: int) -> int | None:
    """Word edit distance if it is at most ``limit``, else None.

    Only the 2 * limit + 1 diagonals of the band are followed, each as far as it
    reaches with 0, 1, 2, … edits: the time is in proportion to the length plus
    the square of the distance.
    """
    first, end_a, end_b = 0, len(a), len(b)
    while first < end_a and first < end_b and a[first] == b[first]:
        first += 1
    while end_a > first and end_b > first and a[end_a - 1] == b[end_b - 1]:
        end_a, end_b = end_a - 1, end_b - 1
    a, b = a[first:end_a], b[first:end_b]
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return None
    if not n or not m:
        return max(n, m)
    goal, far = m - n, {}
    for d in range(limit + 1):
        reach = {}
        for diagonal in range(max(-d, -n), min(d, m) + 1):
            x = max(
                far.get(diagonal, -2) + 1,  # a word replaced
                far.get(diagonal + 1, -2) + 1,  # a word of a left out
                far.get(diagonal - 1, -2),  # a word of b put in
            ) if d else 0
            if x < 0 or x > n or x + diagonal > m:
                x = min(x, n, m - diagonal)
                if x < 0:
                    continue
            while x < n and x + diagonal < m and a[x] == b[x + diagonal]:
                x += 1
            reach[diagonal] = x
        if reach.get(goal, -1) >= n:
            return d
        far = reach
    return None


def similar(a: str, b: str, similarity: float = SIMILARITY, k: int = K) -> bool:
    """Whether the k-mer sets and the aligned words are similar enough."""
    left, right = words_of(a), words_of(b)
    if not left or not right:
        return left == right
    if kmer_similarity(left, right, k) < similarity:
        return False
    limit = int((1 - similarity) * max(len(left), len(right)) + 1e-9)
    return edit_distance_within(left, right, limit) is not None


def text_key(text: Column) -> Column:
    """128 bits of the SHA-256 of the text: equal for equal texts."""
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16)


def sketch_texts(
    rows: DataFrame, k: int = K, sketches: int = SKETCHES, minima: int = MINIMA
) -> DataFrame:
    """(id, key, kmers, sketch) of rows (id, key, text): the number of different
    k-mers and the order MinHash sketches."""
    schema = T.StructType(
        [
            rows.schema["id"],
            T.StructField("key", T.BinaryType()),
            T.StructField("kmers", T.LongType()),
            T.StructField("sketch", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], []
            for value in batch.column(2):
                hashes = kmer_hashes(words_of(value.as_py() or ""), k)
                counts.append(len(np.unique(hashes)))
                found.append(order_sketches(hashes, sketches, minima))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1).cast(pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(run, schema)


def confirm(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY, k: int = K) -> DataFrame:
    """The pairs (key, head) whose texts (key, text) are similar."""
    left = texts.select("key", F.col("text").alias("left_text"))
    right = texts.select(F.col("key").alias("head"), F.col("text").alias("right_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = [
                i
                for i, (a, b) in enumerate(zip(batch.column(2), batch.column(3), strict=True))
                if similar(a.as_py(), b.as_py(), similarity, k)
            ]
            chosen = pa.array(hit, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(chosen).cast(pa.binary()) for i in (0, 1)],
                names=["key", "head"],
            )

    joined = pairs.select("key", "head").join(left, "key").join(right, "head")
    return joined.select("key", "head", "left_text", "right_text").mapInArrow(
        run, "key binary, head binary"
    )


def components(links: DataFrame) -> DataFrame:
    """(key, component) for every key in links (key, head): the smallest key
    that can be reached. Labels spread along links, and jump along labels, until
    nothing changes; every round is written out."""
    both = materialise(
        links.select("key", "head").union(links.select("head", "key")).distinct(), "links"
    )
    labels = materialise(
        both.groupBy("key").agg(F.min("head").alias("low")).select(
            "key", F.least("key", "low").alias("component")
        ),
        "labels",
    )
    while True:
        # The smallest label among the neighbours …
        near = both.join(labels.withColumnRenamed("key", "head"), "head")
        lowest = near.groupBy("key").agg(F.min("component").alias("low"))
        spread = labels.join(lowest, "key").select(
            "key", F.col("component").alias("was"), F.least("component", "low").alias("next")
        )
        # … and the label that this one had itself.
        jump = labels.select(F.col("key").alias("next"), F.col("component").alias("beyond"))
        moved = materialise(
            spread.join(jump, "next").select(
                "key", F.least("next", "beyond").alias("component"), "was"
            ),
            "labels",
        )
        labels = moved.select("key", "component")
        if moved.filter(F.col("component") != F.col("was")).isEmpty():
            return labels


def kmer_ranks(texts: DataFrame, k: int = K) -> np.ndarray:
    """A rank by frequency for each slot of k-mer hashes, over texts (key, text).
    Frequent k-mers rank high; each task adds up its own counts first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(_SLOTS, np.int64)
        for batch in batches:
            for value in batch.column(0):
                hashes = np.unique(kmer_hashes(words_of(value.as_py() or ""), k))
                slots, times = np.unique(hashes & np.uint64(_SLOTS - 1), return_counts=True)
                n[slots.astype(np.int64)] += times
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(n[used], pa.int64())], names=["slot", "n"]
        )

    counted = texts.select("text").mapInArrow(run, "slot long, n long").groupBy("slot").agg(
        F.sum("n").alias("n")
    )
    rows = counted.toArrow()
    ranks = np.zeros(_SLOTS, np.uint8)
    ranks[rows["slot"].to_numpy()] = np.minimum(255, 1 + 6 * np.log2(rows["n"].to_numpy()))
    return ranks


def parities(hashes: np.ndarray) -> np.ndarray:
    """Whether each of 64 * PARITY_WORDS hash cells holds an odd number of the
    different k-mers. A k-mer that only one of two texts has changes one parity,
    so texts have at least as many such k-mers as their parities differ."""
    cells = 64 * PARITY_WORDS
    cell = (_mix(hashes ^ _STEP) % np.uint64(cells)).astype(np.int64)
    odd = np.bincount(cell, minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def rare_kmers(
    texts: DataFrame, ranks: np.ndarray, similarity: float = SIMILARITY, k: int = K
) -> DataFrame:
    """(key, kmers, bucket, place, indexed, parities): the first k-mers of each
    text when its k-mers are put in one order for all texts, rare ones first.

    Two similar texts share one of these, and the smaller text has it indexed: a
    pair that shares none of them has too few k-mers left to share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, sizes, buckets, places, indexed, odd = [], [], [], [], [], []
            for i, value in enumerate(batch.column(1)):
                hashes = np.unique(kmer_hashes(words_of(value.as_py() or ""), k))
                n = len(hashes)
                if not n:
                    continue
                rank = ranks[(hashes & np.uint64(_SLOTS - 1)).astype(np.int64)]
                first = hashes[np.lexsort((hashes, rank))]
                probe = n - int(np.ceil(similarity * n - 1e-9)) + 1
                index = n - int(np.ceil(2 * similarity / (1 + similarity) * n - 1e-9)) + 1
                first = first[:probe].view(np.int64)
                row.append(np.full(len(first), i))
                sizes.append(np.full(len(first), n))
                buckets.append(first)
                places.append(np.arange(len(first)))
                indexed.append(np.arange(len(first)) < index)
                odd.append(np.tile(parities(hashes), (len(first), 1)))
            if row:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.concatenate(row), pa.int64())).cast(pa.binary()),
                        pa.array(np.concatenate(sizes), pa.int64()),
                        pa.array(np.concatenate(buckets), pa.int64()),
                        pa.array(np.concatenate(places), pa.int64()),
                        pa.array(np.concatenate(indexed), pa.bool_()),
                        *[pa.array(x) for x in np.concatenate(odd).T],
                    ],
                    names=["key", "kmers", "bucket", "place", "indexed", *PARITIES],
                )

    columns = "key binary, kmers long, bucket long, place long, indexed boolean, "
    return texts.select("key", "text").mapInArrow(
        run, columns + ", ".join(f"{p} long" for p in PARITIES)
    )


def possible_pairs(rows: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(key, head) of all texts of different components that can be similar, from
    ``rare_kmers`` with the component.

    At the first k-mer that two texts share, what is left of either bounds what
    they can have in common, and the parities bound how many k-mers only one of
    them has; both bounds are exact. The fullest component of a bucket is not
    compared with itself.
    """
    shares = rows.groupBy("bucket", "component").agg(
        F.count("*").alias("n"), F.max("indexed").alias("indexed")
    )
    mixed = (
        shares.groupBy("bucket")
        .agg(
            F.count("*").alias("components"),
            F.max("indexed").alias("any_indexed"),
            F.max(F.struct("n", "component")).alias("most"),
        )
        .filter((F.col("components") > 1) & F.col("any_indexed"))
        .select("bucket", F.col("most.component").alias("main"))
    )
    sides = materialise(rows.join(mixed, "bucket"), "rare-buckets")
    other = sides.select(
        "bucket",
        F.col("key").alias("head"),
        F.col("component").alias("head_component"),
        F.col("kmers").alias("head_kmers"),
        F.col("place").alias("head_place"),
        F.col("indexed").alias("head_indexed"),
        *[F.col(p).alias(f"head_{p}") for p in PARITIES],
    )
    left = sides.filter(F.col("component") != F.col("main")).alias("a")
    right = other.alias("b")
    most = F.least(F.col("kmers") - F.col("place"), F.col("head_kmers") - F.col("head_place"))
    apart = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"head_{p}"))) for p in PARITIES), F.lit(0))
    can = (
        (F.col("a.bucket") == F.col("b.bucket"))
        & (F.col("component") != F.col("head_component"))
        & (
            (F.col("indexed") & (F.col("kmers") <= F.col("head_kmers")))
            | (F.col("head_indexed") & (F.col("head_kmers") <= F.col("kmers")))
        )
        & (
            most * F.lit((1 + similarity) / similarity)
            >= F.col("kmers") + F.col("head_kmers") - F.lit(1e-6)
        )
        & (
            apart
            <= (F.col("kmers") + F.col("head_kmers")) * F.lit((1 - similarity) / (1 + similarity))
            + F.lit(1e-6)
        )
    )
    return (
        left.join(right, can)
        .select(F.least("key", "head").alias("key"), F.greatest("key", "head").alias("head"))
        .distinct()
    )


def _with_component(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("component", F.col("key"))
    return rows.join(labels, "key", "left").withColumn(
        "component", F.coalesce("component", "key")
    )


def _merge_labels(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Labels after further links: only the components that these links join are
    worked out anew."""
    ends = found.select("key").union(found.select(F.col("head").alias("key"))).distinct()
    known = materialise(
        labels.join(ends, "key", "full_outer").select(
            "key", F.coalesce("component", "key").alias("component")
        ),
        "labels",
    )
    left = known.select("key", F.col("component").alias("low"))
    right = known.select(F.col("key").alias("head"), F.col("component").alias("high"))
    joined = components(
        found.join(left, "key")
        .join(right, "head")
        .select(F.col("low").alias("key"), F.col("high").alias("head"))
    ).select(F.col("key").alias("component"), F.col("component").alias("merged"))
    return materialise(
        known.join(joined, "component", "left").select(
            "key", F.coalesce("merged", "component").alias("component")
        ),
        "labels",
    )


def _mixed(rows: DataFrame) -> DataFrame:
    """(bucket, n) of the buckets that still hold several components."""
    return (
        rows.groupBy("bucket")
        .agg(
            F.count("*").alias("n"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        .filter(F.col("low") != F.col("high"))
        .select("bucket", "n")
    )


def text_classes(
    nodes: DataFrame,
    texts_of,
    similarity: float = SIMILARITY,
    k: int = K,
    agreeing: int = AGREEING,
) -> DataFrame:
    """(key, component) of the texts that are linked to another.

    ``nodes`` has (key, kmers, sketch) of different texts; ``texts_of(keys)``
    gives (key, text) for a table of keys.

    Texts with an equal sketch share a bucket. Each bucket compares its texts
    with one head, the one whose buckets are fullest, so a group of n copies
    takes n comparisons, not n * n. All texts of buckets that still hold several
    components after that are compared by ``possible_pairs``, so every similar
    pair with an equal sketch is linked.
    """
    rows = nodes.select("key", F.explode("sketch").alias("bucket"), F.col("key").alias("component"))
    rows = materialise(rows, "bucket-rows")
    mixed = materialise(_mixed(rows), "buckets")
    active = materialise(rows.join(mixed, "bucket"), "shared-buckets")
    texts = texts_of(active.select("key").distinct())
    fullness = active.groupBy("key").agg(F.sum("n").alias("fullness"))
    heads = (
        active.join(fullness, "key")
        .groupBy("bucket")
        .agg(F.max(F.struct("fullness", "key")).alias("top_of"))
        .select("bucket", F.col("top_of.key").alias("head"))
    )
    heads = materialise(heads, "heads")
    pairs = (
        active.join(heads, "bucket")
        .filter(F.col("key") != F.col("head"))
        .select("key", "head")
        .distinct()
    )
    own = nodes.select("key", "kmers", "sketch")
    other = nodes.select(
        F.col("key").alias("head"),
        F.col("kmers").alias("head_kmers"),
        F.col("sketch").alias("head_sketch"),
    )
    close = F.least("kmers", "head_kmers") >= F.lit(similarity) * F.greatest(
        "kmers", "head_kmers"
    ) - F.lit(1e-9)
    likely = (
        materialise(pairs, "pairs")
        .join(own, "key")
        .join(other, "head")
        .filter(close & (F.size(F.array_intersect("sketch", "head_sketch")) >= agreeing))
        .select("key", "head")
    )
    found = materialise(confirm(likely, texts, similarity, k), "confirmed")
    labels = None if found.isEmpty() else components(found)
    left_over = _with_component(active.select("key", "bucket"), labels)
    left_over = materialise(left_over, "left-over")
    unsettled = left_over.join(_mixed(left_over).select("bucket"), "bucket", "left_semi")
    unsettled = materialise(unsettled.select("key", "component").distinct(), "unsettled")
    if not unsettled.isEmpty():
        some = materialise(texts.join(unsettled, "key"), "unsettled-texts")
        rare = rare_kmers(some, kmer_ranks(some, k), similarity, k)
        rare = materialise(rare.join(unsettled, "key"), "rare-kmers")
        pairs = materialise(possible_pairs(rare, similarity), "pairs")
        found = materialise(confirm(pairs, some.select("key", "text"), similarity, k), "confirmed")
        if not found.isEmpty():
            labels = components(found) if labels is None else _merge_labels(labels, found)
    empty = nodes.select("key", F.col("key").alias("component")).limit(0)
    return empty if labels is None else labels


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity: float = SIMILARITY,
    k: int = K,
    sketches: int = SKETCHES,
    minima: int = MINIMA,
) -> DataFrame:
    """(id, key, class_id, class_size, kept), one row for each row of ``docs``;
    the first column has the name of the id column.

    Two texts are linked if their sets of k-mers of lower-case words and their
    aligned words both have at least the given similarity; equal texts always
    are. A class holds what links connect. class_id is its smallest id, kept is
    true for the one text of the class that has it, class_size counts rows.

    NULL texts count as empty. All texts without a word that are equal form one
    class; texts with fewer than k words are one k-mer. Rows without id come
    last in a class; its class_id is NULL if no row has one. Rows with equal id
    and text are both marked kept. An empty table gives an empty table.
    """
    rows = docs.select(quoted(id_column).alias("id"), plain_text(text_column).alias("text"))
    keyed = rows.select("id", text_key(F.col("text")).alias("key"), "text")
    sketched = materialise(sketch_texts(keyed, k, sketches, minima), "sketched")
    nodes = materialise(
        sketched.select("key", "kmers", "sketch").dropDuplicates(["key"]), "sketches"
    )

    def texts_of(keys: DataFrame) -> DataFrame:
        # Equal texts become one before the shuffle; then the rest is left out.
        one = keyed.groupBy("key").agg(F.first("text").alias("text"))
        return materialise(one.join(keys, "key", "left_semi"), "candidate-texts")

    labels = text_classes(nodes, texts_of, similarity, k)
    members = materialise(
        sketched.select("id", "key")
        .join(labels, "key", "left")
        .select("id", "key", F.coalesce("component", "key").alias("component")),
        "members",
    )
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key")).alias("first")
    classes = materialise(
        members.groupBy("component").agg(first, F.count("*").alias("class_size")), "classes"
    )
    return members.join(classes, "component").select(
        F.col("id").alias(id_column),
        "key",
        F.col("first.id").alias("class_id"),
        "class_size",
        (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key"))).alias(
            "kept"
        ),
    )


def keep_one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of each class stays,
    the one with the smallest id."""
    classes = near_duplicates(docs, id_column, text_column)
    kept_id = spare_name(docs, "_kept_id")
    kept_key = spare_name(docs, "_kept_key", [kept_id])
    kept = materialise(
        classes.filter("kept")
        .groupBy(quoted(id_column).alias(kept_id), F.col("key").alias(kept_key))
        .agg(F.count("*").alias("copies")),
        "kept",
    )
    same = quoted(id_column).eqNullSafe(F.col(kept_id)) & (
        text_key(plain_text(text_column)) == F.col(kept_key)
    )
    left = docs.join(kept.select(kept_id, kept_key), same, "left_semi")
    if kept.filter("copies > 1").isEmpty():
        return left
    # Repeated rows: equal id and text.
    return left.dropDuplicates([id_column, text_column])
