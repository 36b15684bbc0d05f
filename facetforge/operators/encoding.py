"""Category vocabularies, indexing and one-hot encoding.

A vocabulary is a table (attribute, category, n, idx): idx orders the categories
of an attribute by falling frequency, equal frequencies by rising text. NULL is
not a category. Three encoders share it:

* ``encoder`` builds a reusable ML pipeline that yields the feature vector; its
  label lists live on the driver, so the vocabulary size is checked first;
* ``encode_rows`` joins with the vocabulary instead and yields the same vectors
  for vocabularies of any size;
* ``one_hot_positions`` does too and yields the ones of the same matrix as rows.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from facetforge.config import ClassificationTask
from facetforge.functions.columns import binary_label, column
from facetforge.operators.ordering import number_rows
from facetforge.storage import materialise

# Largest vocabulary (all attributes together), in categories and in bytes of
# text, that may be held on the driver, in one task or in a broadcast. Larger ones
# take the distributed ways below.
MAX_LOCAL_CATEGORIES = 100_000
MAX_LOCAL_BYTES = 32 * 1024 * 1024
# Longest category that counts as short in the broadcast part of a large vocabulary.
SHORT_CATEGORY_BYTES = 256
# Over how many keys the rows of a common long category are spread.
SALTS = 64


# Column names that the job itself adds.
RESERVED_NAMES = frozenset(
    {"label", "features", "weight", "fold", "rawPrediction", "probability", "prediction"}
)


def feature_columns(df: DataFrame, task: ClassificationTask) -> list[str]:
    """The attributes to encode: those asked for, or all but target and keys."""
    if task.features is not None:
        attributes = list(task.features)
    else:
        attributes = [c for c in df.columns if c != task.target and c not in task.keys]
    taken = RESERVED_NAMES.intersection([*attributes, *task.keys])
    if taken:
        raise ValueError(f"rename columns whose names the job uses itself: {sorted(taken)}")
    return attributes


def with_label(df: DataFrame, task: ClassificationTask, name: str = "label") -> DataFrame:
    labelled = df.withColumn(name, binary_label(column(task.target), task.positive, task.null_label))
    return labelled.filter(F.col(name).isNotNull()) if task.null_label == "drop" else labelled


def as_categories(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Attributes as text, so that numbers, dates and booleans are categories too."""
    dotted = [a for a in attributes if "." in a]
    if dotted:
        raise ValueError(f"rename attributes with dots before encoding: {dotted}")
    return df.withColumns({a: column(a).cast("string") for a in attributes})


class VocabularyTooLarge(ValueError):
    """More categories than label lists on the driver may hold."""


@dataclass(frozen=True)
class Vocabulary:
    attributes: tuple[str, ...]
    table: DataFrame  # attribute, category, n, idx
    sizes: dict[str, int]
    text_bytes: int
    local_limit: int = MAX_LOCAL_CATEGORIES

    def offsets(self) -> dict[str, int]:
        """First position of each attribute's block in the feature vector."""
        offsets, width = {}, 0
        for attribute in self.attributes:
            offsets[attribute] = width
            width += self.sizes[attribute]
        return offsets

    @property
    def width(self) -> int:
        return sum(self.sizes.values())

    def is_local(self) -> bool:
        return self.width <= self.local_limit and self.text_bytes <= MAX_LOCAL_BYTES


def category_counts(
    df: DataFrame, attributes: Sequence[str], weight: str | None = None
) -> DataFrame:
    """(attribute, category, n) for all attributes in one pass, with partial
    counts before the shuffle."""
    text = as_categories(df, attributes)
    extra = [column(weight).alias("_weight")] if weight else []
    long = text.select(*[column(a) for a in attributes], *extra).unpivot(
        ["_weight"] if weight else [], [column(a) for a in attributes], "attribute", "category"
    )
    n = F.sum("_weight").cast("bigint") if weight else F.count("*")
    return long.filter(F.col("category").isNotNull()).groupBy("attribute", "category").agg(n.alias("n"))


def rank_categories(counts: DataFrame, large: Collection[str] = ()) -> DataFrame:
    """Add idx. Small attributes are ranked by a window per attribute; those
    named in ``large`` hold too much for one task and are ranked by a
    distributed sort."""
    by_rank = [F.col("n").desc(), F.col("category").asc()]
    small = counts.filter(~F.col("attribute").isin(*large)) if large else counts
    per_attribute = Window.partitionBy("attribute").orderBy(*by_rank)
    ranked = small.withColumn("idx", (F.row_number().over(per_attribute) - 1).cast("bigint"))
    for attribute in large:
        numbered = number_rows(counts.filter(F.col("attribute") == attribute), by_rank, "_number")
        ranked = ranked.unionByName(
            numbered.withColumn("idx", F.col("_number") - F.lit(1)).drop("_number")
        )
    return ranked


def fit_vocabulary(
    df: DataFrame,
    attributes: Sequence[str],
    weight: str | None = None,
    local_limit: int = MAX_LOCAL_CATEGORIES,
) -> Vocabulary:
    """Count and rank the categories of all attributes in one scan of ``df``."""
    counts = materialise(category_counts(df, attributes, weight), "category-counts")
    # One row per attribute.
    sized = counts.groupBy("attribute").agg(
        F.count("*").alias("size"), F.sum(F.octet_length("category")).alias("bytes")
    )
    found = {r["attribute"]: (r["size"], r["bytes"]) for r in sized.collect()}
    sizes = {a: found.get(a, (0, 0))[0] for a in attributes}
    text = {a: found.get(a, (0, 0))[1] for a in attributes}
    large = [a for a in attributes if sizes[a] > local_limit or text[a] > MAX_LOCAL_BYTES]
    ranked = rank_categories(counts, large)
    return Vocabulary(tuple(attributes), ranked, sizes, sum(text.values()), local_limit)


def _label_lists(vocabulary: Vocabulary) -> dict[str, list[str]]:
    if not vocabulary.is_local():
        raise VocabularyTooLarge(
            f"{vocabulary.width} categories with {vocabulary.text_bytes} bytes are too many for a "
            f"reusable encoder with local label lists (at most {vocabulary.local_limit} and "
            f"{MAX_LOCAL_BYTES}); use encode_rows and wide_boosting, or leave out the largest attributes: "
            f"{vocabulary.sizes}"
        )
    labels: dict[str, list[str]] = {a: [] for a in vocabulary.attributes}
    for row in sorted(vocabulary.table.collect(), key=lambda r: (r["attribute"], r["idx"])):
        labels[row["attribute"]].append(row["category"])
    return labels


def encoder(df: DataFrame, vocabulary: Vocabulary, output: str = "features") -> PipelineModel:
    """Index, one-hot encode and assemble. Unseen and NULL categories give an
    all-zero block; a block is as wide as its attribute has categories.

    No data is read beyond the vocabulary: block widths come from the metadata
    of the index columns.
    """
    labels = _label_lists(vocabulary)
    # An attribute that is NULL in every row has no categories and no block.
    attributes = [a for a in vocabulary.attributes if labels[a]]
    if not attributes:
        raise ValueError("no attribute has any category")
    # One model for all attributes would need lists of one length: in PySpark,
    # from_arrays_of_labels fills shorter ones up with NULL labels.
    indexers = [
        StringIndexerModel.from_labels(labels[a], a, f"{a}_indexed", handleInvalid="keep")
        for a in attributes
    ]
    indexed = PipelineModel(stages=indexers).transform(as_categories(df, attributes))
    one_hot = OneHotEncoder(
        inputCols=[f"{a}_indexed" for a in attributes],
        outputCols=[f"{a}_encoded" for a in attributes],
    ).fit(indexed)
    assembler = VectorAssembler(inputCols=[f"{a}_encoded" for a in attributes], outputCol=output)
    return PipelineModel(stages=[*indexers, one_hot, assembler])


def _with_index(df: DataFrame, attribute: str, vocabulary: Vocabulary) -> DataFrame:
    """Add the index of one attribute by joins with the vocabulary; unseen and
    NULL categories get the number of categories.

    The most frequent short categories are joined by broadcast. The rows they
    settle take part in the shuffle join under keys of their own that match
    nothing, so neither a common category nor NULL gathers in one task. Long
    categories that are common are met by as many copies of their vocabulary
    row as SALTS, and their rows are spread over these.
    """
    size = vocabulary.sizes[attribute]
    share = max(1, vocabulary.local_limit // len(vocabulary.attributes))
    own = vocabulary.table.filter(F.col("attribute") == attribute)
    handy = (F.col("idx") < share) & (F.octet_length("category") <= SHORT_CATEGORY_BYTES)
    frequent = own.filter(handy).select(F.col("category").alias("_seen"), F.col("idx").alias("_near"))
    rare = own.filter(~handy)
    spread = rare.filter(F.col("idx") < share).select(
        "category", "idx", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    )
    once = rare.filter(F.col("idx") >= share).select("category", "idx", F.lit(-1).alias("_salt"))
    right = spread.unionByName(once).select(
        F.col("category").alias("_rare"), F.col("idx").alias("_far"), "_salt"
    )
    # Whether the category is one of the few common long ones; bounded by the
    # broadcast share, as hashes.
    common = F.broadcast(
        spread.select(F.xxhash64("category").alias("_hash"), F.lit(True).alias("_common")).distinct()
    )
    category = column(attribute)
    settled = df.join(F.broadcast(frequent), category == F.col("_seen"), "left").drop("_seen")
    open_key = F.col("_near").isNull() & category.isNotNull()
    row = F.monotonically_increasing_id()
    keyed = (
        settled.withColumn("_row", row)
        .withColumn("_hash", F.xxhash64(category))
        .join(common, "_hash", "left")
        .withColumn(
            "_own_salt",
            F.when(~open_key, -2 - F.pmod("_row", F.lit(1 << 20)))
            .when(F.col("_common"), F.pmod("_row", F.lit(SALTS)))
            .otherwise(F.lit(-1)),
        )
        .withColumn("_own_key", F.when(open_key, category).otherwise(F.lit("")))
    )
    joined = keyed.join(
        right,
        (F.col("_own_key") == F.col("_rare")) & (F.col("_own_salt") == F.col("_salt")),
        "left",
    )
    index = F.coalesce("_near", "_far", F.lit(size)).cast("double")
    return joined.select(
        *[column(c) for c in df.columns], index.alias(f"{attribute}_indexed")
    )


def encode_rows(
    df: DataFrame, vocabulary: Vocabulary, keep: Sequence[str], output: str = "features"
) -> DataFrame:
    """``keep`` and the feature vector, for vocabularies of any size: the same
    vectors as those of ``encoder``.

    Attributes are indexed by joins with the vocabulary where it is too large
    for label lists; block widths come from its sizes. Vectors are sparse, so a
    row costs one entry for each attribute however wide the vector is.
    """
    attributes = [a for a in vocabulary.attributes if vocabulary.sizes[a]]
    if not attributes:
        raise ValueError("no attribute has any category")
    if vocabulary.is_local():
        return encode(df, encoder(df, vocabulary, output), attributes, [*keep, output])
    names = {k: f"_keep_{i}" for i, k in enumerate(keep)}
    rows = as_categories(
        df.select(*[column(k).alias(n) for k, n in names.items()], *[column(a) for a in attributes]),
        attributes,
    )
    for attribute in attributes:
        rows = _with_index(rows, attribute, vocabulary)
    # With "keep", the encoder takes one category more than it has seen.
    nominal = {
        a: {"ml_attr": {"type": "nominal", "num_vals": vocabulary.sizes[a] + 1}} for a in attributes
    }
    rows = rows.withColumns(
        {
            f"{a}_indexed": F.col(f"{a}_indexed").alias(f"{a}_indexed", metadata=nominal[a])
            for a in attributes
        }
    )
    one_hot = OneHotEncoder(
        inputCols=[f"{a}_indexed" for a in attributes],
        outputCols=[f"{a}_encoded" for a in attributes],
    ).fit(rows)
    assembler = VectorAssembler(inputCols=[f"{a}_encoded" for a in attributes], outputCol=output)
    encoded = assembler.transform(one_hot.transform(rows))
    return encoded.select(*[F.col(n).alias(k) for k, n in names.items()], output)


def encode(
    df: DataFrame, model: PipelineModel, attributes: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Run an encoder (or a whole classifier) and drop its working columns."""
    worked = [f"{a}_{suffix}" for a in attributes for suffix in ("indexed", "encoded")]
    encoded = model.transform(as_categories(df, attributes)).drop(*worked)
    return encoded.select(*[column(c) for c in keep]) if keep else encoded


def one_hot_positions(df: DataFrame, keys: Sequence[str], vocabulary: Vocabulary) -> DataFrame:
    """The ones of the one-hot matrix: keys, attribute, pos.

    A zero block (unseen or NULL category) has no row. In a large vocabulary the
    most frequent categories, up to the local limit, are joined by broadcast, so
    rows with a common category are never shuffled. Only rows with a rare or
    very long category take the shuffle join.
    """
    attributes = list(vocabulary.attributes)
    key_names = [f"_key_{i}" for i in range(len(keys))]
    picked = df.select(
        *[column(k).alias(name) for k, name in zip(keys, key_names)], *[column(a) for a in attributes]
    )
    long = (
        as_categories(picked, attributes)
        .unpivot(key_names, [column(a) for a in attributes], "attribute", "category")
        .filter(F.col("category").isNotNull())
    )
    offsets = vocabulary.offsets()
    first = F.coalesce(
        *[F.when(F.col("attribute") == a, F.lit(offset)) for a, offset in offsets.items()]
    )
    ranks = vocabulary.table.select("attribute", "category", (first + F.col("idx")).alias("pos"), "idx")
    if vocabulary.is_local():
        found = long.join(F.broadcast(ranks.drop("idx")), ["attribute", "category"])
    else:
        share = max(1, vocabulary.local_limit // len(attributes))
        handy = (F.col("idx") < share) & (F.octet_length("category") <= SHORT_CATEGORY_BYTES)
        frequent = F.broadcast(ranks.filter(handy).drop("idx"))
        rare = ranks.filter(~handy).drop("idx")
        rest = long.join(frequent, ["attribute", "category"], "left_anti")
        found = long.join(frequent, ["attribute", "category"]).unionByName(
            rest.join(rare, ["attribute", "category"])
        )
    return found.select(
        *[F.col(name).alias(k) for k, name in zip(keys, key_names)], "attribute", "pos"
    )
