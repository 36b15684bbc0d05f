"""Second-order boosted trees over categories, for vocabularies of any size.

The features are those of a one-hot matrix: a split asks whether an attribute
has one category. The matrix itself is never made. Each level of a tree is one
aggregation, sums of gradients and hessians by node, attribute and category,
added up before they are shuffled; the best split of each node is found in Spark
too, and only these, at most 2^depth rows, come to the driver. NULL and unseen
categories answer every question with no.

Leaves are Newton steps with an L2 term: -G / (H + l2) times the step size.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetforge.config import BoostSettings, ClassificationTask
from facetforge.functions.columns import column
from facetforge.operators.boosting import distinct_rows
from facetforge.operators.encoding import (
    Vocabulary,
    as_categories,
    encode_rows,
    feature_columns,
    with_label,
)
from facetforge.storage import materialise

# Gains are compared after rounding, so that equal splits tie whatever the order
# of additions was; ties go to the first attribute, then to the first category.
GAIN_DECIMALS = 9
# Trees whose margins are worked out anew in every pass before they are stored.
TREES_PER_COPY = 4

_TREES = "array<struct<attribute:array<int>,category:array<string>,leaf:array<double>>>"


@dataclass(frozen=True)
class WideSettings:
    """The parameters of ``BoostSettings`` and those of second-order boosting.

    l2                added to the hessians of a leaf
    min_child_weight  smallest sum of hessians on either side of a split
    min_gain          a split must gain more than this
    patience          with validation rows: stop after so many rounds without a
                      smaller loss on them, and keep the rounds up to the smallest
    """

    boost: BoostSettings = BoostSettings()
    l2: float = 1.0
    min_child_weight: float = 1.0
    min_gain: float = 0.0
    patience: int | None = None


@dataclass(frozen=True)
class Tree:
    """Node 0 is the root; the children of node i are 2i + 1 (yes) and 2i + 2.
    ``attribute`` is -1 in leaves. Gains and leaf values are of the nodes."""

    attribute: tuple[int, ...]
    category: tuple[str | None, ...]
    leaf: tuple[float, ...]
    gain: tuple[float, ...]


@dataclass(frozen=True)
class WideModel:
    attributes: tuple[str, ...]
    trees: tuple[Tree, ...]
    losses: tuple[float, ...] = ()  # on validation rows, after each round
    rounds_tried: int = 0

    def depth(self) -> int:
        return max((int(math.log2(len(t.leaf) + 1)) - 1 for t in self.trees), default=0)


def _leaf_of(tree: Column, categories: Column, depth: int) -> Column:
    """The number of the leaf that a row ends in."""

    def step(node: Column, _: Column) -> Column:
        attribute = F.get(tree["attribute"], node)
        yes = F.get(categories, attribute) == F.get(tree["category"], node)
        return F.when(attribute < 0, node).when(yes, 2 * node + 1).otherwise(2 * node + 2)

    if not depth:
        return F.lit(0)
    return F.aggregate(F.array_repeat(F.lit(0), depth), F.lit(0), step)


def _trees_column(trees: Sequence[Tree]) -> Column:
    """The trees as one constant."""
    written = json.dumps(
        [{"attribute": t.attribute, "category": t.category, "leaf": t.leaf} for t in trees]
    )
    return F.from_json(F.lit(written), _TREES)


def margin(trees: Sequence[Tree], categories: Column, depth: int) -> Column:
    """The sum of the leaves that a row of categories ends in."""
    if not trees:
        return F.lit(0.0)

    def add(total: Column, tree: Column) -> Column:
        return total + F.get(tree["leaf"], _leaf_of(tree, categories, depth))

    return F.aggregate(_trees_column(trees), F.lit(0.0), add)


def _probability(m: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-m))


def _log_loss(m: Column, label: Column) -> Column:
    """log(1 + exp(-m)) for a positive row, of -m for a negative one, without
    overflow."""
    signed = F.when(label > 0, -m).otherwise(m)
    return F.greatest(signed, F.lit(0.0)) + F.log1p(F.exp(-F.abs(signed)))


def _score(g: Column, h: Column, l2: float) -> Column:
    return g * g / (h + F.lit(l2))


def _best_splits(
    rows: DataFrame, sums: dict[int, tuple[float, float]], settings: WideSettings
) -> dict[int, tuple]:
    """The best split of each open node, from rows (node, g, h, categories)."""
    cells = (
        rows.select("node", "g", "h", F.posexplode("categories").alias("attribute", "category"))
        .filter(F.col("category").isNotNull())
        .groupBy("node", "attribute", "category")
        .agg(F.sum("g").alias("yes_g"), F.sum("h").alias("yes_h"))
    )
    # The sums of all rows of a node, as two constants.
    first = min(sums)
    span = range(first, max(sums) + 1)
    all_g, all_h = (
        F.get(F.lit([float(sums.get(n, (0.0, 0.0))[i]) for n in span]), F.col("node") - first)
        for i in (0, 1)
    )
    yes_g, yes_h = F.col("yes_g"), F.col("yes_h")
    no_g, no_h = all_g - yes_g, all_h - yes_h
    gain = F.round(
        (
            _score(yes_g, yes_h, settings.l2)
            + _score(no_g, no_h, settings.l2)
            - _score(all_g, all_h, settings.l2)
        )
        / 2,
        GAIN_DECIMALS,
    )
    least = F.lit(settings.min_child_weight)
    allowed = cells.withColumn("loss", -gain).filter(
        (yes_h >= least) & (no_h >= least) & (F.col("loss") < F.lit(-settings.min_gain))
    )
    best = allowed.groupBy("node").agg(
        F.min(F.struct("loss", "attribute", "category", "yes_g", "yes_h")).alias("best")
    )
    return {r["node"]: tuple(r["best"]) for r in best.collect()}


def grow_tree(rows: DataFrame, settings: WideSettings) -> Tree:
    """One tree on rows (g, h, categories)."""
    depth = settings.boost.max_depth
    size = 2 ** (depth + 1) - 1
    attribute, category = [-1] * size, [None] * size
    gain, leaf = [0.0] * size, [0.0] * size
    found = rows.agg(F.sum("g").alias("g"), F.sum("h").alias("h")).first()
    sums = {0: (found["g"] or 0.0, found["h"] or 0.0)}
    known = dict(sums)
    for level in range(depth):
        partial = Tree(tuple(attribute), tuple(category), tuple(leaf), tuple(gain))
        node = _leaf_of(_trees_column([partial])[0], F.col("categories"), level)
        placed = rows.withColumn("node", node)
        if level:
            placed = placed.filter(F.col("node") >= min(sums))
        splits = _best_splits(placed, sums, settings)
        children = {}
        for n, (loss, a, c, g, h) in splits.items():
            attribute[n], category[n], gain[n] = a, c, -loss
            children[2 * n + 1] = (g, h)
            children[2 * n + 2] = (sums[n][0] - g, sums[n][1] - h)
        if not children:
            break
        known |= children
        sums = children
    for n, (g, h) in known.items():
        if attribute[n] < 0:
            leaf[n] = -g / (h + settings.l2) * settings.boost.step_size if h + settings.l2 else 0.0
    return Tree(tuple(attribute), tuple(category), tuple(leaf), tuple(gain))


def fit_wide(
    df: DataFrame,
    task: ClassificationTask,
    settings: WideSettings = WideSettings(),
    validation: Column | None = None,
    start: WideModel | None = None,
) -> WideModel:
    """Train on all labelled rows of ``df``; there is no limit to the categories.

    Equal rows become one row with a weight. ``validation`` marks rows that no
    tree is fitted on; the loss on them is recorded after each round, and with
    ``patience`` training ends when it no longer falls. ``start`` is a model that
    further rounds are added to: its margins are where they begin. The losses
    then are those of the added rounds.

    Rows without a label are left out. A table without rows gives trees of one
    leaf 0.
    """
    attributes = feature_columns(df, task)
    if start is not None and tuple(attributes) != start.attributes:
        raise ValueError(f"the model has other attributes: {start.attributes}")
    labelled = with_label(df, task)
    if validation is not None:
        labelled = labelled.withColumn("fold", F.coalesce(validation, F.lit(False)).cast("int"))
    # Labels and folds are columns of the job itself, which attributes cannot have.
    extra = ["fold"] if validation is not None else []
    compact = distinct_rows(labelled, attributes, extra)
    held_out = (F.col("fold") == 1) if validation is not None else F.lit(False)
    categories = F.array(*[column(a) for a in attributes])
    base = compact.select(
        "label", "weight", held_out.alias("held_out"), categories.alias("categories")
    )
    trees = list(start.trees) if start is not None else []
    before, depth = len(trees), max(settings.boost.max_depth, start.depth() if start else 0)
    state = base.withColumn("margin", margin(trees, F.col("categories"), depth))
    state = materialise(state, "margins")
    stored, losses = len(trees), []
    p = _probability(F.col("margin"))
    for number in range(settings.boost.rounds):
        now = state.withColumn(
            "margin",
            F.col("margin") + margin(trees[stored:], F.col("categories"), depth),
        )
        gradients = now.filter(~F.col("held_out")).select(
            (F.col("weight") * (p - F.col("label"))).alias("g"),
            (F.col("weight") * p * (F.lit(1.0) - p)).alias("h"),
            "categories",
        )
        trees.append(grow_tree(gradients, settings))
        if len(trees) - stored == TREES_PER_COPY:
            state = materialise(
                state.withColumn(
                    "margin",
                    F.col("margin") + margin(trees[stored:], F.col("categories"), depth),
                ),
                "margins",
            )
            stored = len(trees)
        if validation is None:
            continue
        left = F.col("margin") + margin(trees[stored:], F.col("categories"), depth)
        judged = state.filter("held_out").agg(
            (F.sum(F.col("weight") * _log_loss(left, F.col("label"))) / F.sum("weight")).alias("loss")
        )
        loss = judged.first()["loss"]
        losses.append(float("nan") if loss is None else loss)
        if settings.patience is not None and loss is not None:
            best = losses.index(min(losses))
            if number - best >= settings.patience:
                break
    tried = len(trees) - before
    if settings.patience is not None and losses and not all(map(math.isnan, losses)):
        trees = trees[: before + losses.index(min(losses)) + 1]
    return WideModel(tuple(attributes), tuple(trees), tuple(losses), tried)


def score_wide(df: DataFrame, model: WideModel, task: ClassificationTask) -> DataFrame:
    """Keys, label (when the target is there), margin, probability (of the
    positive class) and prediction of every row; nothing is shuffled."""
    rows = with_label(df, task) if task.target in df.columns else df
    label = ["label"] if task.target in df.columns else []
    text = as_categories(
        rows.select(
            *[column(k).alias(f"_key_{i}") for i, k in enumerate(task.keys)],
            *label,
            *[column(a) for a in model.attributes],
        ),
        model.attributes,
    )
    categories = F.array(*[column(a) for a in model.attributes])
    placed = text.withColumn("_categories", categories)
    scored = placed.withColumn("margin", margin(model.trees, F.col("_categories"), model.depth()))
    p = _probability(F.col("margin"))
    return scored.select(
        *[F.col(f"_key_{i}").alias(k) for i, k in enumerate(task.keys)],
        *label,
        "margin",
        p.alias("probability"),
        (F.col("margin") > 0).cast("double").alias("prediction"),
    )


def score_with_vectors(
    df: DataFrame, model: WideModel, task: ClassificationTask, vocabulary: Vocabulary
) -> DataFrame:
    """Keys, label, features, rawPrediction, probability and prediction: the
    columns of ``boosting.score``, with sparse vectors as wide as the vocabulary."""
    rows = with_label(df, task) if task.target in df.columns else df
    label = ["label"] if task.target in df.columns else []
    keys = {k: f"_key_{i}" for i, k in enumerate(task.keys)}
    text = as_categories(
        rows.select(
            *[column(k).alias(n) for k, n in keys.items()],
            *label,
            *[column(a) for a in model.attributes],
        ),
        model.attributes,
    )
    categories = F.array(*[column(a) for a in model.attributes])
    placed = text.withColumn("_categories", categories)
    scored = placed.withColumn("_margin", margin(model.trees, F.col("_categories"), model.depth()))
    encoded = encode_rows(scored, vocabulary, [*keys.values(), *label, "_margin"])
    m = F.col("_margin")
    p = _probability(m)
    return encoded.select(
        *[F.col(n).alias(k) for k, n in keys.items()],
        *label,
        "features",
        array_to_vector(F.array(-m, m)).alias("rawPrediction"),
        array_to_vector(F.array(F.lit(1.0) - p, p)).alias("probability"),
        (m > 0).cast("double").alias("prediction"),
    )


def tree_table(spark: SparkSession, model: WideModel) -> DataFrame:
    """(tree, node, attribute, category, gain, leaf) of the nodes in use."""
    rows = []
    for number, tree in enumerate(model.trees):
        used = {0}
        for n, a in enumerate(tree.attribute):
            if a >= 0:
                used |= {2 * n + 1, 2 * n + 2}
        for n in sorted(used):
            a = tree.attribute[n]
            name = model.attributes[a] if a >= 0 else None
            value = None if a >= 0 else tree.leaf[n]
            rows.append((number, n, name, tree.category[n], tree.gain[n] if a >= 0 else None, value))
    return spark.createDataFrame(
        rows, "tree int, node int, attribute string, category string, gain double, leaf double"
    )


def save_wide(spark: SparkSession, model: WideModel, path: str) -> None:
    """The model as one row of JSON; nothing is replaced."""
    written = {
        "attributes": model.attributes,
        "trees": [vars(t) for t in model.trees],
        "losses": model.losses,
        "rounds_tried": model.rounds_tried,
    }
    spark.createDataFrame([(json.dumps(written),)], "value string").write.text(path)


def load_wide(spark: SparkSession, path: str) -> WideModel:
    found = json.loads(spark.read.text(path).first()["value"])
    trees = tuple(Tree(*(tuple(t[k]) for k in ("attribute", "category", "leaf", "gain"))) for t in found["trees"])
    return WideModel(
        tuple(found["attributes"]), trees, tuple(found["losses"]), found["rounds_tried"]
    )


def continue_rounds(settings: WideSettings, rounds: int) -> WideSettings:
    """The same settings with another number of rounds."""
    return replace(settings, boost=replace(settings.boost, rounds=rounds))
