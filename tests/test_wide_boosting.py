import math
import random

import pytest

from facetforge.config import BoostSettings, ClassificationTask
from facetforge.operators.boosting import prepare_training
from facetforge.operators.encoding import VocabularyTooLarge
from facetforge.operators.wide_boosting import (
    WideModel,
    WideSettings,
    continue_rounds,
    fit_wide,
    load_wide,
    save_wide,
    score_wide,
    tree_table,
)
from facetforge.plans.classify import run_classification

TASK = ClassificationTask(target="y", positive="p", keys=("k",))
SETTINGS = WideSettings(BoostSettings(step_size=0.3, max_depth=2, rounds=2), l2=1.0, min_child_weight=0.5)


def make_rows(n=400, seed=1, noise=0.1):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        a, b = f"a{rng.randrange(40)}", rng.choice(["x", "y", None])
        y = a < "a2" or (b == "x" and a > "a3")
        rows.append((k, a, b, "p" if y ^ (rng.random() < noise) else "n"))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(make_rows(), "k int, a string, b string, y string")


def by_hand(rows, settings, rounds):
    """Second-order boosting, every split of every node tried."""
    data = [((a, b), float(y == "p")) for _, a, b, y in rows]
    margins = [0.0] * len(data)
    trees = []
    for _ in range(rounds):
        g = [1 / (1 + math.exp(-m)) - y for m, (_, y) in zip(margins, data)]
        h = [(p := 1 / (1 + math.exp(-m))) * (1 - p) for m in margins]
        nodes, tree = {0: list(range(len(data)))}, {}
        for level in range(settings.boost.max_depth):
            for n in [n for n in nodes if 2**level - 1 <= n < 2 ** (level + 1) - 1]:
                members = nodes[n]
                big_g, big_h = sum(g[i] for i in members), sum(h[i] for i in members)
                options = []
                for f in (0, 1):
                    for c in sorted({data[i][0][f] for i in members} - {None}):
                        yes = [i for i in members if data[i][0][f] == c]
                        yg, yh = sum(g[i] for i in yes), sum(h[i] for i in yes)
                        if min(yh, big_h - yh) < settings.min_child_weight:
                            continue
                        score = lambda x, z: x * x / (z + settings.l2)
                        gain = (score(yg, yh) + score(big_g - yg, big_h - yh) - score(big_g, big_h)) / 2
                        options.append((-round(gain, 9), f, c))
                if options and min(options)[0] < 0:
                    loss, f, c = min(options)
                    tree[n] = (f, c, -loss)
                    nodes[2 * n + 1] = [i for i in members if data[i][0][f] == c]
                    nodes[2 * n + 2] = [i for i in members if data[i][0][f] != c]
        leaves = {}
        for n, members in nodes.items():
            if n not in tree:
                leaves[n] = -sum(g[i] for i in members) / (sum(h[i] for i in members) + settings.l2)
                leaves[n] *= settings.boost.step_size
                for i in members:
                    margins[i] += leaves[n]
        trees.append((tree, leaves))
    return trees, margins


def test_rounds_equal_brute_force(spark, table):
    model = fit_wide(table, TASK, SETTINGS)
    trees, margins = by_hand(make_rows(), SETTINGS, 2)
    found = tree_table(spark, model).collect()
    for number, (splits, leaves) in enumerate(trees):
        mine = {r["node"]: r for r in found if r["tree"] == number}
        assert set(mine) == set(splits) | set(leaves)
        for n, (f, c, gain) in splits.items():
            assert (mine[n]["attribute"], mine[n]["category"]) == ("ab"[f], c)
            assert mine[n]["gain"] == pytest.approx(gain, abs=1e-8)
        for n, value in leaves.items():
            assert mine[n]["leaf"] == pytest.approx(value, abs=1e-9)
    scored = score_wide(table, model, TASK).orderBy("k").collect()
    assert [r["margin"] for r in scored] == pytest.approx(margins, abs=1e-9)
    assert all((r["probability"] > 0.5) == (r["prediction"] == 1.0) for r in scored)


def test_further_rounds_equal_training_at_once(spark, table, tmp_path):
    whole = fit_wide(table, TASK, continue_rounds(SETTINGS, 5))
    three = fit_wide(table, TASK, continue_rounds(SETTINGS, 3))
    save_wide(spark, three, str(tmp_path / "model"))
    loaded = load_wide(spark, str(tmp_path / "model"))
    assert loaded == three
    both = fit_wide(table, TASK, SETTINGS, start=loaded)
    assert len(both.trees) == 5
    for one, other in zip(whole.trees, both.trees, strict=True):
        assert (one.attribute, one.category) == (other.attribute, other.category)
        assert one.leaf == pytest.approx(other.leaf, abs=1e-9)
    with pytest.raises(ValueError):
        fit_wide(table.withColumnRenamed("a", "c"), TASK, SETTINGS, start=loaded)


def test_training_stops_when_the_held_out_loss_rises(spark):
    rows = make_rows(600, seed=4, noise=0.35)
    table = spark.createDataFrame(rows, "k int, a string, b string, y string")
    settings = WideSettings(
        BoostSettings(step_size=1.0, max_depth=3, rounds=30), min_child_weight=0.1, patience=2
    )
    model = fit_wide(table, TASK, settings, validation=table["k"] % 3 == 0)
    best = model.losses.index(min(model.losses))
    assert len(model.trees) == best + 1 and model.rounds_tried == best + 3 < 30
    # The recorded loss is that of the rows that no tree was fitted on.
    held = score_wide(table.filter("k % 3 = 0"), model, TASK).collect()
    loss = sum(-math.log(r["probability"] if r["label"] else 1 - r["probability"]) for r in held)
    assert model.losses[best] == pytest.approx(loss / len(held), abs=1e-9)


def test_whole_job_with_more_categories_than_the_limit(spark, table):
    task = ClassificationTask(target="y", positive="p", keys=("k",), features=("a", "b"))
    settings = BoostSettings(step_size=0.3, max_depth=2, rounds=2)
    with pytest.raises(VocabularyTooLarge):
        prepare_training(table, task, local_limit=10)
    job = run_classification(table, task, settings, local_limit=10)
    assert isinstance(job.model, WideModel)
    scored = job.scored.collect()
    margins = {r["k"]: r["margin"] for r in score_wide(table, job.model, task).collect()}
    assert len(scored) == 400 and job.metrics.first()["total"] == 400
    for row in scored:
        assert row["rawPrediction"][1] == pytest.approx(margins[row["k"]], abs=1e-9)
        assert row["features"].size == 42 and sum(row["features"].toArray()) in (1.0, 2.0)
    # The same rows train alike whether the encoder could hold the categories.
    near = run_classification(table, task, settings)
    assert near.scored.columns == job.scored.columns


def test_edge_cases(spark):
    schema = "k int, a string, b string, y string"
    nothing = fit_wide(spark.createDataFrame([], schema), TASK, SETTINGS)
    assert all(t.attribute[0] == -1 and t.leaf[0] == 0.0 for t in nothing.trees)
    rows = [(1, None, None, "p"), (2, "q'\"\n", "x", None), (3, "q'\"\n", "x", "n")]
    table = spark.createDataFrame(rows * 5, schema)
    model = fit_wide(table, TASK, SETTINGS)
    scored = {r["k"]: r["prediction"] for r in score_wide(table, model, TASK).collect()}
    assert scored[1] == 1.0 and scored[3] == 0.0
    # A category that was not seen in training goes where "no" goes.
    new = spark.createDataFrame([(9, "new", "new")], "k int, a string, b string")
    assert score_wide(new, model, TASK).first()["prediction"] == 1.0
