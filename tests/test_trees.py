"""Second moments, extremely randomised trees and tree tables against plain versions."""

import math
import re
from itertools import accumulate

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import facts
from riskloom.operators import extra_trees, models, moments, tree_table
from riskloom.operators.evaluation import exact_auc
from riskloom.session import materialize, shared_path

NAMES = ["a", "b", "c", "twin", "flat", "gap"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(400):
        a, b, c = rng.normal(5, 2), float(rng.integers(0, 4)), rng.normal(-100, 30)
        rows.append((i, int(a + .5 * b + rng.normal(0, 1) > 6), a, b, c, 2 * a, 3.0, None if i % 5 == 0 else rng.normal()))
    return materialize(spark.createDataFrame(rows, "id long, target int, a double, b double, c double, twin double, flat double, gap double"),
                       "tree-data")


def plain(df, names=NAMES):
    rows = df.orderBy("id").collect()
    return (np.array([[0.0 if r[n] is None else float(r[n]) for n in names] for r in rows]), np.array([float(r.target) for r in rows]))


# moments and elimination ---------------------------------------------------------------------------

def test_moments_against_numpy(data, make):
    x, y = plain(data)
    got = moments.collected(data.repartition(7), [*NAMES, "target"])
    full = np.column_stack([x, y])
    assert got.rows == 400 and np.allclose(got.sums, full.sum(axis=0)) and np.allclose(got.products, full.T @ full)
    assert np.allclose(got.covariance(), np.cov(full.T, bias=True))
    empty = moments.collected(data.limit(0), NAMES)
    assert empty.rows == 0 and not empty.products.any()
    nan = make("a double, `x.y` int", [(float("nan"), 1), (2.0, None), (3.0, 4)])
    assert moments.collected(nan, ["a", "x.y"]).products.tolist() == [[13.0, 12.0], [12.0, 17.0]]


def plain_ranking(x, y, keep, step):
    """Refit on what is left, drop the smallest weights, begin anew."""
    left, gone = list(range(x.shape[1])), []
    spread = x.std(axis=0)
    unit = np.where(spread > 1e-9, (x - x.mean(axis=0)) / np.where(spread > 1e-9, spread, 1), 0.0)
    while len(left) > keep:
        z = unit[:, left]
        weights = np.linalg.solve(z.T @ z + np.eye(len(left)), z.T @ (y - y.mean()))
        order = sorted(range(len(left)), key=lambda i: (abs(weights[i]), i))[:min(step, len(left) - keep)]
        gone.append([left[i] for i in order])
        left = [v for i, v in enumerate(left) if i not in order]
    ranking = dict.fromkeys(left, 1)
    for place, dropped in enumerate(reversed(gone), start=2):
        ranking.update(dict.fromkeys(dropped, place))
    return [ranking[i] for i in range(x.shape[1])]


@pytest.mark.parametrize("keep, step", [(1, 1), (3, 1), (2, 2), (6, 1), (0, 4)])
def test_elimination_against_refits(data, keep, step):
    got = moments.elimination(data, NAMES, keep, step=step).orderBy("position").collect()
    assert [r.feature for r in got] == NAMES
    assert [r.ranking for r in got] == plain_ranking(*plain(data), keep, step)


def test_elimination_of_many_columns(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 40)) @ rng.normal(size=(40, 40)) * rng.uniform(.01, 1e4, 40) + 50
    y = (x[:, 3] / x[:, 3].std() + x[:, 30] / x[:, 30].std() > 0).astype(float)
    names = [f"v{i}" for i in range(40)]
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], ", ".join(f"{n} double" for n in [*names, "target"]))
    assert [r.ranking for r in moments.elimination(df, names, 5).orderBy("position").collect()] == plain_ranking(x, y, 5, 1)


# extremely randomised trees ------------------------------------------------------------------------

def plain_forest(x, y, trees, depth, per_node, seed):
    """Recursion over one node at a time in whole numbers and plain floats."""
    total = np.zeros((trees, x.shape[1]))

    def split(tree, node, rows, level):
        n, p = len(rows), sum(y[rows])
        if level == depth or p in (0, n):
            return
        best = None
        for f in sorted(sorted(range(x.shape[1]), key=lambda f: (extra_trees.draw(seed, tree, node, f), f))[:per_node]):
            low, high = x[rows, f].min(), x[rows, f].max()
            cut = low + (extra_trees.draw(seed + 1, tree, node, f) + .5) / extra_trees.MODULUS * (high - low)
            left = [i for i in rows if x[i, f] <= cut]
            if 0 < len(left) < n:
                a, b = len(left), sum(y[left])
                gain = 2 * p * (n - p) / n - 2 * b * (a - b) / a - 2 * (p - b) * (n - a - p + b) / (n - a)
                if best is None or gain > best[0]:
                    best = gain, f, left
        if best:
            total[tree, best[1]] += best[0]
            split(tree, 2 * node, best[2], level + 1)
            split(tree, 2 * node + 1, [i for i in rows if i not in set(best[2])], level + 1)

    for tree in range(trees):
        split(tree, 1, list(range(len(x))), 0)
    sums = total.sum(axis=1)
    return (total[sums > 0] / sums[sums > 0, None]).mean(axis=0)


@pytest.mark.parametrize("trees, depth, per_node", [(1, 1, 6), (5, 4, 2), (3, 6, 1)])
def test_forest_against_recursion(data, trees, depth, per_node):
    got = extra_trees.grow(data.repartition(5), NAMES, trees, depth, per_node)
    assert np.allclose(got.importances(), plain_forest(*plain(data), trees, depth, per_node, 27))


def test_rows_of_a_level_by_block(monkeypatch):
    """Blocks hold columns with label 1 first, and the nodes of a level share out the rows that are still on their way."""
    import pyarrow as pa
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 5, (40, 3)).astype("<f8"), rng.integers(0, 2, 40)
    batches = [pa.record_batch([pa.array([r.tobytes() for r in x[i:i + 8]], pa.binary()), pa.array(y[i:i + 8])], ["x", "y"])
               for i in range(0, 40, 8)]
    monkeypatch.setattr(extra_trees, "_BLOCK_VALUES", 3 * 16)
    blocks = list(extra_trees._blocks(batches, 3))
    assert [t.shape for t, _ in blocks] == [(3, 16), (3, 16), (3, 8)] and sum(p for _, p in blocks) == y.sum()
    first, positive = blocks[0]
    assert sorted(map(tuple, first[:, :positive].T)) == sorted(map(tuple, x[:16][y[:16] == 1]))
    feature, threshold = np.array([-1, 0, 1, -1]), np.array([0, 2.0, 1.0, 0])
    for table, _ in blocks:
        level = dict(extra_trees._at_level(table, np.arange(table.shape[1]), feature, threshold, 2))
        left = table[0] <= 2
        assert level.get(4, np.array([])).tolist() == np.flatnonzero(left & (table[1] <= 1)).tolist()
        assert level.get(5, np.array([])).tolist() == np.flatnonzero(left & (table[1] > 1)).tolist() and set(level) <= {4, 5}


def test_stored_rows_are_not_taken_apart(data):
    stored = extra_trees._packed_rows(data, NAMES, "target", 0.0)
    assert dict(stored.dtypes) == {"x": "binary", "y": "bigint"}
    x, y = plain(data)
    got = sorted((tuple(np.frombuffer(r.x, "<f8")), r.y) for r in stored.collect())
    assert got == sorted(zip(map(tuple, x), y.astype(int).tolist()))


def test_forest_without_a_split(data):
    assert extra_trees.grow(data.limit(0), NAMES, 2, 2).importances().tolist() == [0] * 6
    assert extra_trees.grow(data.where("target = 1"), NAMES, 2, 2).importances().tolist() == [0] * 6
    assert extra_trees.grow(data, ["flat"], 2, 2).importances().tolist() == [0]


def test_draws_are_spread():
    draws = extra_trees.draw(27, np.arange(100)[:, None, None], np.arange(1, 33)[None, :, None], np.arange(50)[None, None, :]).ravel()
    counts = np.histogram(draws, bins=20, range=(0, extra_trees.MODULUS))[0]
    assert counts.min() > .9 * len(draws) / 20 and len(set(draws.tolist())) > .99 * len(draws)
    neighbours = extra_trees.draw(1, 0, 1, np.arange(10000)) / extra_trees.MODULUS
    assert abs(np.corrcoef(neighbours[1:], neighbours[:-1])[0, 1]) < .05


# tree tables ---------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def fitted(data):
    settings = models.TreeSettings(rounds=6, depth=4, step=.1)
    model = models.fit(data, NAMES, models.boosted_trees(settings), models.MISSING)
    return model, tree_table.ensemble_table(model)


def test_table_has_the_models_nodes(fitted):
    model, table = fitted
    trees = model.stages[-1].trees
    rows = table.collect()
    assert len(rows) == sum(t.numNodes for t in trees) and {r["round"] for r in rows} == set(range(1, 7))
    assert [r.weight for r in sorted(rows, key=lambda r: r["round"]) if r.node == 0] == list(model.stages[-1].treeWeights)
    assert tree_table.levels(table) == max(t.depth for t in trees)


def test_split_counts_are_those_of_the_model(fitted):
    model, table = fitted
    counts = {r.feature: r.score for r in tree_table.split_counts(table, NAMES).collect()}
    printed = "".join(t.toDebugString for t in model.stages[-1].trees)
    assert counts == {n: printed.count(f"If (feature {i} ") for i, n in enumerate(NAMES)}
    assert sum(counts.values()) > 6 and counts["flat"] == 0


def test_table_scores_are_those_of_the_model(data, fitted):
    model, table = fitted
    want = {r.ID: r.PROB for r in models.score(model, data, NAMES, models.MISSING).collect()}
    got = tree_table.table_scores(table, data, NAMES, models.MISSING)
    assert got.columns == ["ID", "PROB", "target"]
    got = {r.ID: r.PROB for r in got.collect()}
    assert set(got) == set(want) and max(abs(got[i] - want[i]) for i in want) < 1e-9


def test_watch_list_ends_with_the_models_auc(data, fitted):
    model, table = fitted
    train, held = data.where("id % 3 > 0"), data.where("id % 3 = 0")
    rows = tree_table.watch_list(table, train, held, NAMES, models.MISSING).orderBy("round").collect()
    assert [r["round"] for r in rows] == [1, 2, 3, 4, 5, 6]
    for side, column in ((train, "train_auc"), (held, "validation_auc")):
        scored = models.score(model, side, NAMES, models.MISSING)
        assert math.isclose(rows[-1][column], exact_auc(scored, score="PROB").first().auc, abs_tol=1e-9)


def test_staged_margins_are_running_sums_without_a_shuffle(data, fitted, capsys):
    _model, table, *_ = fitted
    got = tree_table.staged_margins(table, data, NAMES, "id", missing=models.MISSING)
    got.explain()
    assert not {"Exchange", "Generate", "Window"} & set(re.findall(r"\w+", capsys.readouterr().out))
    parts = {}
    for r in tree_table.round_predictions(table, data, NAMES, "id", missing=models.MISSING).collect():
        parts.setdefault(r.id, {})[r["round"]] = r.part
    # Added in the order of the rounds; Python's sum() would correct its rounding.
    want = {(i, k): margin for i, by_round in parts.items()
            for k, margin in zip(sorted(by_round), accumulate(by_round[k] for k in sorted(by_round)))}
    assert {(r.id, r["round"]): r.margin for r in got.collect()} == want


def test_staged_aucs_from_sorted_runs(make, monkeypatch):
    """Ranges, blocks and ties make no difference to the counts of single margins; no row is laid out per round."""
    rng = np.random.default_rng(3)
    rows = [(i, int(i % 4 == 3), [1, 0, None, 7][int(rng.integers(0, 4))], float(rng.integers(0, 4)) if i % 2 else float(rng.normal()),
             None if i % 7 == 0 else float("nan") if i % 11 == 0 else float(rng.normal())) for i in range(900)]
    df = materialize(make("id long, held int, target int, a double, `b.c` double", rows).repartition(3), "staged")
    nodes = []
    for r in range(1, 6):
        cut = float(rng.normal())
        nodes += [(r, .5, 0, r % 2, cut, 1, 2, 1.0, 0.0), (r, .5, 1, (r + 1) % 2, -cut, 3, 4, 1.0, 0.0), (r, .5, 2, None, None, None, None, None, float(rng.normal())),
                  (r, .5, 3, None, None, None, None, None, -1.0), (r, .5, 4, None, None, None, None, None, float(rng.normal()))]
    table = make(tree_table.SCHEMA, nodes)
    single = tree_table.staged_margins(table, df, ["a", "b.c"], "held", "target").withColumn("_group", 2 * F.col("round") + F.col("held"))
    want = {r._group: (r.positives, r.negatives, r.auc) for r in tree_table.grouped_auc(single, "_group", score="margin").collect()}
    assert len(want) == 10
    for most, ranges in ((1 << 23, 1 << 20), (5 * 70, 1 << 20), (5 * 70, 40)):
        monkeypatch.setattr(tree_table, "_BLOCK_VALUES", most)
        monkeypatch.setattr(tree_table, "_RANGE_ROWS", ranges)
        staged = tree_table.staged_auc(table, df, ["a", "b.c"], "held")
        got = {2 * r["round"] + r.held: (r.positives, r.negatives, r.auc) for r in staged.collect()}
        assert got.keys() == want.keys()
        for k in want:
            assert got[k][:2] == want[k][:2] and math.isclose(got[k][2], want[k][2], rel_tol=1e-12)


def test_watch_list_stores_no_single_margins(data, fitted):
    """Margins of single rows are neither sorted as a table nor stored; runs of them meet by round."""
    _model, table = fitted
    watched = tree_table.watch_list(table, data.where("id % 3 > 0"), data.where("id % 3 = 0"), NAMES, models.MISSING)
    assert not [f for f in watched.inputFiles() if "/sorted-" in f]


def test_watch_list_with_an_empty_side(data, fitted):
    _model, table = fitted
    rows = tree_table.watch_list(table, data, data.where("id < 0"), NAMES, models.MISSING).orderBy("round").collect()
    assert [r["round"] for r in rows] == [1, 2, 3, 4, 5, 6]
    assert all(r.train_auc > .5 and r.validation_auc is None for r in rows)
    assert tree_table.watch_list(table, data.limit(0), data.limit(0), NAMES, models.MISSING).count() == 0


def test_fixed_ensemble_on_odd_rows(make):
    table = make(tree_table.SCHEMA, list(facts.ENSEMBLE))
    assert tree_table.levels(table) == 3
    row = (1, 1, 4000.0, None, 60.0, 9.0, None, 5.0, 31.0, 1.0, 1.0)
    got = tree_table.table_scores(table, make(
        "id long, target int, " + ", ".join(f"{c} double" for c in facts.COLUMNS), [row]), facts.COLUMNS).first()
    assert math.isclose(got.PROB, 1 / (1 + math.exp(-2 * (-0.75 + 0.125 * 0.875 + 0.0625 * 1.5))))


def test_grouped_auc_with_an_empty_class(make):
    rows = [("x", 1, .5), ("x", 0, .5), ("x", 0, .1), ("y", 1, .2), ("z", 0, .2), ("z", 1, None), (None, 1, 1.0), (None, 0, 0.5)]
    got = {r.g: (r.auc, r.positives, r.negatives) for r in tree_table.grouped_auc(
        make("g string, target int, prob double", rows), "g").collect()}
    assert got["x"] == (.75, 1, 2) and got["y"] == (None, 1, 0) and got[None] == (1.0, 1, 1)


# stored results ------------------------------------------------------------------------------------

def test_results_are_kept_and_read_again(spark):
    folder, runs = shared_path(spark, "jobs"), []

    def job(name):
        def run():
            runs.append(name)
            return spark.range(len(runs) * 0 + 3).withColumn("name", F.lit(name))
        return run

    first = models.stored_results(spark, {n: job(n) for n in "ab"}, folder, width=2)
    again = models.stored_results(spark, {n: job(n) for n in "abc"}, folder, width=2)
    assert sorted(runs) == ["a", "b", "c"]  # what was finished is not built again
    assert {n: again[n].count() for n in "abc"} == dict.fromkeys("abc", 3) and first["a"].first().name == "a"


def test_a_failed_job_leaves_the_others(spark):
    folder = shared_path(spark, "jobs")

    def fails():
        raise ValueError("no fit")

    with pytest.raises(ValueError, match="no fit"):
        models.stored_results(spark, {"good": lambda: spark.range(2), "bad": fails}, folder)
    again = models.stored_results(spark, {"good": fails, "bad": lambda: spark.range(1)}, folder)
    assert again["good"].count() == 2 and again["bad"].count() == 1
