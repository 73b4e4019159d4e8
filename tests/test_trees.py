"""Trees as tables: structure, node counts, pruning against all subtrees, predictions."""

from itertools import product

import numpy as np
import pytest

from faro.operators import models as K
from faro.operators import trees as TR


def table(spark, n=600, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 3)
    y = np.where(rng.random(n) < 0.12, rng.integers(0, 2, n), (x[:, 0] > 0) ^ ((x[:, 1] > 0.5) & (x[:, 0] > -1))).astype(int)
    rows = [(k, *map(float, x[k]), ["no", "si"][y[k]], float(2 * x[k, 0] + (x[k, 1] > 0) + rng.normal())) for k in range(n)]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y string, z double")


def all_subtrees(tree):
    inner = sorted(tree.splits)
    seen = {}
    for keep in product([0, 1], repeat=len(inner)):
        now = tree.collapse({i for i, k in zip(inner, keep) if not k})
        seen[tuple(sorted(now.splits))] = now
    return list(seen.values())


@pytest.mark.parametrize("kind", ["misclassified", "gini", "sse"])
def test_sequence_holds_the_best_subtree_for_every_alpha(kind):
    rng = np.random.default_rng(len(kind))
    for _ in range(40):
        splits = {1: ("a", 0.0)}
        for i in (2, 3, 4, 5, 6, 9, 12):
            if (i >> 1) in splits and rng.random() < 0.7:
                splits[i] = ("a", float(i))
        tree = TR.Tree(splits)
        n, v = {}, {}
        for node in sorted(tree.nodes, reverse=True):
            if node in tree.splits:
                v[node] = tuple(p + q for p, q in zip(v[2 * node], v[2 * node + 1]))
                n[node] = n[2 * node] + n[2 * node + 1]
            elif kind == "sse":
                y = rng.normal(size=int(rng.integers(1, 9))) + rng.integers(0, 3)
                n[node], v[node] = len(y), (float(y.sum()), float((y * y).sum()))
            else:
                v[node] = tuple(map(int, rng.integers(0, 12, 3) + np.array([1, 0, 0])))
                n[node] = sum(v[node])
        counts = TR.Counts(n, v, kind != "sse")
        steps = TR.pruning_sequence(tree, counts, kind)
        assert steps[-1].leaves == 1 and all(p.alpha < q.alpha and p.collapsed < q.collapsed and p.leaves > q.leaves for p, q in zip(steps, steps[1:]))
        for alpha in [s.alpha for s in steps] + [(p.alpha + q.alpha) / 2 for p, q in zip(steps, steps[1:])]:
            cost = {t: (sum(counts.risk(i, kind) for i in t_.leaves) + alpha * len(t_.leaves), len(t_.leaves)) for t, t_ in ((tuple(sorted(s.splits)), s) for s in all_subtrees(tree))}
            best = min(c for c, _ in cost.values())
            smallest = min(leaves for c, leaves in cost.values() if c <= best + 1e-9)
            mine = TR.subtree(steps, alpha / (counts.risk(1, kind) or 1.0))
            assert mine.leaves == smallest and abs(mine.risk + alpha * mine.leaves - best) < 1e-8


def test_hand_built_tree_by_hand():
    tree = TR.Tree({1: ("x", 0.0), 2: ("x", -1.0), 3: ("x", 1.0)})
    v = {4: (40, 2), 5: (6, 10), 6: (3, 30), 7: (5, 4)}
    v[2], v[3] = (46, 12), (8, 34)
    v[1] = (54, 46)
    counts = TR.Counts({i: sum(c) for i, c in v.items()}, v, True)
    steps = TR.pruning_sequence(tree, counts)
    # risks: root 46, 2: 12, 3: 8, leaves 2 + 6 + 3 + 4; links 2: 4, 3: 1, root: 31 / 3; then root: (46 - 16) / 2
    assert [(s.alpha, s.leaves, s.risk) for s in steps] == [(0.0, 4, 15.0), (1.0, 3, 16.0), (4.0, 2, 20.0), (26.0, 1, 46.0)]
    assert steps[1].collapsed == {3} and abs(steps[2].cp - 4 / 46) < 1e-15


def test_structure_counts_and_predictions_of_a_grown_tree(spark):
    df = table(spark)
    feats = ["a", "b", "c"]
    fit = K.fit(K.decision_tree(tree_depth=5, min_n=1), df, "y", feats, ["no", "si"])
    tree = TR.tree_of(fit.model, feats)
    assert len(tree.nodes) == fit.model.numNodes and tree.depth == fit.model.depth
    counts = TR.Counts.of(TR.node_counts(df, tree, "y", ["no", "si"]))
    assert counts.n[1] == 600 and all(counts.n[i] == counts.n[2 * i] + counts.n[2 * i + 1] for i in tree.splits)
    whole = TR.PrunedTree(tree, counts, ["no", "si"])
    a = {r["id"]: r["pred_si"] for r in whole.predict(df).collect()}
    b = {r["id"]: r["pred_si"] for r in fit.predict(df).collect()}
    assert all(abs(a[i] - b[i]) < 1e-12 for i in a)                   # unpruned, it is MLlib's tree


def test_cost_complexity_prunes_in_fit_and_predict(spark):
    df = table(spark, seed=1)
    feats = ["a", "b", "c"]
    leaves = []
    for cp in (0.0001, 0.01, 0.05, 2.0):
        f = K.fit(K.decision_tree(tree_depth=6, min_n=1, cost_complexity=cp), df, "y", feats, ["no", "si"])
        leaves.append(len(f.model.tree.leaves))
        got = f.predict(df)
        assert {"pred_class", "pred_no", "pred_si"} <= set(got.columns) and got.filter("abs(pred_no + pred_si - 1) > 1e-12").count() == 0
    assert leaves == sorted(leaves, reverse=True) and leaves[-1] == 1 and leaves[0] > leaves[2]
    reg = K.fit(K.decision_tree("regression", tree_depth=5, min_n=1, cost_complexity=0.02), df, "z", feats)
    full = K.fit(K.decision_tree("regression", tree_depth=5, min_n=1), df, "z", feats)
    assert 1 < len(reg.model.tree.leaves) < len(TR.tree_of(full.model, feats).leaves)
    rows = reg.predict(df).select("z", "pred").toPandas()
    assert ((rows.groupby("pred").z.mean() - rows.groupby("pred").z.mean().index) ** 2).max() < 1e-20     # leaves predict their means


def test_errors_of_all_subtrees_from_one_scan(spark):
    df, other = table(spark, seed=2), table(spark, seed=3)
    feats, levels = ["a", "b", "c"], ["no", "si"]
    tree = TR.tree_of(K.fit(K.decision_tree(tree_depth=6, min_n=1), df, "y", feats, levels).model, feats)
    counts = TR.Counts.of(TR.node_counts(df, tree, "y", levels))
    steps = TR.pruning_sequence(tree, counts)
    rows = TR.subtree_errors(other, tree, steps, counts, "y", levels).orderBy("step").collect()
    assert [r["leaves"] for r in rows] == [s.leaves for s in steps]
    for r, s in list(zip(rows, steps))[::3]:
        pred = TR.PrunedTree(tree.collapse(set(s.collapsed)), counts, levels).predict(other)
        assert abs(r["error"] - pred.filter("pred_class <> y").count() / 600) < 1e-12
    assert all(p["train_error"] <= q["train_error"] + 1e-12 for p, q in zip(rows, rows[1:]))


def test_empty_nodes_missing_features_and_no_rows(spark):
    tree = TR.Tree({1: ("a", 0.0), 3: ("a", 100.0)})
    df = spark.createDataFrame([(1, -1.0, "no"), (2, 3.0, "si"), (3, None, "si"), (4, 5.0, None), (5, 5.0, "other")], "id int, a double, y string")
    got = {r["node"]: (r["n"], r["c_0"], r["c_1"]) for r in TR.node_counts(df, tree, "y", ["no", "si"]).collect()}
    assert got == {1: (3, 1, 2), 2: (1, 1, 0), 3: (2, 0, 2), 6: (1, 0, 1), 7: (1, 0, 1)}     # a missing feature goes right
    counts = TR.Counts.of(TR.node_counts(df.filter("a is not null"), tree, "y", ["no", "si"]))
    pred = {r["id"]: r["pred_class"] for r in TR.PrunedTree(tree, counts, ["no", "si"]).predict(df).collect()}
    assert pred[3] == "si"                                            # no training row came to the leaf: its parent decides
    assert TR.node_counts(df.limit(0), tree, "y", ["no", "si"]).count() == 0
