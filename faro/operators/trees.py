"""Decision trees as tables: node counts, cost-complexity pruning, errors of every pruned subtree.

A tree is a bounded driver-side object (at most 2 ** depth nodes, numbered as a
heap: the children of node i are 2 i and 2 i + 1).  Rows meet it as one column
expression that gives the leaf, so counting every node is one scan with a
partial aggregation by leaf and class; the counts of the inner nodes are sums
over their leaves.

Pruning is weakest-link: the inner node whose split lowers the risk least per
leaf it adds is collapsed first, which gives a sequence of nested subtrees, each
the smallest that minimises risk + alpha * leaves up to the next alpha.  Since
every subtree of the sequence is a collapse of the same tree, the counts of one
more scan give the errors of all of them on other rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Split = tuple[str, float]       # feature, threshold: rows with feature <= threshold go left
RISKS = ("misclassified", "gini", "sse")


@dataclass(frozen=True)
class Tree:
    """Splits of the inner nodes by heap number; every child of a split that is not one itself is a leaf."""

    splits: dict[int, Split]

    @property
    def leaves(self) -> list[int]:
        return sorted(c for i in self.splits for c in (2 * i, 2 * i + 1) if c not in self.splits) or [1]

    @property
    def nodes(self) -> list[int]:
        return sorted({1, *self.splits, *self.leaves})

    @property
    def depth(self) -> int:
        return max(self.leaves).bit_length() - 1

    def collapse(self, nodes: set[int]) -> "Tree":
        """The tree in which ``nodes`` are leaves."""
        return Tree({i: s for i, s in self.splits.items() if not any(i >> k in nodes for k in range(i.bit_length()))})

    def leaf(self, node: int = 1) -> Column:
        """The leaf number of a row (a missing feature goes right)."""
        if node not in self.splits:
            return F.lit(node).cast("long")
        feature, threshold = self.splits[node]
        return F.when(F.col(feature).cast("double") <= F.lit(float(threshold)), self.leaf(2 * node)).otherwise(self.leaf(2 * node + 1))


def tree_of(model, features: Sequence[str]) -> Tree:
    """The splits of a fitted MLlib decision tree with numeric features, read from its description."""
    splits: dict[int, Split] = {}
    branch: dict[int, int] = {}       # indentation of an open split -> node of the branch being read
    for line in model.toDebugString.splitlines():
        m = re.match(r"( *)(If|Else) \(feature (\d+) (?:<=|>) (\S+)\)", line)
        if not m:
            continue
        indent = len(m[1])
        if m[2] == "Else":
            branch[indent] += 1
        else:
            node = branch[max(k for k in branch if k < indent)] if any(k < indent for k in branch) else 1
            splits[node] = (features[int(m[3])], float(m[4]))
            branch[indent] = 2 * node
        branch = {k: v for k, v in branch.items() if k <= indent}
    return Tree(splits)


# ------------------------------------------------------------------ counts


def node_counts(df: DataFrame, tree: Tree, y: str, levels: Sequence | None = None) -> DataFrame:
    """One row per node of the tree that rows reach: ``node``, ``n`` and ``c_0``.. per level, or ``sy`` and ``syy`` without levels.

    One scan; rows without an outcome, or with one outside the levels, are left out.
    """
    if levels is None:
        v = F.col(y).cast("double")
        rows = df.filter(v.isNotNull()).select(tree.leaf().alias("_leaf"), v.alias("_y"))
        per = [F.sum("_y").alias("sy"), F.sum(F.col("_y") * F.col("_y")).alias("syy")]
        names = ["sy", "syy"]
    else:
        rows = df.filter(F.col(y).isin(list(levels))).select(tree.leaf().alias("_leaf"), F.col(y).alias("_y"))
        names = [f"c_{k}" for k in range(len(levels))]
        per = [F.count_if(F.col("_y") == F.lit(lv)).alias(c) for c, lv in zip(names, levels)]
    leaves = rows.groupBy("_leaf").agg(F.count(F.lit(1)).alias("n"), *per)
    up = F.transform(F.sequence(F.lit(0), F.lit(tree.depth)), lambda k: F.call_function("shiftright", F.col("_leaf"), k))
    return (leaves.withColumn("node", F.explode(up)).filter("node > 0").groupBy("node")
            .agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).orderBy("node"))


@dataclass(frozen=True)
class Counts:
    """Node counts on the driver (bounded by the nodes): rows, class counts or outcome sums."""

    n: dict[int, int]
    values: dict[int, tuple[float, ...]]
    classes: bool

    @staticmethod
    def of(counted: DataFrame) -> "Counts":
        names = [c for c in counted.columns if c not in ("node", "n")]
        rows = counted.collect()
        return Counts({r["node"]: r["n"] for r in rows}, {r["node"]: tuple(r[c] for c in names) for r in rows}, names[0].startswith("c_"))

    def value(self, node: int) -> tuple[float, ...]:
        """The node's counts; of the nearest ancestor that rows reach where none came to the node itself."""
        while node not in self.values:
            node >>= 1
        return self.values[node]

    def risk(self, node: int, kind: str) -> float:
        """Rows misclassified, rows times Gini impurity, or the sum of squared errors in a node."""
        n = self.n.get(node, 0)
        if not n:
            return 0.0
        v = self.values[node]
        if kind == "sse":
            return max(v[1] - v[0] * v[0] / n, 0.0)
        return float(n - max(v)) if kind == "misclassified" else n * (1 - sum((c / n) ** 2 for c in v))

    def error(self, node: int, trained: "Counts") -> float:
        """Rows that the node's training majority gets wrong, or squared errors around its training mean."""
        n = self.n.get(node, 0)
        if not n:
            return 0.0
        v, t = self.values[node], trained.value(node)
        if self.classes:
            return float(n - v[t.index(max(t))])
        while node not in trained.values:
            node >>= 1
        mean = t[0] / trained.n[node]
        return max(v[1] - 2 * mean * v[0] + n * mean * mean, 0.0)


# ------------------------------------------------------------------ pruning


@dataclass(frozen=True)
class Step:
    """A subtree of the sequence: optimal for alpha from ``alpha`` up to the next step's; ``cp`` = alpha / risk of the root."""

    alpha: float
    cp: float
    collapsed: frozenset[int]
    leaves: int
    risk: float


def links(tree: Tree, counts: Counts, kind: str) -> dict[int, tuple[float, int, float]]:
    """Per inner node: risk of its leaves, number of its leaves, and the risk its split saves per leaf added."""
    below: dict[int, tuple[float, int]] = {}
    out = {}
    for node in sorted(tree.nodes, reverse=True):       # children before parents
        if node not in tree.splits:
            below[node] = (counts.risk(node, kind), 1)
            continue
        (rl, nl), (rr, nr) = below[2 * node], below[2 * node + 1]
        below[node] = (rl + rr, nl + nr)
        out[node] = (rl + rr, nl + nr, (counts.risk(node, kind) - rl - rr) / (nl + nr - 1))
    return out


def pruning_sequence(tree: Tree, counts: Counts, kind: str = "misclassified") -> list[Step]:
    """Nested subtrees from the whole tree (less the splits that save nothing) to the root, by weakest links."""
    root = counts.risk(1, kind)
    scale = root or 1.0
    gone: frozenset[int] = frozenset()
    out: list[Step] = []
    alpha = 0.0
    while True:
        now = tree.collapse(set(gone))
        strength = links(now, counts, kind)
        weak = min((g for _, _, g in strength.values()), default=None)
        if weak is not None and weak <= alpha + 1e-12 * scale:          # ties, and links as weak as the last one, go in the same step
            gone |= {i for i, (_, _, g) in strength.items() if g <= alpha + 1e-12 * scale}
            continue
        risk = sum(counts.risk(leaf, kind) for leaf in now.leaves)
        out.append(Step(alpha, alpha / scale, gone, len(now.leaves), risk))
        if weak is None:
            return out
        alpha = weak


def subtree(sequence: Sequence[Step], cp: float) -> Step:
    """The subtree that is optimal at a complexity parameter (risk of the root = 1)."""
    return [s for s in sequence if s.cp <= cp * (1 + 1e-12)][-1]


def subtree_errors(df: DataFrame, tree: Tree, sequence: Sequence[Step], trained: Counts, y: str, levels: Sequence | None = None) -> DataFrame:
    """(step, cp, leaves, train_error, error, n): the error rate (mean squared error) of every subtree on ``df``, from one scan."""
    counts = Counts.of(node_counts(df, tree, y, levels))
    n, m = counts.n.get(1, 0), trained.n.get(1, 0)
    rows = []
    for k, s in enumerate(sequence):
        leaves = tree.collapse(set(s.collapsed)).leaves
        rows.append((k, float(s.cp), s.leaves, sum(trained.error(i, trained) for i in leaves) / m if m else None,
                     sum(counts.error(i, trained) for i in leaves) / n if n else None, int(n)))
    return df.sparkSession.createDataFrame(rows, "step int, cp double, leaves int, train_error double, error double, n long")


@dataclass
class PrunedTree:
    """A tree whose leaves predict from their training counts; a column expression, no model transform."""

    tree: Tree
    counts: Counts
    levels: list | None
    sequence: list[Step] = field(default_factory=list, repr=False)

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``pred`` (mean), or ``pred_class`` and ``pred_<level>`` shares of the leaf."""
        leaf = self.tree.leaf()
        values = {i: self.counts.value(i) for i in self.tree.leaves}
        if self.levels is None:
            return df.withColumn("pred", _lookup(leaf, {i: float(v[0] / self._rows(i)) for i, v in values.items()}))
        share = {lv: {i: float(v[k] / sum(v)) for i, v in values.items()} for k, lv in enumerate(self.levels)}
        cls = {i: self.levels[v.index(max(v))] for i, v in values.items()}
        return df.withColumns({"pred_class": _lookup(leaf, cls), **{f"pred_{lv}": _lookup(leaf, s) for lv, s in share.items()}})

    def _rows(self, node: int) -> int:
        while node not in self.counts.n:
            node >>= 1
        return self.counts.n[node]


def _lookup(leaf: Column, by: dict) -> Column:
    return F.element_at(F.create_map(*[c for i, v in by.items() for c in (F.lit(i).cast("long"), F.lit(v))]), leaf)


def pruned(model, train: DataFrame, features: Sequence[str], y: str, levels: Sequence | None, cp: float) -> PrunedTree:
    """A fitted MLlib tree pruned at ``cp``: one more scan of the training rows for the exact counts of its nodes."""
    tree = tree_of(model, features)
    counts = Counts.of(node_counts(train, tree, y, levels))
    sequence = pruning_sequence(tree, counts, "sse" if levels is None else "misclassified")
    return PrunedTree(tree.collapse(set(subtree(sequence, cp).collapsed)), counts, list(levels) if levels is not None else None, sequence)
