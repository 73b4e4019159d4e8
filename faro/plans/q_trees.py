"""Decision trees and cost-complexity pruning (K06, M13): junk documents by their symbols, length and words."""

from __future__ import annotations

from pyspark.sql import functions as F

from faro.operators import models as K
from faro.operators import resample as R
from faro.operators import trees as TR
from faro.plans.registry import query
from faro.sources.tables import Tables

FEATURES = ["symbols", "n_words", "n_chars"]
LEVELS = [0, 1]

# a hand-built tree: heap numbers of the inner nodes
TREE = TR.Tree({1: ("symbols", 20.0), 2: ("n_words", 60.0), 3: ("n_chars", 2000.0), 5: ("n_chars", 1500.0)})

DOCS_SQL = """docs AS (SELECT d.doc_id AS id, l.quality, CAST(length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) AS DOUBLE) AS symbols,
  CAST(len(regexp_extract_all(d.text, '[^ \\n]+')) AS DOUBLE) AS n_words, CAST(d.n_chars AS DOUBLE) AS n_chars
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def _docs(spark, d):
    t = Tables(spark, d)
    return t.documents.join(t.labels, "doc_id").select(
        F.col("doc_id").alias("id"), "quality", F.length(F.regexp_replace("text", "[^#*$%&|<>]", "")).cast("double").alias("symbols"),
        F.size(F.regexp_extract_all("text", F.lit("[^ \\n]+"), F.lit(0))).cast("double").alias("n_words"), F.col("n_chars").cast("double").alias("n_chars"))


_COUNTS_SQL = f"""WITH {DOCS_SQL}, leaf AS (SELECT quality, CASE WHEN symbols <= 20 THEN CASE WHEN n_words <= 60 THEN 4 ELSE CASE WHEN n_chars <= 1500 THEN 10 ELSE 11 END END
  ELSE CASE WHEN n_chars <= 2000 THEN 6 ELSE 7 END END AS leaf FROM docs),
c AS (SELECT CAST(leaf >> k AS BIGINT) AS node, count(*) AS n, count_if(quality = 0) AS c_0, count_if(quality = 1) AS c_1 FROM leaf, range(4) r(k) WHERE leaf >> k > 0 GROUP BY 1)"""


@query("k06_node_counts", _COUNTS_SQL + " SELECT node, n, CAST(c_0 AS BIGINT) AS c_0, CAST(c_1 AS BIGINT) AS c_1 FROM c")
def k06_node_counts(spark, d):
    """Rows and classes in every node of a given tree, from one scan."""
    return TR.node_counts(_docs(spark, d), TREE, "quality", LEVELS)


@query("k06_weakest_links", _COUNTS_SQL + """, g AS (SELECT node, n * (1 - pow(c_0 / CAST(n AS DOUBLE), 2) - pow(c_1 / CAST(n AS DOUBLE), 2)) AS risk FROM c),
s AS (SELECT a.node, a.risk, sum(b.risk) AS leaf_risk, count(*) AS leaves FROM g a JOIN g b ON b.node IN (4, 6, 7, 10, 11)
      AND (b.node = a.node OR b.node >> 1 = a.node OR b.node >> 2 = a.node OR b.node >> 3 = a.node) WHERE a.node IN (1, 2, 3, 5) GROUP BY ALL)
SELECT node, risk, leaf_risk, leaves, (risk - leaf_risk) / (leaves - 1) AS alpha FROM s""", dbl=["risk", "leaf_risk", "alpha"])
def k06_weakest_links(spark, d):
    """Gini risk that each split of a given tree saves per leaf it adds."""
    counts = TR.Counts.of(TR.node_counts(_docs(spark, d), TREE, "quality", LEVELS))
    rows = [(int(i), counts.risk(i, "gini"), float(risk), int(leaves), float(g)) for i, (risk, leaves, g) in TR.links(TREE, counts, "gini").items()]
    return spark.createDataFrame(rows, "node long, risk double, leaf_risk double, leaves long, alpha double")


@query("k06_pruned_errors")
def k06_pruned_errors(spark, d):
    """A grown tree's sequence of pruned subtrees with their training and test errors (M13), two scans in all."""
    sp = R.initial_split(_docs(spark, d), "id", 0.7, strata="quality", seed=42)
    train, test = R.training(sp), R.testing(sp)
    tree = TR.tree_of(K.fit(K.decision_tree(tree_depth=6, min_n=1), train, "quality", FEATURES, LEVELS).model, FEATURES)
    counts = TR.Counts.of(TR.node_counts(train, tree, "quality", LEVELS))
    return TR.subtree_errors(test, tree, TR.pruning_sequence(tree, counts), counts, "quality", LEVELS)
