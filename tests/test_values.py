"""Values of the fitted-model queries: optimality conditions, refits in numpy, and results put together by hand."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from faro.operators import cluster as C
from faro.operators import metrics as M
from faro.operators import models as K
from faro.operators import resample as R
from faro.operators.recipe import Recipe
from faro.plans.q_models import FEATS, LEVELS, _split, _survey_model
from faro.plans.registry import all_queries
from faro.sources.tables import Tables

from .conftest import SMOKE

Q = all_queries()


def run(spark, name):
    return Q[name].build(spark, SMOKE)


@pytest.fixture(scope="module")
def split(spark):
    train, test = _split(spark, SMOKE)
    return train.cache(), test.cache()


def arrays(df):
    pdf = df.select(*FEATS, "y").toPandas()
    return pdf[FEATS].to_numpy(float), (pdf["y"] == "si").to_numpy(float)


def newton(x, y, rounds=30):
    """Unpenalised logistic regression: intercept and slopes."""
    a = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-a @ b))
        b += np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]), a.T @ (y - p))
    return b


def sigmoid(z):
    return 1 / (1 + np.exp(-z))


def auc(y, p):
    order = np.argsort(p, kind="stable")
    rank = np.empty(len(p))
    for v in np.unique(p):
        at = p == v
        rank[at] = (np.searchsorted(p[order], v, "left") + np.searchsorted(p[order], v, "right") + 1) / 2
    n1 = y.sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_k02_l1_logistic_meets_the_kkt_conditions(spark, split):
    x, y = arrays(split[0])
    b = {r.term: r.estimate for r in run(spark, "k02_penalized_logistic").collect()}
    beta = np.array([b[c] for c in FEATS])
    sd = x.std(axis=0, ddof=1)
    g = ((x - x.mean(axis=0)) / sd).T @ (y - sigmoid(b["(Intercept)"] + x @ beta)) / len(y)
    assert abs((y - sigmoid(b["(Intercept)"] + x @ beta)).mean()) < 1e-4
    for gj, bj in zip(g, beta):
        assert abs(gj - 0.01 * np.sign(bj)) < 1e-4 if abs(bj) > 1e-9 else abs(gj) <= 0.01 + 1e-4


def test_k01_k13_inference_equals_newton_and_its_information(spark, split):
    x, y = arrays(split[0])
    b = newton(x, y)
    a = np.column_stack([np.ones(len(x)), x])
    p = sigmoid(a @ b)
    se = np.sqrt(np.diag(np.linalg.inv(a.T @ (a * (p * (1 - p))[:, None]))))
    got = {r.term: r for r in run(spark, "k01_logistic_inference").collect()}
    odds = {r.term: r for r in run(spark, "k13_odds_ratios").collect()}
    for t, bj, sj in zip(["(Intercept)", *FEATS], b, se):
        assert got[t].estimate == pytest.approx(bj, rel=1e-5, abs=1e-8) and got[t].std_error == pytest.approx(sj, rel=1e-4)
        assert got[t].statistic == pytest.approx(bj / sj, rel=1e-4, abs=1e-6)
        o = odds[t]
        assert (o.odds_ratio, o.ci_low, o.ci_high) == pytest.approx((np.exp(bj), np.exp(bj - 1.96 * sj), np.exp(bj + 1.96 * sj)), rel=1e-4)
        assert o.stars == ("***" if o.p_value < 0.001 else "**" if o.p_value < 0.01 else "*" if o.p_value < 0.05 else "")


def test_k10_probabilities_follow_the_coefficients(spark, split):
    b = newton(*arrays(split[0]))
    x, _ = arrays(split[1])
    rows = {r.id: r for r in run(spark, "k10_predict_probabilities").collect()}
    ids = [r.id for r in split[1].select("id").collect()]
    want = dict(zip(ids, sigmoid(b[0] + x @ b[1:])))
    assert len(rows) == len(ids)
    for i in ids[::5]:
        r = rows[i]
        assert r.pred_si == pytest.approx(want[i], abs=1e-4) and r.pred_no + r.pred_si == pytest.approx(1) and r.pred_class == ("si" if r.pred_si > 0.5 else "no")


def test_v08_last_fit_and_r08_learning_curve_equal_hand_evaluation(spark, split):
    train, test = split
    f = K.fit(K.logistic_reg(0.001, 0.0), train, "y", FEATS, LEVELS)
    p = f.predict(test).toPandas()
    y = (p["y"] == "si").to_numpy(float)
    got = {r.metric: r.estimate for r in run(spark, "v08_last_fit").collect()}
    assert got["accuracy"] == pytest.approx((p["pred_class"] == p["y"]).mean()) and got["roc_auc"] == pytest.approx(auc(y, p["pred_si"].to_numpy()), abs=1e-9)
    curve = {r.fraction: r for r in run(spark, "r08_learning_curve").collect()}
    n = train.count()
    assert [curve[k].n_train for k in (0.25, 0.5, 1.0)] == [int(n * k) for k in (0.25, 0.5, 1.0)]
    b = newton(*arrays(train))
    for part, name in ((train, "train_accuracy"), (test, "test_accuracy")):
        x, t = arrays(part)
        assert getattr(curve[1.0], name) == pytest.approx(((sigmoid(b[0] + x @ b[1:]) > 0.5) == t).mean(), abs=2 / len(t))


def test_v01_resampled_scores_equal_refits_per_fold(spark):
    data = R.vfold(_survey_model(spark, SMOKE), "id", v=5, strata="y", seed=42).select("fold", "y", *FEATS).toPandas()
    acc, area = [], []
    for k in range(1, 6):
        a, h = data[data.fold != k], data[data.fold == k]
        b = newton(((a[FEATS] - a[FEATS].mean()) / a[FEATS].std()).to_numpy(float), (a.y == "si").to_numpy(float))
        p = sigmoid(b[0] + ((h[FEATS] - a[FEATS].mean()) / a[FEATS].std()).to_numpy(float) @ b[1:])
        t = (h.y == "si").to_numpy(float)
        acc.append(((p > 0.5) == t).mean())
        area.append(auc(t, p))
    got = {r.metric: r for r in run(spark, "v01_fit_resamples").collect()}
    for name, v in (("accuracy", acc), ("roc_auc", area)):
        assert got[name].n == 5 and got[name].mean == pytest.approx(np.mean(v), abs=2e-3) and got[name].std_err == pytest.approx(np.std(v, ddof=1) / 5 ** 0.5, abs=2e-3)


def test_v05_and_v04_grid_points_equal_single_fits(spark, split):
    data = R.vfold(_survey_model(spark, SMOKE), "id", v=5, strata="y", seed=42)
    got = {(round(r.penalty, 9), r.mixture): r for r in run(spark, "v05_tune_grid").collect()}
    assert len(got) == 6 and all(r.n == 5 for r in got.values())
    for penalty, mixture in ((1e-2, 1.0),):
        v = []
        for k in range(1, 6):
            f = K.fit(K.logistic_reg(penalty, mixture), data.filter(F.col("fold") != k), "y", FEATS, LEVELS)
            p = f.predict(data.filter(F.col("fold") == k)).select("y", "pred_si").toPandas()
            v.append(auc((p["y"] == "si").to_numpy(float), p["pred_si"].to_numpy()))
        assert got[(penalty, mixture)].mean == pytest.approx(np.mean(v), abs=1e-9)
    rows = run(spark, "v04_grid_random_fit").collect()
    assert len({r.penalty for r in rows}) == 4 and all(1e-4 <= r.penalty <= 1 for r in rows)
    p = K.fit(K.logistic_reg(rows[0].penalty), split[0], "y", FEATS, LEVELS).predict(split[1]).select("y", "pred_si").toPandas()
    assert rows[0].roc_auc == pytest.approx(auc((p["y"] == "si").to_numpy(float), p["pred_si"].to_numpy()), abs=1e-9)


def test_k14_coefficients_equal_least_squares_and_textbook_penalties(spark):
    from faro.plans.inputs import items

    pdf = items(Tables(spark, SMOKE)).toPandas()
    feats = ["l_quantity", "l_discount", "l_tax"]
    x, y = pdf[feats].to_numpy(float), pdf["l_extendedprice"].to_numpy(float) / 1000
    got = {r.term: r for r in run(spark, "k14_coefficient_comparison").collect()}
    ols = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0]
    assert [got[t].ols for t in ["(Intercept)", *feats]] == pytest.approx(list(ols), rel=1e-5, abs=1e-6)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    ridge = np.linalg.solve(z.T @ z / len(y) + np.eye(3), z.T @ (y - y.mean()) / len(y)) / x.std(axis=0)
    assert [got[t].ridge for t in feats] == pytest.approx(list(ridge), rel=5e-3, abs=1e-5)
    for name, a in (("lasso", 1.0), ("enet", 0.5)):
        b = np.array([getattr(got[t], name) for t in feats]) * x.std(axis=0)
        g = z.T @ (y - y.mean() - z @ b) / len(y) - (1 - a) * b
        assert all(abs(gj - a * np.sign(bj)) < 5e-3 if abs(bj) > 1e-9 else abs(gj) <= a + 5e-3 for gj, bj in zip(g, b))


def test_k06_k09_k15_metrics_equal_their_predictions(spark, split):
    train, test = split
    gap = {r.depth: r for r in run(spark, "k06_m13_overfit_gap").collect()}
    f = K.fit(K.decision_tree(tree_depth=6), train, "y", FEATS, LEVELS)
    err = [f.predict(d).filter("pred_class <> y").count() / d.count() for d in (train, test)]
    row = gap[6].asDict()
    assert err[0] == pytest.approx(next(v for k, v in row.items() if "train" in k)) and err[1] == pytest.approx(next(v for k, v in row.items() if "test" in k))
    trains = [next(v for k, v in gap[d].asDict().items() if "train" in k) for d in (1, 3, 6, 10)]
    assert trains == sorted(trains, reverse=True)
    from faro.plans.inputs import items

    it = items(Tables(spark, SMOKE)).withColumn("price_k", F.col("l_extendedprice") / 1000)
    sp = R.initial_split(it, "id", 0.8, seed=42)
    fit = K.fit(K.boost_tree(mode="regression", trees=20, tree_depth=3), R.training(sp), "price_k", ["l_quantity", "l_discount", "l_tax"])
    p = fit.predict(R.testing(sp)).select("price_k", "pred").toPandas()
    got = run(spark, "k09_boost_tree_regression").first().asDict()
    assert got["rmse"] == pytest.approx(np.sqrt(((p.price_k - p.pred) ** 2).mean())) and got["mae"] == pytest.approx((p.price_k - p.pred).abs().mean())
    by = {r.status: r.accuracy for r in run(spark, "k15_forest_by_subset").collect()}
    status = sorted(by)[0]
    one = K.fit(K.rand_forest(trees=10), train.filter(F.col("status") == status), "y", ["price_k", "balance_k"], LEVELS).predict(test.filter(F.col("status") == status))
    assert by[status] == pytest.approx(one.filter("pred_class = y").count() / one.count()) and len(by) == train.select("status").distinct().count()


def test_i04_spearman_of_the_two_rankings(spark, split):
    from faro.operators import explain as I

    imp = {r.variable: r.importance for r in I.importance_impurity(K.fit(K.rand_forest(trees=30), split[0], "y", FEATS, LEVELS)).collect()}
    z = {r.term: abs(r.statistic) for r in K.logistic_inference(split[0], "y", FEATS, LEVELS).collect()}
    rank = lambda d: np.argsort(np.argsort([-d[v] for v in FEATS]))
    got = run(spark, "i04_rank_agreement").first()
    assert got.n_variables == 3 and got.spearman == pytest.approx(np.corrcoef(rank(imp), rank(z))[0, 1])


def test_c12_c16_c17_clusters_and_scores(spark):
    from faro.plans.q_cluster import IND_COLS, nation_indicators

    ind = nation_indicators(Tables(spark, SMOKE)).toPandas().sort_values("country")
    x = ind[IND_COLS].to_numpy(float)
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    vals, vec = np.linalg.eigh(np.corrcoef(x.T))
    vec = vec[:, ::-1][:, :2]
    vec = vec * np.sign(vec[np.abs(vec).argmax(axis=0), range(2)])
    want = dict(zip(ind["country"], z @ vec))
    rows = run(spark, "c17_kmeans_on_scores").collect()
    assert all((r.PC1, r.PC2) == pytest.approx(tuple(want[r.country]), abs=1e-8) for r in rows) and len(rows) == len(ind)
    centre = {c: np.mean([[r.PC1, r.PC2] for r in rows if r.cluster == c], axis=0) for c in {r.cluster for r in rows}}
    assert len(centre) == 3
    for r in rows:                                                     # a Lloyd fixed point: everyone is with the nearest mean
        d = {c: ((np.array([r.PC1, r.PC2]) - m) ** 2).sum() for c, m in centre.items()}
        assert d[r.cluster] <= min(d.values()) + 1e-3
    ranks = {r.country: r["rank"] for r in run(spark, "c16_pca_scores_rank").collect()}
    assert sorted(ranks, key=ranks.get) == sorted(want, key=lambda c: (-want[c][0], c))
    arrows = [r for r in run(spark, "c17_biplot_data").collect() if r.kind == "arrow"]
    assert len(arrows) == len(IND_COLS)
    cross = run(spark, "c12_kmeans_vs_hierarchical").collect()
    emb = spark.read.parquet(f"{SMOKE}/embeddings.parquet").count()
    assert sum(r.n for r in cross) == emb and len({r.kmeans for r in cross}) == len({r.hclust for r in cross}) == 5


def test_t24_synonyms_are_the_nearest_vectors(spark):
    from faro.operators import text as TX
    from faro.operators import topics as TP

    docs = TP.doc_token_arrays(TX.tokenize(Tables(spark, SMOKE).documents, "doc_id", "text"), "doc_id").coalesce(1).sortWithinPartitions("doc_id").cache()
    m = TP.word2vec(docs, size=16)
    v = {r["word"]: np.array(r["vector"].toArray()) for r in m.getVectors().collect()}
    got = m.findSynonyms("the", 5).collect()
    cos = {w: float(v["the"] @ x / np.linalg.norm(v["the"]) / (np.linalg.norm(x) or 1)) for w, x in v.items() if w != "the"}
    assert [r["word"] for r in got] == sorted(cos, key=cos.get, reverse=True)[:5] or sorted(cos.values(), reverse=True)[:5] == pytest.approx([r["similarity"] for r in got], abs=1e-4)
    assert {r.word_query for r in run(spark, "t24_word2vec_synonyms").collect()} == {"the"}
    assert set(v) == {t for (t,) in docs.select(F.explode("tokens")).distinct().collect()}


def test_recipe_and_metric_helpers_used_above_agree(spark, split):
    """The workflow's own metrics are those computed here by hand."""
    f = K.fit(K.logistic_reg(), split[0], "y", FEATS, LEVELS).predict(split[1])
    p = f.select("y", "pred_si").toPandas()
    assert M.roc_auc(f, "y", "pred_si", "si").first()["roc_auc"] == pytest.approx(auc((p["y"] == "si").to_numpy(float), p["pred_si"].to_numpy()), abs=1e-12)
    baked = Recipe("y", ids=["id"], predictors=FEATS).step_normalize().prep(split[0]).bake(split[0])
    row = baked.agg(*[F.avg(c) for c in FEATS], *[F.stddev_samp(c) for c in FEATS]).first()
    assert list(row) == pytest.approx([0, 0, 0, 1, 1, 1], abs=1e-9) and C.silhouette_band(F.lit(0.8)) is not None


def test_boosting_on_cells_equals_boosting_on_rows(spark):
    """Rows of the same bins are one weighted cell: the trees, cuts and predictions are MLlib's on all rows, also with min_n and classes."""
    from pyspark.ml import classification as MC
    from pyspark.ml import regression as MR
    from pyspark.ml.functions import vector_to_array

    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 50, 6000) + 0.5, rng.integers(0, 4, 6000), rng.integers(-2, 9, 6000) * 0.1])
    y = np.sin(x[:, 0] / 9) + x[:, 1] * x[:, 2] + rng.normal(size=6000) / 4
    df = spark.createDataFrame([(*map(float, r), float(v), "si" if v > 0.5 else "no") for r, v in zip(x, y)], "a double, b double, c double, y double, cls string")
    common = dict(featuresCol="_features", labelCol="_label", predictionCol="_pred", maxIter=6, maxDepth=3, stepSize=0.1, seed=42)
    for least in (1, 40):
        f = K.fit(K.boost_tree("regression", trees=6, min_n=least), df, "y", ["a", "b", "c"])
        d = K._label(K._assemble(df, ["a", "b", "c"]), "y", None)
        want = MR.GBTRegressor(minInstancesPerNode=least, **common).fit(d).transform(d).select("a", "b", "c", "_pred").distinct().toPandas()
        got = f.predict(df).select("a", "b", "c", "pred").distinct().toPandas()
        both = want.merge(got, on=["a", "b", "c"])
        assert len(both) == len(want) and np.abs(both["_pred"] - both["pred"]).max() < 1e-9
    assert len(f.cuts[0]) == 31 and len(f.cuts[1]) == 3
    f = K.fit(K.boost_tree(trees=6), df, "cls", ["a", "b", "c"], ["no", "si"])
    d = K._label(K._assemble(df, ["a", "b", "c"]), "cls", ["no", "si"])
    want = MC.GBTClassifier(**common).fit(d).transform(d).select("a", "b", "c", vector_to_array("probability")[1].alias("p")).distinct().toPandas()
    both = want.merge(f.predict(df).select("a", "b", "c", "pred_si").distinct().toPandas(), on=["a", "b", "c"])
    assert len(both) == len(want) and np.abs(both["p"] - both["pred_si"]).max() < 1e-9
    with pytest.raises(ValueError, match="missing"):
        K.fit(K.boost_tree("regression", trees=1), df.withColumn("y", F.expr("nullif(b, 1.0D)")), "y", ["a"])


def test_boosting_reads_its_rows_for_cells_only(spark, monkeypatch):
    """MLlib gets at most a row per cell."""
    from pyspark.ml import regression as MR

    given, fit = [], MR.GBTRegressor.fit
    monkeypatch.setattr(MR.GBTRegressor, "fit", lambda self, d: given.append((d.count(), d.agg(F.sum("_weight")).first()[0])) or fit(self, d))
    df = spark.range(20000).selectExpr("CAST(id % 7 AS DOUBLE) AS a", "CAST(id % 5 AS DOUBLE) AS b", "CAST(id % 35 AS DOUBLE) AS y")
    K.fit(K.boost_tree("regression", trees=2), df, "y", ["a", "b"])
    assert given == [(35, 20000.0)]
