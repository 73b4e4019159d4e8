"""Property / invariant checks for the operators that have no SQL oracle (SURVEY chk = P)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from faro.operators import cluster as C
from faro.operators import explain as I
from faro.operators import models as K
from faro.operators import resample as R
from faro.plans.registry import all_queries

from .conftest import SMALL, SMOKE

Q = all_queries()


def run(spark, name, d=SMOKE):
    return Q[name].build(spark, d)


#: rows-only queries whose values are checked elsewhere (test_values, test_topics, below)
CHECKED = {"t21_lsa_document_vectors", "t20_choose_k", "t16_t17_lda_topic_terms", "t18_t19_lda_gamma_validation", "t24_word2vec_synonyms", "c06_elbow",
           "c08_silhouette_by_k", "c12_kmeans_vs_hierarchical", "c13_pca_components", "c15_pca_loadings_contributions", "c16_pca_scores_rank", "c17_kmeans_on_scores",
           "c17_biplot_data", "k01_logistic_inference", "k02_penalized_logistic", "k04_lasso_zero_counts", "k06_m13_overfit_gap", "k08_i01_forest_importance",
           "k09_boost_tree_regression", "k10_predict_probabilities", "k13_odds_ratios", "k14_coefficient_comparison", "k15_forest_by_subset", "i04_rank_agreement",
           "v01_fit_resamples", "v04_grid_random_fit", "v05_tune_grid", "v08_last_fit", "r07_bootstrap", "r08_learning_curve", "f14_step_poly", "x01_score_stream",
           "s04_write_table_roundtrip"}


def test_property_queries_registered_run(spark):
    # the other rows-only queries yield rows
    for name, q in sorted(Q.items()):
        if q.sql is None and name not in CHECKED:
            df = q.build(spark, SMOKE)
            assert len(df.columns) > 0 and not df.isEmpty(), name


def test_split_is_partition_independent(spark):
    from faro.plans.inputs import survey
    from faro.sources.tables import Tables

    s = survey(Tables(spark, SMALL))
    a = R.initial_split(s, "id", 0.75, strata="y", seed=42).select("id", "split")
    b = R.initial_split(s.repartition(7, "country"), "id", 0.75, strata="y", seed=42).select("id", "split")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    counts = {r.y: r.n for r in R.training(R.initial_split(s, "id", 0.75, strata="y")).groupBy("y").agg(F.count("*").alias("n")).collect()}
    tot = {r.y: r.n for r in s.groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert all(counts[k] == int(tot[k] * 0.75) for k in tot)


def test_split_moves_no_row_unless_keys_repeat(spark):
    """Cuts by hash give the ranked split, without a window or a shuffle of rows; repeated keys still give exact counts."""
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN NULL ELSE id % 3 END AS g", "id * 2 AS v").repartition(5)
    for strata in (None, "g"):
        sp = R.initial_split(df, "id", 0.7, strata=strata, seed=7)
        ranked, _ = R._ranked(df, "id", strata, 7)
        want = ranked.select("id", F.when(F.col("_rank") <= F.floor(F.col("_n") * 0.7), "train").otherwise("test").alias("split"))
        assert sp.count() == (900 if strata else 1000) and sp.select("id", "split").exceptAll(want).isEmpty()
        plan = sp._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "Repartition" in plan
    twice = spark.range(40).selectExpr("CAST(id / 20 AS LONG) AS id", "id AS v")
    a, b = (R.initial_split(x, "id", 0.7).filter("split = 'train'").select("v") for x in (twice, twice.repartition(7)))
    assert a.exceptAll(b).isEmpty() and a.count() == 28
    got = {r["split"]: r["count"] for r in R.initial_split(twice, "id", 0.7).groupBy("split").count().collect()}
    assert got == {"train": 28, "test": 12}
    none = R.initial_split(spark.range(3), "id", 0.1)
    assert {r["split"] for r in none.collect()} == {"test"} and R.initial_split(spark.range(0), "id").count() == 0


def test_outliers_count_distinct_values_not_rows(spark):
    from faro.operators import profile as P

    df = spark.createDataFrame([("a", float(x)) for x in [1, 2, 2, 3, 3, 4, 99, 99]] + [("b", 5.0), ("b", None), ("c", None)], "g string, x double").repartition(3)
    out = P.outliers_iqr(df, "x", ["g"])
    assert "_c" in out._jdf.queryExecution().optimizedPlan().toString() and "RepartitionByExpression" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r["g"]: r for r in out.collect()}
    assert set(got) == {"a", "b"} and got["b"]["n_outliers"] == 0
    q1, q3 = np.percentile([1, 2, 2, 3, 3, 4, 99, 99], [25, 75])
    assert (got["a"]["q1"], got["a"]["q3"]) == (q1, q3) and got["a"]["n_outliers"] == sum(x > q3 + 1.5 * (q3 - q1) for x in [1, 2, 2, 3, 3, 4, 99, 99])
    assert P.outliers_iqr(df, "x").first()["n_outliers"] == 2


def test_folds_balanced_each_row_once(spark):
    from faro.plans.inputs import survey
    from faro.sources.tables import Tables

    f = R.vfold(survey(Tables(spark, SMALL)), "id", v=5, strata="y")
    sizes = [r.n for r in f.groupBy("fold").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) - min(sizes) <= 2
    assert f.select("id").distinct().count() == f.count()


def test_bootstrap_mean_weight_near_one(spark):
    rows = run(spark, "r07_bootstrap", SMALL).collect()
    assert all(abs(r.mean_weight - 1.0) < 0.05 for r in rows)
    assert all(0.3 < r.n_out_of_bag / 15000 < 0.44 for r in rows)


def test_step_corr_property(spark):
    kept = [r.kept for r in run(spark, "f11_step_corr").collect()]
    assert len(kept) == 4 and not ({"l_extendedprice", "revenue"} <= set(kept))


def test_step_poly_orthonormal(spark):
    df = run(spark, "f14_step_poly").select("price_poly_1", "price_poly_2", "price_poly_3").toPandas().to_numpy()
    g = df.T @ df
    assert np.allclose(g, np.eye(3), atol=1e-8)
    assert np.allclose(df.sum(axis=0), 0.0, atol=1e-8)


def test_calibrate_by_group_monotone(spark):
    pdf = run(spark, "g13_calibrate_by_group", SMALL).toPandas()
    for _, g in pdf.groupby("grp"):
        g = g.sort_values("score")
        assert (np.diff(g["score_cal"].to_numpy()) >= -1e-12).all()


def test_kmeans_lloyd_fixed_point(spark):
    emb = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", F.slice(F.col("embedding").cast("array<double>"), 1, 8).alias("v"))
    a, centers = C.kmeans(emb, "v", 5, nstart=2)
    new = C.centroids(a, "cluster", "v", out="c").orderBy("cluster").collect()
    old = centers.orderBy("cluster").collect()
    for o, n in zip(old, new):
        assert np.allclose(o.center, n.c, atol=1e-3)


def test_elbow_non_increasing(spark):
    w = [r.tot_withinss for r in run(spark, "c06_elbow").orderBy("k").collect()]
    assert all(b <= a * 1.02 for a, b in zip(w, w[1:]))


def test_hierarchical_heights_and_cut(spark):
    emb = spark.read.parquet(f"{SMOKE}/embeddings.parquet").select("vec_id", F.slice(F.col("embedding").cast("array<double>"), 1, 4).alias("v"))
    a, heights = C.hierarchical(emb, "vec_id", "v", k=4, linkage="complete", micro=40)
    assert a.select("hclust").distinct().count() == 4
    assert all(b >= a_ - 1e-9 for a_, b in zip(heights, heights[1:]))


def test_pca_properties(spark):
    comps = run(spark, "c13_pca_components").orderBy("pc").collect()
    var = [r.variance for r in comps]
    assert sum(var) == pytest.approx(5.0, rel=1e-6)  # trace of the correlation matrix = p
    assert var == sorted(var, reverse=True)
    assert comps[-1].cumulative == pytest.approx(1.0)
    load = run(spark, "c15_pca_loadings_contributions").toPandas()
    for _, g in load.groupby("pc"):
        assert g["contribution"].sum() == pytest.approx(100.0)
    L = load.pivot(index="variable", columns="pc", values="loading").to_numpy()
    assert np.allclose(L.T @ L, np.eye(L.shape[1]), atol=1e-8)


def test_logistic_score_equations(spark):
    from faro.plans.q_models import FEATS, LEVELS, _split

    train, _ = _split(spark, SMOKE)
    f = K.fit(K.logistic_reg(), train, "y", FEATS, LEVELS)
    p = f.predict(train).withColumn("r", (F.col("y") == "si").cast("double") - F.col("pred_si"))
    sums = p.agg(F.sum("r").alias("s0"), *[F.sum(F.col("r") * F.col(c)).alias(c) for c in FEATS]).first()
    assert all(abs(v) < 1e-2 * 100 for v in sums)  # gradient at the optimum ~ 0 (relative to n)


def test_glm_inference_matches_mllib_logistic(spark):
    est = {r.term: r.estimate for r in run(spark, "k01_logistic_inference").collect()}
    assert set(est) == {"price_k", "balance_k", "month", "(Intercept)"}
    assert all(np.isfinite(list(est.values())))


def test_lasso_zero_count_non_decreasing(spark):
    z = [r.n_zero for r in run(spark, "k04_lasso_zero_counts").orderBy("penalty").collect()]
    assert z == sorted(z)


def test_forest_importance_sums_to_one(spark):
    imp = [r.importance for r in run(spark, "k08_i01_forest_importance").collect()]
    assert sum(imp) == pytest.approx(1.0)


def test_permutation_preserves_values(spark):
    df = spark.range(0, 200).withColumn("x", F.col("id") * 3)
    p = I.permute_column(df, "id", "x", 1)
    assert sorted(r.x for r in p.collect()) == sorted(r.x for r in df.collect())
    assert p.filter(F.col("x") != F.col("id") * 3).count() > 150


def test_lsa_singular_values_sorted(spark):
    from faro.operators import text as TX
    from faro.operators import topics as TP
    from faro.plans.q_text import _clean

    w = TX.tf_idf(TX.dtm_triples(_clean(spark, SMOKE), "doc_id"), "doc_id")
    dv, tv, s = TP.lsa(w, "doc_id", 4)
    assert s == sorted(s, reverse=True) and all(x > 0 for x in s)
    # V has unit columns, so the term vectors V S have norm s_j per dimension; U S likewise for documents
    tn = {r.dim: r.n2 for r in tv.groupBy("dim").agg(F.sum(F.col("value") ** 2).alias("n2")).collect()}
    dn = {r.dim: r.n2 for r in dv.groupBy("dim").agg(F.sum(F.col("value") ** 2).alias("n2")).collect()}
    for j, sj in enumerate(s, start=1):
        assert tn[j] == pytest.approx(sj * sj, rel=1e-6) and dn[j] == pytest.approx(sj * sj, rel=1e-6)


def test_stream_equals_batch(spark):
    from faro.plans.q_stream import fitted_event_scorer

    stream_out = run(spark, "x01_score_stream")
    score = fitted_event_scorer(spark, SMOKE)
    batch = score(spark.read.parquet(f"{SMOKE}/events.parquet"))
    cols = ["event_id", "pred_class"]
    assert stream_out.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert stream_out.count() == batch.count()


def test_write_roundtrip_counts(spark):
    got = {r.l_returnflag: r.n for r in run(spark, "s04_write_table_roundtrip").collect()}
    li = spark.read.parquet(f"{SMOKE}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    assert got == {r.l_returnflag: r["count"] for r in li}


def test_silhouette_matches_bruteforce(spark):
    emb = spark.read.parquet(f"{SMOKE}/embeddings.parquet").select(
        "vec_id", "label", F.slice(F.col("embedding").cast("array<double>"), 1, 6).alias("v")).toPandas()
    s = C.silhouette(spark.createDataFrame(emb), "vec_id", "v", "label").toPandas().set_index("vec_id")
    X = np.array(emb["v"].tolist())
    lab = emb["label"].to_numpy()
    D = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    for i in range(0, len(X), 37):
        own = (lab == lab[i])
        a = D[i, own].sum() / max(own.sum() - 1, 1)
        b = min(D[i, lab == c].mean() for c in set(lab) if c != lab[i])
        expect = 0.0 if own.sum() == 1 else (b - a) / max(a, b)
        assert s.loc[emb["vec_id"][i], "silhouette"] == pytest.approx(expect, rel=1e-9, abs=1e-12)


def test_ridge_cv_from_gram_matches_refit(spark):
    from faro.plans.q_models import _survey_model

    f = R.vfold(_survey_model(spark, SMOKE), "id", v=3, seed=1).withColumn("t", (F.col("y") == "si").cast("double"))
    rows = K.gram_by_fold(f, "fold", "t", ["price_k", "balance_k"]).collect()
    cv = {(lam, fo): r for lam, fo, r in K.ridge_cv_from_gram(rows, ["price_k", "balance_k"], [0.0])}
    pdf = f.select("fold", "price_k", "balance_k", "t").toPandas()
    tr = pdf[pdf.fold != 1]
    te = pdf[pdf.fold == 1]
    X = np.c_[np.ones(len(tr)), tr[["price_k", "balance_k"]]]
    b = np.linalg.lstsq(X, tr["t"], rcond=None)[0]
    Xt = np.c_[np.ones(len(te)), te[["price_k", "balance_k"]]]
    rmse = float(np.sqrt(np.mean((te["t"] - Xt @ b) ** 2)))
    assert cv[(0.0, 1)] == pytest.approx(rmse, rel=1e-8)


def test_ranks_and_running_sums_match_global_window(spark):
    """Two-level ranks / running sums equal one global window, under any partitioning."""
    from pyspark.sql import Window

    from faro.operators.ranking import running_sums, value_rank

    df = spark.range(0, 3000).select(F.col("id"), ((F.col("id") * 7919) % 1013).cast("double").alias("v"),
                                     (F.col("id") % 3).alias("g"))
    r1 = value_rank(df.repartition(5), "v", ["id"], descending=True).select("id", "rank")
    r2 = df.select("id", F.row_number().over(Window.orderBy(F.desc("v"), "id")).alias("rank"))
    assert r1.exceptAll(r2).count() == 0
    # two thirds of the rows hold one value: its rows are split by the tie-break
    hot = df.withColumn("v", F.when(F.col("id") % 3 > 0, 5.0).otherwise(F.col("v")))
    h1 = value_rank(hot.repartition(5), "v", ["id"], descending=False).select("id", "rank")
    h2 = hot.select("id", F.row_number().over(Window.orderBy("v", "id")).alias("rank"))
    assert h1.exceptAll(h2).count() == 0
    k1 = value_rank(hot.withColumn("g", F.when(F.col("g") > 0, F.col("g"))).repartition(5), "v", ["id"], groups=["g"]).select("id", "rank")
    k2 = hot.select("id", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("v"), "id")).alias("rank"))
    assert k1.count() == 3000 and k1.exceptAll(k2).count() == 0
    agg = df.groupBy("g", "v").agg(F.count("*").alias("c"))
    rs = running_sums(agg.repartition(7), "v", ["c"], ["g"]).select("g", "v", "c_cum")
    ref = agg.select("g", "v", F.sum("c").over(Window.partitionBy("g").orderBy("v")).alias("c_cum"))
    assert rs.exceptAll(ref).count() == 0


def test_auc_invariant_to_partitioning(spark):
    from faro.operators import metrics as M
    from faro.plans.inputs import scored
    from faro.sources.tables import Tables

    s = scored(Tables(spark, SMALL))
    a = {r.grp: r.roc_auc for r in M.roc_auc(s, "truth", "score", 1, by=["grp"]).collect()}
    b = {r.grp: r.roc_auc for r in M.roc_auc(s.repartition(11, "doc_id"), "truth", "score", 1, by=["grp"]).collect()}
    assert a == pytest.approx(b)
