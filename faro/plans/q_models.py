"""Model, tuning and interpretation queries (K, V, I, M13, R05)."""

from __future__ import annotations

from pyspark.sql import functions as F

from faro.operators import explain as I
from faro.operators import metrics as M
from faro.operators import models as K
from faro.operators import resample as R
from faro.operators import tuning as V
from faro.operators.cluster import centroids
from faro.operators.ranking import stage
from faro.operators.recipe import Recipe
from faro.operators.verbs import with_params
from faro.operators.workflow import Workflow, batch_models, last_fit
from faro.plans.inputs import ITEMS_SQL, SCORED_SQL, SURVEY_SQL, items, scored, survey
from faro.plans.registry import query
from faro.sources.tables import Tables

LEVELS = ["no", "si"]
FEATS = ["price_k", "balance_k", "month"]


def _survey_model(spark, d):
    s = survey(Tables(spark, d))
    return s.withColumn("price_k", F.col("price") / 1000).withColumn("balance_k", F.col("balance") / 1000)


def _split(spark, d):
    """Training and test rows, joined and split once for all fits and metrics that read them."""
    sp = stage(R.initial_split(_survey_model(spark, d), "id", 0.75, strata="y", seed=42))
    return R.training(sp), R.testing(sp)


# ----------------------------------------------------------------- oracle-checked


OLS1_SQL = f"""WITH it AS ({ITEMS_SQL}), s AS (SELECT l_quantity AS x, l_extendedprice / 1000 AS y FROM it),
st AS (SELECT count(*) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy,
       regr_sxy(y, x) AS sxy, avg(x) AS mx FROM s),
e AS (SELECT *, (syy - sxy * sxy / sxx) / (n - 2) AS s2 FROM st)
SELECT '(Intercept)' AS term, a AS estimate, sqrt(s2 * (1.0 / n + mx * mx / sxx)) AS std_error, a / sqrt(s2 * (1.0 / n + mx * mx / sxx)) AS statistic FROM e
UNION ALL SELECT 'l_quantity', b, sqrt(s2 / sxx), b / sqrt(s2 / sxx) FROM e"""


@query("k03_ols_one_predictor", OLS1_SQL, dbl=["estimate", "std_error", "statistic"])
def k03_ols_one_predictor(spark, d):
    it = items(Tables(spark, d)).withColumn("price_k", F.col("l_extendedprice") / 1000)
    return K.ols(it, "price_k", ["l_quantity"]).select("term", "estimate", "std_error", "statistic")


@query("k12_tidy", OLS1_SQL, dbl=["estimate", "std_error", "statistic"])
def k12_tidy(spark, d):
    """The coefficient table of a fitted linear model."""
    it = items(Tables(spark, d)).withColumn("price_k", F.col("l_extendedprice") / 1000)
    return K.tidy(K.fit(K.linear_reg(), it, "price_k", ["l_quantity"])).select("term", "estimate", "std_error", "statistic")


_BATCH_KEY = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


@query("k16_batch_models", f"""WITH it AS (SELECT {_BATCH_KEY} AS id, l_quantity, l_extendedprice / 1000 + l_quantity AS y FROM lineitem),
r AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', '42', id)), id) AS rk, count(*) OVER () AS n FROM it),
tr AS (SELECT * FROM r WHERE rk <= floor(n * 0.75)), te AS (SELECT * FROM r WHERE rk > floor(n * 0.75)),
b AS (SELECT 'ols' AS model, regr_slope(y, l_quantity) AS b, regr_intercept(y, l_quantity) AS a FROM tr UNION ALL SELECT 'null', 0, avg(y) FROM tr),
p AS (SELECT model, y, a + b * l_quantity AS yh FROM te, b),
m AS (SELECT model, sqrt(avg((y - yh) * (y - yh))) AS rmse, avg(abs(y - yh)) AS mae, avg((y - yh) * (y - yh)) AS mse,
      1 - sum((y - yh) * (y - yh)) / (var_pop(y) * count(*)) AS rsq_trad FROM p GROUP BY model)
UNPIVOT m ON rmse, mae, mse, rsq_trad INTO NAME metric VALUE estimate""", dbl=["estimate"])
def k16_batch_models(spark, d):
    """Two specifications on one recipe: least squares, and a LASSO whose penalty leaves the mean only."""
    it = Tables(spark, d).lineitem.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"), "l_quantity",
                                          (F.col("l_extendedprice") / 1000 + F.col("l_quantity")).alias("value"))
    sp = R.initial_split(it, "id", 0.75, seed=42)
    got = batch_models(Recipe("value", ids=["id"], predictors=["l_quantity"]).step_normalize(),
                       {"ols": K.linear_reg(), "null": K.linear_reg(1e4, 1.0)}, R.training(sp), R.testing(sp))
    return got.filter(F.col("metric") != "rsq")


@query("r05_press_residuals", f"""WITH it AS ({ITEMS_SQL}), s AS (SELECT id, l_quantity AS x, l_extendedprice / 1000 AS y FROM it),
st AS (SELECT count(*) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx, avg(x) AS mx FROM s)
SELECT id, a + b * x AS fitted, 1.0 / n + (x - mx) * (x - mx) / sxx AS leverage,
(y - (a + b * x)) / (1 - (1.0 / n + (x - mx) * (x - mx) / sxx)) AS press_residual FROM s, st""",
       dbl=["fitted", "leverage", "press_residual"])
def r05_press_residuals(spark, d):
    it = items(Tables(spark, d)).withColumn("price_k", F.col("l_extendedprice") / 1000)
    return K.press_residuals(it, "id", "price_k", ["l_quantity"])


@query("k15_fit_by_group", f"""WITH it AS ({ITEMS_SQL})
SELECT l_returnflag, '(Intercept)' AS term, regr_intercept(l_extendedprice / 1000, l_quantity) AS estimate FROM it GROUP BY 1
UNION ALL SELECT l_returnflag, 'l_quantity', regr_slope(l_extendedprice / 1000, l_quantity) FROM it GROUP BY 1""", dbl=["estimate"])
def k15_fit_by_group(spark, d):
    it = items(Tables(spark, d)).withColumn("price_k", F.col("l_extendedprice") / 1000)
    return K.fit_by_group(it, "l_returnflag", "price_k", ["l_quantity"])


@query("k15_forest_by_subset")
def k15_forest_by_subset(spark, d):
    """A forest per order status, each evaluated on the test rows of its own status."""
    train, test = _split(spark, d)
    fits = K.fit_by_subset(K.rand_forest(trees=10), train, "status", "y", ["price_k", "balance_k"], LEVELS)
    parts = [M.accuracy(f.predict(test.filter(F.col("status") == g)), "y", "pred_class").select(F.lit(g).alias("status"), "accuracy") for g, f in fits.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_gini_cols = ["price_k", "balance_k"]
_gini_long = " UNION ALL ".join(f"SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS value, y FROM s" for c in _gini_cols)


@query("k07_best_split_gini", f"""WITH s0 AS ({SURVEY_SQL}), s AS (SELECT *, price / 1000 AS price_k, balance / 1000 AS balance_k FROM s0),
l AS ({_gini_long}),
c AS (SELECT variable, value, count_if(y = 'no') AS c0, count_if(y = 'si') AS c1 FROM l GROUP BY ALL),
cum AS (SELECT *, sum(c0) OVER w AS l0, sum(c1) OVER w AS l1, sum(c0) OVER (PARTITION BY variable) AS t0, sum(c1) OVER (PARTITION BY variable) AS t1
        FROM c WINDOW w AS (PARTITION BY variable ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT variable, value, CAST(l0 + l1 AS DOUBLE) AS nl, CAST(t0 + t1 - l0 - l1 AS DOUBLE) AS nr, CAST(t0 + t1 AS DOUBLE) AS nt, l0, l1, t0, t1 FROM cum),
h AS (SELECT variable, value, 1 - pow(t0 / nt, 2) - pow(t1 / nt, 2) AS node_gini,
      (nl * (1 - pow(l0 / nl, 2) - pow(l1 / nl, 2)) + nr * (1 - pow((t0 - l0) / nr, 2) - pow((t1 - l1) / nr, 2))) / nt AS weighted_gini FROM g WHERE nr > 0),
b AS (SELECT variable, min({{'w': weighted_gini, 'v': value, 'g': node_gini}}) AS b FROM h GROUP BY 1)
SELECT variable, b.v AS threshold, b.g AS node_gini, b.w AS weighted_gini, b.g - b.w AS gain FROM b""",
       dbl=["threshold", "node_gini", "weighted_gini", "gain"])
def k07_best_split_gini(spark, d):
    return K.best_split_gini(_survey_model(spark, d), "y", _gini_cols)


@query("k05_knn_centroids", """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT label, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM e),
c AS (SELECT label AS q, list(m ORDER BY i) AS cv FROM (SELECT label, i, avg(x) AS m FROM x GROUP BY ALL) GROUP BY label),
d AS (SELECT c.q, e.label AS lab, e.vec_id, sqrt(list_sum(list_transform(range(1, 65), lambda i: (e.v[i] - c.cv[i]) * (e.v[i] - c.cv[i])))) AS d FROM c, e),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d, vec_id) AS r FROM d) WHERE r <= 7),
v AS (SELECT q, lab, count(*) AS votes FROM nn GROUP BY ALL)
SELECT q AS label, m.l AS pred_label, m.v AS votes, m.v / CAST(7 AS DOUBLE) AS prob FROM (SELECT q, max({'v': votes, 'l': -lab}) AS mm FROM v GROUP BY q),
LATERAL (SELECT -mm.l AS l, mm.v AS v) m""", dbl=["prob"])
def k05_knn_centroids(spark, d):
    emb = Tables(spark, d).embeddings.withColumn("embedding", F.col("embedding").cast("array<double>"))
    q = centroids(emb, "label", "embedding").select("label", F.col("centroid").alias("embedding"))
    return K.knn_predict(q, emb.select("vec_id", "label", "embedding"), "label", "embedding", "label", 7, key="vec_id")


# fold scores of a rule classifier (price above a cutoff => 'si'), used by the selection oracles
CUTS = [100.0, 150.0, 200.0, 250.0]
_cuts = ", ".join(f"({c})" for c in CUTS)
FOLDS_SQL = f"""WITH s0 AS ({SURVEY_SQL}),
r AS (SELECT *, price / 1000 AS price_k, row_number() OVER (PARTITION BY y ORDER BY md5(concat_ws(':', '42', CAST(id AS VARCHAR))), id) AS rk FROM s0),
f AS (SELECT *, CAST((rk - 1) % 5 + 1 AS INTEGER) AS fold FROM r),
g AS (SELECT CAST(cutoff AS DOUBLE) AS cutoff FROM (VALUES {_cuts}) v(cutoff)),
fs AS (SELECT cutoff, fold, 'accuracy' AS metric, avg(CAST((price_k > cutoff) = (y = 'si') AS DOUBLE)) AS estimate FROM f, g GROUP BY ALL)
"""


def _fold_scores(spark, d):
    f = R.vfold(_survey_model(spark, d), "id", v=5, strata="y", seed=42)
    g = spark.createDataFrame([(c,) for c in CUTS], "cutoff double")
    return (f.crossJoin(F.broadcast(g)).groupBy("cutoff", "fold")
            .agg(F.avg(((F.col("price_k") > F.col("cutoff")) == (F.col("y") == "si")).cast("double")).alias("estimate"))
            .withColumn("metric", F.lit("accuracy")))


@query("v02_collect_metrics", FOLDS_SQL + """SELECT cutoff, metric, avg(estimate) AS mean, count(estimate) AS n,
stddev_samp(estimate) / sqrt(count(estimate)) AS std_err FROM fs GROUP BY ALL""", dbl=["cutoff", "mean", "std_err"])
def v02_collect_metrics(spark, d):
    return V.collect_metrics(_fold_scores(spark, d), ["cutoff"])


@query("v06_show_best", FOLDS_SQL + """, sm AS (SELECT cutoff, metric, avg(estimate) AS mean, count(estimate) AS n,
stddev_samp(estimate) / sqrt(count(estimate)) AS std_err FROM fs GROUP BY ALL)
SELECT * FROM sm ORDER BY mean DESC, cutoff LIMIT 2""", dbl=["cutoff", "mean", "std_err"])
def v06_show_best(spark, d):
    return V.show_best(V.collect_metrics(_fold_scores(spark, d), ["cutoff"]), "accuracy", 2, ["cutoff"])


@query("v07_select_by_one_std_err", FOLDS_SQL + """, sm AS (SELECT cutoff, metric, avg(estimate) AS mean, count(estimate) AS n,
stddev_samp(estimate) / sqrt(count(estimate)) AS std_err FROM fs GROUP BY ALL),
b AS (SELECT mean - std_err AS lo FROM sm ORDER BY mean DESC, cutoff LIMIT 1)
SELECT cutoff, metric, mean, n, std_err FROM sm, b WHERE mean >= lo ORDER BY cutoff DESC LIMIT 1""", dbl=["cutoff", "mean", "std_err"])
def v07_select_by_one_std_err(spark, d):
    s = V.collect_metrics(_fold_scores(spark, d), ["cutoff"])
    return V.select_by_one_std_err(s, "accuracy", [F.desc("cutoff")], ["cutoff"])


@query("v10_gram_by_fold", f"""WITH s0 AS ({SURVEY_SQL}),
r AS (SELECT *, price / 100000 AS price_h, balance / 1000 AS balance_k,
      row_number() OVER (PARTITION BY y ORDER BY md5(concat_ws(':', '42', CAST(id AS VARCHAR))), id) AS rk FROM s0),
f AS (SELECT *, CAST((rk - 1) % 5 + 1 AS INTEGER) AS fold, CAST(y = 'si' AS DOUBLE) AS t FROM r)
SELECT fold, count(*) AS n, sum(t * t) AS yy, sum(t) AS xy_0, sum(price_h * t) AS xy_1, sum(balance_k * t) AS xy_2,
count(*) * 1.0 AS xx_0_0, sum(price_h) AS xx_0_1, sum(balance_k) AS xx_0_2, sum(price_h * price_h) AS xx_1_1,
sum(price_h * balance_k) AS xx_1_2, sum(balance_k * balance_k) AS xx_2_2 FROM f GROUP BY fold""",
       dbl=["yy", "xy_0", "xy_1", "xy_2", "xx_0_0", "xx_0_1", "xx_0_2", "xx_1_1", "xx_1_2", "xx_2_2"])
def v10_gram_by_fold(spark, d):
    # price in units of 100k keeps the cross-product sums at a magnitude where 6 decimals compare exactly
    f = (R.vfold(_survey_model(spark, d), "id", v=5, strata="y", seed=42)
         .withColumn("t", (F.col("y") == "si").cast("double")).withColumn("price_h", F.col("price") / 100000))
    return K.gram_by_fold(f, "fold", "t", ["price_h", "balance_k"])


@query("i03_partial_dependence", f"""WITH s0 AS ({SURVEY_SQL}), s AS (SELECT *, balance / 1000 AS balance_k FROM s0),
g AS (SELECT CAST(v AS DOUBLE) AS grid_value FROM (VALUES (50.0), (150.0), (250.0), (350.0)) t(v))
SELECT grid_value, avg(1.0 / (1.0 + exp(-(-1.2 + 0.002 * grid_value + 0.01 * balance_k)))) AS mean_prediction, count(*) AS n
FROM s, g GROUP BY grid_value""", dbl=["grid_value", "mean_prediction"])
def i03_partial_dependence(spark, d):
    score = I.linear_logistic({"price_k": 0.002, "balance_k": 0.01}, -1.2)
    return I.partial_dependence(_survey_model(spark, d).select("price_k", "balance_k"), "price_k", [50.0, 150.0, 250.0, 350.0],
                                score, "prob")


# ----------------------------------------------------------------- property-checked (tests/)


@query("k01_logistic_inference")
def k01_logistic_inference(spark, d):
    train, _ = _split(spark, d)
    return K.logistic_inference(train, "y", FEATS, LEVELS)


@query("k13_odds_ratios")
def k13_odds_ratios(spark, d):
    train, _ = _split(spark, d)
    return K.odds_ratios(K.logistic_inference(train, "y", FEATS, LEVELS))


@query("k02_penalized_logistic")
def k02_penalized_logistic(spark, d):
    train, _ = _split(spark, d)
    return K.tidy(K.fit(K.logistic_reg(penalty=0.01, mixture=1.0), train, "y", FEATS, LEVELS))


@query("k04_lasso_zero_counts")
def k04_lasso_zero_counts(spark, d):
    """K04 + K14: number of zero coefficients along a LASSO path (non-decreasing in lambda)."""
    it = items(Tables(spark, d)).withColumn("price_k", F.col("l_extendedprice") / 1000)
    rows = []
    for lam in [0.001, 0.01, 0.1, 1.0, 10.0]:
        f = K.fit(K.linear_reg(penalty=lam, mixture=1.0), it, "price_k", ["l_quantity", "l_discount", "l_tax"])
        rows.append((lam, sum(1 for c in f.model.coefficients if abs(c) < 1e-12)))
    return spark.createDataFrame(rows, "penalty double, n_zero int")


@query("k10_predict_probabilities")
def k10_predict_probabilities(spark, d):
    train, test = _split(spark, d)
    f = K.fit(K.logistic_reg(), train, "y", FEATS, LEVELS)
    return f.predict(test).select("id", "y", "pred_class", "pred_no", "pred_si")


@query("k11_workflow_metrics")
def k11_workflow_metrics(spark, d):
    """K11 + K16: one recipe, several model specs; one metric table."""
    train, test = _split(spark, d)
    rec = Recipe("y", ids=["id"], predictors=["price_k", "balance_k", "month", "segment"]).step_dummy().step_normalize()
    specs = {"logistic": K.logistic_reg(), "tree": K.decision_tree(tree_depth=4),
             "forest": K.rand_forest(trees=30), "boost": K.boost_tree(trees=20)}
    return batch_models(rec, specs, train, test, LEVELS)


@query("k11_last_fit_linear", f"""WITH it AS ({ITEMS_SQL}),
r AS (SELECT *, l_extendedprice / 1000 AS y, row_number() OVER (ORDER BY md5(concat_ws(':', '42', CAST(id AS VARCHAR))), id) AS rk, count(*) OVER () AS n FROM it),
tr AS (SELECT * FROM r WHERE rk <= floor(n * 0.75)), te AS (SELECT * FROM r WHERE rk > floor(n * 0.75)),
b AS (SELECT regr_slope(y, l_quantity) AS b, regr_intercept(y, l_quantity) AS a FROM tr),
p AS (SELECT y, a + b * l_quantity AS yh FROM te, b),
m AS (SELECT sqrt(avg((y - yh) * (y - yh))) AS rmse, avg(abs(y - yh)) AS mae, avg((y - yh) * (y - yh)) AS mse, pow(corr(y, yh), 2) AS rsq,
      1 - sum((y - yh) * (y - yh)) / (var_pop(y) * count(*)) AS rsq_trad FROM p)
UNPIVOT m ON rmse, mae, mse, rsq, rsq_trad INTO NAME metric VALUE estimate""", dbl=["estimate"])
def k11_last_fit_linear(spark, d):
    it = items(Tables(spark, d)).withColumn("price_k", F.col("l_extendedprice") / 1000)
    sp = R.initial_split(it, "id", 0.75, seed=42)
    wf = Workflow(Recipe("price_k", ids=["id"], predictors=["l_quantity"]).step_normalize(), K.linear_reg())
    return last_fit(wf, R.training(sp), R.testing(sp))


@query("k06_m13_overfit_gap")
def k06_m13_overfit_gap(spark, d):
    """Train vs test error of decision trees by depth."""
    train, test = _split(spark, d)
    tr, te = train.withColumn("split", F.lit("train")), test.withColumn("split", F.lit("test"))
    both = tr.unionByName(te)
    parts = []
    for depth in (1, 3, 6, 10):
        f = K.fit(K.decision_tree(tree_depth=depth), train, "y", FEATS, LEVELS)
        parts.append(f.predict(both).withColumn("depth", F.lit(depth)))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return M.overfit_gap(u, "y", "pred_class", "split", ["depth"])


@query("k08_i01_forest_importance")
def k08_i01_forest_importance(spark, d):
    train, _ = _split(spark, d)
    f = K.fit(K.rand_forest(trees=40, mtry=2), train, "y", FEATS, LEVELS)
    return I.importance_impurity(f)


@query("k09_boost_tree_regression")
def k09_boost_tree_regression(spark, d):
    it = items(Tables(spark, d)).withColumn("price_k", F.col("l_extendedprice") / 1000)
    sp = R.initial_split(it, "id", 0.8, seed=42)
    f = K.fit(K.boost_tree(mode="regression", trees=20, tree_depth=3), R.training(sp), "price_k",
              ["l_quantity", "l_discount", "l_tax"])
    return M.regression_metrics(f.predict(R.testing(sp)), "price_k", "pred")


@query("i02_permutation_importance")
def i02_permutation_importance(spark, d):
    train, test = _split(spark, d)
    f = K.fit(K.logistic_reg(), train, "y", FEATS + ["year"], LEVELS)

    def metric(scored, by):
        return M.accuracy(scored, "y", "pred_class", by).withColumnRenamed("accuracy", "estimate")

    return I.importance_permutation(test.select("id", "y", *FEATS, "year"), "id", FEATS + ["year"], f.predict, metric)


_I02_VARS = ["price_k", "balance_k", "month"]
_I02_PROB = "1.0 / (1.0 + exp(-(-1.2 + 0.004 * price_k + 0.05 * balance_k)))"
_I02_SHIFT = "CAST(floor(CAST(('0x' || substr(md5('42:' || variable || ':' || rep), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE) * (n - 1)) AS BIGINT) + 1"


@query("i02_permutation_linear", f"""WITH s0 AS ({SURVEY_SQL}),
r AS (SELECT price / 1000 AS price_k, balance / 1000 AS balance_k, CAST(month AS DOUBLE) AS month, CAST(y = 'si' AS DOUBLE) AS t,
      row_number() OVER (ORDER BY md5(concat_ws(':', '42', CAST(id AS VARCHAR))), id) AS rk, count(*) OVER () AS n FROM s0),
v AS (SELECT * FROM (VALUES ('price_k'), ('balance_k'), ('month')) a(variable), (VALUES (1), (2)) b(rep)),
m AS (SELECT variable, rep, (rk - 1 + {_I02_SHIFT}) % n + 1 AS rk, price_k AS mp, balance_k AS mb FROM r, v),
x AS (SELECT m.variable, m.rep, t, CASE variable WHEN 'price_k' THEN mp ELSE price_k END AS price_k, CASE variable WHEN 'balance_k' THEN mb ELSE balance_k END AS balance_k
      FROM r JOIN m ON r.rk = m.rk),
e AS (SELECT variable, rep, avg(pow({_I02_PROB} - t, 2)) AS estimate FROM x GROUP BY ALL),
b AS (SELECT avg(pow({_I02_PROB} - t, 2)) AS base FROM r)
SELECT variable, avg(estimate) AS permuted, any_value(base) AS base, any_value(base) - avg(estimate) AS "drop" FROM e, b GROUP BY variable""", dbl=["permuted", "base", '"drop"'])
def i02_permutation_linear(spark, d):
    """Permutation importance of a fixed logistic scorer (mean squared error), two repetitions."""
    s = _survey_model(spark, d).withColumn("t", (F.col("y") == "si").cast("double"))
    score = I.linear_logistic({"price_k": 0.004, "balance_k": 0.05}, -1.2)

    def metric(scored, by):
        return scored.groupBy(*by).agg(F.avg(F.pow(F.col("prob") - F.col("t"), 2)).alias("estimate"))

    return I.importance_permutation(s.select("id", "t", *_I02_VARS), "id", _I02_VARS, score, metric, n_rep=2)


@query("i04_rank_agreement")
def i04_rank_agreement(spark, d):
    train, _ = _split(spark, d)
    imp = I.importance_impurity(K.fit(K.rand_forest(trees=30), train, "y", FEATS, LEVELS))
    z = K.logistic_inference(train, "y", FEATS, LEVELS).withColumn("abs_z", F.abs("statistic")).withColumnRenamed("term", "variable")
    return I.rank_agreement(imp, z, "variable", "importance", "abs_z")


@query("v01_fit_resamples")
def v01_fit_resamples(spark, d):
    """Recipe re-prepped inside each fold, logistic fit, fold accuracy/AUC, then collect_metrics."""
    data = R.vfold(_survey_model(spark, d), "id", v=5, strata="y", seed=42).cache()

    def fit_score(analysis, assessment):
        pr = Recipe("y", ids=["id"], predictors=FEATS).step_normalize().prep(analysis)
        f = K.fit(K.logistic_reg(), pr.bake(analysis), "y", FEATS, LEVELS)
        p = f.predict(pr.bake(assessment))
        return [("accuracy", M.accuracy(p, "y", "pred_class").first()["accuracy"]),
                ("roc_auc", M.roc_auc(p, "y", "pred_si", "si").first()["roc_auc"])]

    rows = V.fit_resamples(data, "fold", 5, fit_score)
    data.unpersist()
    fs = spark.createDataFrame(rows, "fold int, metric string, estimate double").withColumn("config", F.lit("logistic"))
    return V.collect_metrics(fs, ["config"])


@query("v05_tune_grid")
def v05_tune_grid(spark, d):
    """Penalised logistic over a regular log10 penalty grid x 5 folds; mean/std_err per config."""
    data = R.vfold(_survey_model(spark, d), "id", v=5, strata="y", seed=42).cache()
    grid = [r.asDict() for r in V.grid_regular(spark, {"penalty": ("log10", -4, 0), "mixture": [0.0, 1.0]}, 3).collect()]

    def fit_score(cfg, a, b):
        f = K.fit(K.logistic_reg(penalty=cfg["penalty"], mixture=cfg["mixture"]), a, "y", FEATS, LEVELS)
        return [("roc_auc", M.roc_auc(f.predict(b), "y", "pred_si", "si").first()["roc_auc"])]

    rows = V.tune_grid(data, "fold", 5, grid, fit_score)
    data.unpersist()
    fs = spark.createDataFrame([(grid[c]["penalty"], grid[c]["mixture"], f, m, v) for c, f, m, v in rows],
                               "penalty double, mixture double, fold int, metric string, estimate double")
    return V.collect_metrics(fs, ["penalty", "mixture"])


@query("v08_last_fit")
def v08_last_fit(spark, d):
    train, test = _split(spark, d)
    wf = Workflow(Recipe("y", ids=["id"], predictors=FEATS), K.logistic_reg(), LEVELS).set(penalty=0.001, mixture=0.0)
    return last_fit(wf, train, test)


@query("v09_v10_ridge_cv_from_gram")
def v09_v10_ridge_cv_from_gram(spark, d):
    """Whole ridge CV path from one per-fold gram aggregation (no refits on data)."""
    f = R.vfold(_survey_model(spark, d), "id", v=5, strata="y", seed=42).withColumn("t", (F.col("y") == "si").cast("double"))
    rows = K.gram_by_fold(f, "fold", "t", ["price_k", "balance_k"]).collect()  # one row per fold
    out = K.ridge_cv_from_gram(rows, ["price_k", "balance_k"], [0.0, 1.0, 10.0, 100.0])
    fs = spark.createDataFrame(out, "penalty double, fold int, rmse double")
    return fs.groupBy("penalty").agg(F.avg("rmse").alias("mean_rmse"), F.count(F.lit(1)).alias("n"))


def _grid_accuracy(spark, d, grid):
    """Accuracy of the predictions table at each cutoff of the literal grid (further grid columns are carried along)."""
    hit = ((F.col("score") >= F.col("threshold")).cast("int") == F.col("truth")).cast("double")
    s = scored(Tables(spark, d)).select("score", "truth").filter("truth is not null")
    return with_params(s, grid).groupBy(*grid.columns).agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


_GRID_SQL = f"WITH s AS (SELECT * FROM ({SCORED_SQL}) WHERE truth IS NOT NULL), "


@query("v03_grid_regular", _GRID_SQL + """g AS (SELECT a.i / CAST(4 AS DOUBLE) AS threshold, pow(10.0, -3 + b.i) AS penalty FROM range(5) a(i), range(3) b(i))
SELECT threshold, penalty, count(*) AS n, avg(CAST(CAST(score >= threshold AS INTEGER) = truth AS INTEGER)) - penalty * threshold AS penalised FROM s, g
GROUP BY threshold, penalty""", dbl=["threshold", "penalty", "penalised"])
def v03_grid_regular(spark, d):
    """Cutoffs on a linear and penalties on a log10 axis, levels per parameter; accuracy less the penalty times the cutoff."""
    grid = V.grid_regular(spark, {"threshold": ("num", 0.0, 1.0), "penalty": ("log10", -3, -1)}, {"threshold": 5, "penalty": 3})
    out = _grid_accuracy(spark, d, grid)
    return out.select("threshold", "penalty", "n", (F.col("accuracy") - F.col("penalty") * F.col("threshold")).alias("penalised"))


@query("v04_grid_random", _GRID_SQL + """g AS (SELECT i AS config, CAST(('0x' || substr(md5('7:' || i || ':threshold'), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS threshold
FROM range(1, 9) r(i)) SELECT config, threshold, count(*) AS n, avg(CAST(CAST(score >= threshold AS INTEGER) = truth AS INTEGER)) AS accuracy FROM s, g GROUP BY ALL""",
       dbl=["threshold", "accuracy"])
def v04_grid_random(spark, d):
    return _grid_accuracy(spark, d, V.grid_random(spark, {"threshold": ("num", 0.0, 1.0)}, 8, seed=7))


@query("v04_grid_random_fit")
def v04_grid_random_fit(spark, d):
    """Random penalty grid (hash uniforms) scored on the test split."""
    train, test = _split(spark, d)
    grid = V.grid_random(spark, {"penalty": ("log10", -4, 0)}, 4, seed=7).collect()
    rows = []
    for g in grid:
        p = K.fit(K.logistic_reg(penalty=g["penalty"]), train, "y", FEATS, LEVELS).predict(test)
        rows.append((int(g["config"]), float(g["penalty"]), float(M.roc_auc(p, "y", "pred_si", "si").first()["roc_auc"])))
    return spark.createDataFrame(rows, "config int, penalty double, roc_auc double")


@query("r08_learning_curve")
def r08_learning_curve(spark, d):
    """Train and test accuracy of a logistic fit on nested training fractions."""
    train, test = _split(spark, d)
    fr = [0.25, 0.5, 1.0]
    sets = R.learning_curve_sets(train, "id", fr, seed=42).cache()
    rows = []
    for f in fr:
        sub = sets.filter(F.col("min_fraction") <= f).drop("min_fraction")
        m = K.fit(K.logistic_reg(), sub, "y", FEATS, LEVELS)
        a_tr = M.accuracy(m.predict(sub), "y", "pred_class").first()["accuracy"]
        a_te = M.accuracy(m.predict(test), "y", "pred_class").first()["accuracy"]
        rows.append((f, sub.count(), float(a_tr), float(a_te)))
    sets.unpersist()
    return spark.createDataFrame(rows, "fraction double, n_train long, train_accuracy double, test_accuracy double")


@query("k14_coefficient_comparison")
def k14_coefficient_comparison(spark, d):
    """OLS, ridge, LASSO and elastic-net coefficients side by side (joined by term)."""
    it = items(Tables(spark, d)).withColumn("price_k", F.col("l_extendedprice") / 1000)
    feats = ["l_quantity", "l_discount", "l_tax"]
    fits = {"ols": K.fit(K.linear_reg(), it, "price_k", feats), "ridge": K.fit(K.linear_reg(1.0, 0.0), it, "price_k", feats),
            "lasso": K.fit(K.linear_reg(1.0, 1.0), it, "price_k", feats), "enet": K.fit(K.linear_reg(1.0, 0.5), it, "price_k", feats)}
    return K.compare_coefficients(fits)
