"""Metric queries (M01-M12) on the scored documents stand-in."""

from __future__ import annotations

from pyspark.sql import functions as F

from faro.operators import metrics as M
from faro.plans.inputs import ITEMS_SQL, SCORED_SQL, items, scored
from faro.plans.registry import query
from faro.sources.tables import Tables

S = f"WITH s AS ({SCORED_SQL})\n"

# SQL for the binary summary from four counters (shared by several oracles)
COUNTS_SQL = """count_if(truth = {ev} AND {est} = {ev}) AS tp, count_if(truth <> {ev} AND {est} = {ev}) AS fp,
count_if(truth = {ev} AND {est} <> {ev}) AS fn, count_if(truth <> {ev} AND {est} <> {ev}) AS tn"""


def summary_sql(counts_from: str, by: str = "") -> str:
    """Binary summary metrics from a relation with tp, fp, fn, tn columns."""
    b = f"{by}, " if by else ""
    return f"""
SELECT {b}
  (tp + tn) / NULLIF(CAST(tp + fp + fn + tn AS DOUBLE), 0) AS accuracy,
  ((tp + tn) / NULLIF(CAST(tp + fp + fn + tn AS DOUBLE), 0) - pe) / NULLIF(1 - pe, 0) AS kap,
  tp / NULLIF(CAST(tp + fn AS DOUBLE), 0) AS sens,
  tn / NULLIF(CAST(tn + fp AS DOUBLE), 0) AS spec,
  tp / NULLIF(CAST(tp + fp AS DOUBLE), 0) AS ppv,
  tn / NULLIF(CAST(tn + fn AS DOUBLE), 0) AS npv,
  (CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn)
     / NULLIF(sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)), 0) AS mcc,
  tp / NULLIF(CAST(tp + fn AS DOUBLE), 0) + tn / NULLIF(CAST(tn + fp AS DOUBLE), 0) - 1 AS j_index,
  (tp / NULLIF(CAST(tp + fn AS DOUBLE), 0) + tn / NULLIF(CAST(tn + fp AS DOUBLE), 0)) / 2 AS bal_accuracy,
  (tp + fp) / NULLIF(CAST(tp + fp + fn + tn AS DOUBLE), 0) AS detection_prevalence,
  tp / NULLIF(CAST(tp + fp AS DOUBLE), 0) AS precision,
  tp / NULLIF(CAST(tp + fn AS DOUBLE), 0) AS recall,
  2 * (tp / NULLIF(CAST(tp + fp AS DOUBLE), 0)) * (tp / NULLIF(CAST(tp + fn AS DOUBLE), 0))
    / NULLIF(tp / NULLIF(CAST(tp + fp AS DOUBLE), 0) + tp / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0) AS f_meas
FROM (SELECT *, (CAST(tp + fp AS DOUBLE) * (tp + fn) + CAST(fn + tn AS DOUBLE) * (fp + tn))
                 / NULLIF(CAST(tp + fp + fn + tn AS DOUBLE) * (tp + fp + fn + tn), 0) AS pe
      FROM {counts_from}) AS c"""


ALL_M = ", ".join(M.SUMMARY_METRICS)


@query("m01_conf_mat", S + """, g AS (SELECT a.truth, b.prediction FROM (VALUES (0), (1)) a(truth), (VALUES (0), (1)) b(prediction)),
c AS (SELECT truth, pred AS prediction, count(*) AS n FROM s GROUP BY ALL)
SELECT g.truth, g.prediction, COALESCE(c.n, 0) AS n FROM g LEFT JOIN c USING (truth, prediction)""")
def m01_conf_mat(spark, d):
    return M.conf_mat(scored(Tables(spark, d)), "truth", "pred", [0, 1])


@query("m01_conf_mat_by_group", S + """, lv AS (SELECT * FROM (VALUES (0), (1)) a(truth), (VALUES (0), (1)) b(prediction)),
g AS (SELECT DISTINCT grp FROM s), c AS (SELECT grp, truth, pred AS prediction, count(*) AS n FROM s GROUP BY ALL)
SELECT g.grp, lv.truth, lv.prediction, COALESCE(c.n, 0) AS n FROM g CROSS JOIN lv
LEFT JOIN c ON c.grp = g.grp AND c.truth = lv.truth AND c.prediction = lv.prediction""")
def m01_conf_mat_by_group(spark, d):
    return M.conf_mat(scored(Tables(spark, d)), "truth", "pred", [0, 1], by=["grp"])


@query("m02_accuracy", S + """SELECT grp, avg(CAST(truth = pred AS DOUBLE)) AS accuracy,
avg(CAST(truth <> pred AS DOUBLE)) AS error_rate FROM s GROUP BY grp""", dbl=["accuracy", "error_rate"])
def m02_accuracy(spark, d):
    return M.accuracy(scored(Tables(spark, d)), "truth", "pred", by=["grp"])


@query("m03_precision_recall_f", S + f"""SELECT precision, recall, f_meas FROM (
{summary_sql("(SELECT " + COUNTS_SQL.format(ev=1, est="pred") + " FROM s) AS k")})""",
       dbl=["precision", "recall", "f_meas"])
def m03_precision_recall_f(spark, d):
    return M.class_metrics(scored(Tables(spark, d)), "truth", "pred", 1).select("precision", "recall", "f_meas")


@query("m04_summary_conf_mat", S + f"""SELECT grp, metric, estimate FROM (
{summary_sql("(SELECT grp, " + COUNTS_SQL.format(ev=1, est="pred") + " FROM s GROUP BY grp) AS k", "grp")}
) UNPIVOT INCLUDE NULLS (estimate FOR metric IN ({ALL_M}))""", dbl=["estimate"])
def m04_summary_conf_mat(spark, d):
    w = M.class_metrics(scored(Tables(spark, d)), "truth", "pred", 1, by=["grp"])
    return M.to_long(w, M.SUMMARY_METRICS, by=["grp"])


@query("m05_kappa", S + """, n AS (SELECT count(*) AS n, count_if(truth = pred) AS agree FROM s),
r AS (SELECT truth AS lvl, count(*) AS r FROM s GROUP BY 1), c AS (SELECT pred AS lvl, count(*) AS c FROM s GROUP BY 1),
e AS (SELECT sum(CAST(r AS DOUBLE) * c) AS rc FROM r JOIN c USING (lvl))
SELECT (agree / CAST(n AS DOUBLE) - rc / (CAST(n AS DOUBLE) * n)) / NULLIF(1 - rc / (CAST(n AS DOUBLE) * n), 0) AS kap
FROM n, e""", dbl=["kap"])
def m05_kappa(spark, d):
    return M.kappa(scored(Tables(spark, d)), "truth", "pred")


@query("m06_mn_log_loss", S + """SELECT grp, -avg(ln(CASE WHEN truth = 1 THEN p ELSE 1 - p END)) AS mn_log_loss
FROM (SELECT *, LEAST(GREATEST(score, pow(2.0, -52)), 1 - pow(2.0, -52)) AS p FROM s) GROUP BY grp""", dbl=["mn_log_loss"])
def m06_mn_log_loss(spark, d):
    return M.mn_log_loss(scored(Tables(spark, d)), "truth", "score", 1, by=["grp"])


@query("m06_mn_log_loss_multiclass", """WITH o AS (SELECT year(o_orderdate) AS yr, o_orderstatus AS st FROM orders),
t AS (SELECT yr, count(*) AS t FROM o GROUP BY 1), c AS (SELECT yr, st, count(*) AS n FROM o GROUP BY ALL)
SELECT -sum(n * ln(LEAST(GREATEST(n / CAST(t AS DOUBLE), pow(2.0, -52)), 1 - pow(2.0, -52)))) / sum(n) AS mn_log_loss FROM c JOIN t USING (yr)""",
       dbl=["mn_log_loss"])
def m06_mn_log_loss_multiclass(spark, d):
    """Order status predicted by its shares in the order's year."""
    o = Tables(spark, d).orders.select(F.year("o_orderdate").alias("yr"), F.col("o_orderstatus").alias("st"))
    levels = ["F", "O", "P"]
    shares = o.groupBy("yr").agg(*[F.avg((F.col("st") == lv).cast("double")).alias(f"prob_{lv}") for lv in levels])
    return M.multinomial_log_loss(o.join(shares, "yr"), "st", {lv: f"prob_{lv}" for lv in levels})


ROC_SQL = S + """, sc AS (SELECT grp, score AS threshold, count_if(truth = 1) AS pos, count_if(truth <> 1) AS neg FROM s GROUP BY ALL),
cum AS (SELECT *, sum(pos) OVER (PARTITION BY grp ORDER BY threshold DESC) AS pc,
               sum(neg) OVER (PARTITION BY grp ORDER BY threshold DESC) AS nc,
               sum(pos) OVER (PARTITION BY grp) AS P, sum(neg) OVER (PARTITION BY grp) AS N FROM sc),
tot AS (SELECT grp, sum(pos) AS P, sum(neg) AS N FROM sc GROUP BY grp)
SELECT grp, threshold, 1 - nc / NULLIF(CAST(N AS DOUBLE), 0) AS specificity, pc / NULLIF(CAST(P AS DOUBLE), 0) AS sensitivity FROM cum
UNION ALL SELECT grp, '-inf'::DOUBLE, CASE WHEN N > 0 THEN 0.0 END, CASE WHEN P > 0 THEN 1.0 END FROM tot
UNION ALL SELECT grp, 'inf'::DOUBLE, CASE WHEN N > 0 THEN 1.0 END, CASE WHEN P > 0 THEN 0.0 END FROM tot"""


@query("m07_roc_curve", ROC_SQL, dbl=["threshold", "specificity", "sensitivity"])
def m07_roc_curve(spark, d):
    return M.roc_curve(scored(Tables(spark, d)), "truth", "score", 1, by=["grp"])


AUC_SQL = """, sc AS (SELECT {by}score, count_if(truth = 1) AS pos, count_if(truth <> 1) AS neg FROM s GROUP BY ALL),
cum AS (SELECT *, COALESCE(sum(neg) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM sc)
SELECT {by}sum(pos * (nb + neg * 0.5)) / NULLIF(CAST(sum(pos) AS DOUBLE) * sum(neg), 0) AS roc_auc FROM cum {grp}"""


@query("m08_roc_auc", S + AUC_SQL.format(by="", part="", grp=""), dbl=["roc_auc"])
def m08_roc_auc(spark, d):
    return M.roc_auc(scored(Tables(spark, d)), "truth", "score", 1)


@query("m08_roc_auc_by_group", S + AUC_SQL.format(by="grp, ", part="PARTITION BY grp ", grp="GROUP BY grp"),
       dbl=["roc_auc"])
def m08_roc_auc_by_group(spark, d):
    return M.roc_auc(scored(Tables(spark, d)), "truth", "score", 1, by=["grp"])


@query("m09_metric_set", S + f"""SELECT model, metric, estimate FROM (
  SELECT 'cut50' AS model, accuracy, precision, recall, f_meas FROM ({summary_sql("(SELECT " + COUNTS_SQL.format(ev=1, est="CAST(score >= 0.5 AS INTEGER)") + " FROM s) AS k")})
  UNION ALL
  SELECT 'cut30' AS model, accuracy, precision, recall, f_meas FROM ({summary_sql("(SELECT " + COUNTS_SQL.format(ev=1, est="CAST(score >= 0.3 AS INTEGER)") + " FROM s) AS k")})
) UNPIVOT INCLUDE NULLS (estimate FOR metric IN (accuracy, precision, recall, f_meas))""", dbl=["estimate"])
def m09_metric_set(spark, d):
    s = scored(Tables(spark, d))
    mets = ["accuracy", "precision", "recall", "f_meas"]
    parts = {}
    for name, cut in (("cut50", 0.5), ("cut30", 0.3)):
        p = s.withColumn("est", (F.col("score") >= cut).cast("int"))
        parts[name] = M.to_long(M.class_metrics(p, "truth", "est", 1).select(*mets), mets)
    return M.metric_set(parts)


REG_SQL = f"""WITH it AS ({ITEMS_SQL}),
fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM it),
p AS (SELECT l_returnflag, l_extendedprice / 1000.0 AS y, (a + b * l_quantity) / 1000.0 AS yhat FROM it, fit)
SELECT l_returnflag, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg(abs(y - yhat)) AS mae,
       avg((y - yhat) * (y - yhat)) AS mse, pow(corr(y, yhat), 2) AS rsq,
       1 - sum((y - yhat) * (y - yhat)) / NULLIF(var_pop(y) * count(y), 0) AS rsq_trad
FROM p GROUP BY l_returnflag"""


@query("m10_regression_metrics", REG_SQL, dbl=["rmse", "mae", "mse", "rsq", "rsq_trad"])
def m10_regression_metrics(spark, d):
    it = items(Tables(spark, d))
    fit = it.agg(F.regr_slope("l_extendedprice", "l_quantity").alias("b"),
                 F.regr_intercept("l_extendedprice", "l_quantity").alias("a"))
    # price in thousands keeps squared errors at a magnitude where 6 decimals are exact across engines
    p = it.crossJoin(fit).select("l_returnflag", (F.col("l_extendedprice") / 1000.0).alias("y"),
                                 ((F.col("a") + F.col("b") * F.col("l_quantity")) / 1000.0).alias("yhat"))
    return M.regression_metrics(p, "y", "yhat", by=["l_returnflag"])


THR = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
_thr_values = ", ".join(f"({t})" for t in THR)


@query("m11_threshold_sweep", S + f""", t AS (SELECT CAST(threshold AS DOUBLE) AS threshold FROM (VALUES {_thr_values}) v(threshold)),
k AS (SELECT threshold, count_if(truth = 1 AND score >= threshold) AS tp, count_if(truth <> 1 AND score >= threshold) AS fp,
             count_if(truth = 1 AND score < threshold) AS fn, count_if(truth <> 1 AND score < threshold) AS tn
      FROM s, t GROUP BY threshold)
SELECT threshold, tp, fp, fn, tn, tp / NULLIF(CAST(tp + fp AS DOUBLE), 0) AS precision,
       tp / NULLIF(CAST(tp + fn AS DOUBLE), 0) AS recall,
       2 * (tp / NULLIF(CAST(tp + fp AS DOUBLE), 0)) * (tp / NULLIF(CAST(tp + fn AS DOUBLE), 0))
         / NULLIF(tp / NULLIF(CAST(tp + fp AS DOUBLE), 0) + tp / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0) AS f_meas,
       (tp + tn) / NULLIF(CAST(tp + fp + fn + tn AS DOUBLE), 0) AS accuracy,
       fp / NULLIF(CAST(fp + tn AS DOUBLE), 0) AS fpr FROM k""",
       dbl=["threshold", "precision", "recall", "f_meas", "accuracy", "fpr"], big=["tp", "fp", "fn", "tn"])
def m11_threshold_sweep(spark, d):
    return M.threshold_sweep(scored(Tables(spark, d)), "truth", "score", 1, THR)


@query("m11_threshold_sweep_strict", S + f""", t AS (SELECT CAST(threshold AS DOUBLE) AS threshold FROM (VALUES {_thr_values}) v(threshold)),
k AS (SELECT threshold, count_if(truth = 1 AND score > threshold) AS tp, count_if(truth <> 1 AND score > threshold) AS fp,
             count_if(truth = 1 AND score <= threshold) AS fn, count_if(truth <> 1 AND score <= threshold) AS tn
      FROM s, t GROUP BY threshold)
SELECT threshold, tp, fp, fn, tn, tp / NULLIF(CAST(tp + fp AS DOUBLE), 0) AS precision,
       tp / NULLIF(CAST(tp + fn AS DOUBLE), 0) AS recall,
       2 * (tp / NULLIF(CAST(tp + fp AS DOUBLE), 0)) * (tp / NULLIF(CAST(tp + fn AS DOUBLE), 0))
         / NULLIF(tp / NULLIF(CAST(tp + fp AS DOUBLE), 0) + tp / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0) AS f_meas,
       (tp + tn) / NULLIF(CAST(tp + fp + fn + tn AS DOUBLE), 0) AS accuracy,
       fp / NULLIF(CAST(fp + tn AS DOUBLE), 0) AS fpr FROM k""",
       dbl=["threshold", "precision", "recall", "f_meas", "accuracy", "fpr"], big=["tp", "fp", "fn", "tn"])
def m11_threshold_sweep_strict(spark, d):
    return M.threshold_sweep(scored(Tables(spark, d)), "truth", "score", 1, THR, inclusive=False)


@query("m12_uncertain", S + """SELECT doc_id, score, abs(score - 0.5) AS distance FROM s WHERE abs(score - 0.5) < 0.05""",
       dbl=["score", "distance"])
def m12_uncertain(spark, d):
    return M.uncertain(scored(Tables(spark, d)), "score", 0.05).select("doc_id", "score", "distance")
