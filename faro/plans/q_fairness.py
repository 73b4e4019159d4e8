"""Fairness queries (G01-G16) on the scored documents stand-in (group = language)."""

from __future__ import annotations

from pyspark.sql import functions as F

from faro.operators import fairness as G
from faro.operators.verbs import case_when
from faro.plans.inputs import SCORED_SQL, scored
from faro.plans.registry import query
from faro.sources.tables import Tables

S = f"WITH s AS ({SCORED_SQL})"
CNT = """SELECT grp, count_if(truth = 1 AND pred = 1) AS tp, count_if(truth <> 1 AND pred = 1) AS fp,
count_if(truth = 1 AND pred <> 1) AS fn, count_if(truth <> 1 AND pred <> 1) AS tn FROM {src} GROUP BY grp"""
RATES = """(tp + tn) / NULLIF(CAST(tp + fp + fn + tn AS DOUBLE), 0) AS accuracy, tp / NULLIF(CAST(tp + fn AS DOUBLE), 0) AS tpr,
tn / NULLIF(CAST(tn + fp AS DOUBLE), 0) AS tnr, tp / NULLIF(CAST(tp + fp AS DOUBLE), 0) AS ppv, tn / NULLIF(CAST(tn + fn AS DOUBLE), 0) AS npv,
fp / NULLIF(CAST(fp + tn AS DOUBLE), 0) AS fpr, fn / NULLIF(CAST(fn + tp AS DOUBLE), 0) AS fnr,
(tp + fp) / NULLIF(CAST(tp + fp + fn + tn AS DOUBLE), 0) AS stp"""
GM = S + f""", c AS ({CNT.format(src="s")}), gm AS (SELECT grp, CAST(tp + fp + fn + tn AS BIGINT) AS n, {RATES} FROM c)
"""
R8 = ["accuracy", "tpr", "tnr", "ppv", "npv", "fpr", "fnr", "stp"]
THR = [0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]
_thr = ", ".join(f"({t})" for t in THR)


@query("g01_group_metrics", GM + "SELECT * FROM gm", dbl=R8)
def g01_group_metrics(spark, d):
    return G.group_metrics(scored(Tables(spark, d)), "truth", "pred", "grp")


FC_METRICS = ["accuracy", "ppv", "fpr", "tpr", "stp"]


@query("g02_fairness_check", GM + """, p AS (SELECT * FROM gm WHERE grp = 'en'),
l AS (""" + " UNION ALL ".join(
    f"SELECT gm.grp, '{m}' AS metric, gm.{m} AS value, gm.{m} / NULLIF(p.{m}, 0) AS ratio FROM gm, p" for m in FC_METRICS) + """)
SELECT grp, metric, value, ratio, ratio BETWEEN 0.8 AND 1.25 AS passes FROM l""", dbl=["value", "ratio"])
def g02_fairness_check(spark, d):
    return G.fairness_check(scored(Tables(spark, d)), "truth", "pred", "grp", "en")


@query("g03_four_fifths", GM + """, p AS (SELECT * FROM gm WHERE grp = 'en')
SELECT gm.grp, CAST(gm.stp / NULLIF(p.stp, 0) AS DOUBLE) AS stp_ratio, gm.stp / NULLIF(p.stp, 0) BETWEEN 0.8 AND 1.25 AS within_band FROM gm, p""",
       dbl=["stp_ratio"])
def g03_four_fifths(spark, d):
    fc = G.fairness_check(scored(Tables(spark, d)), "truth", "pred", "grp", "en", metrics=["stp"])
    return fc.select("grp", F.col("ratio").alias("stp_ratio"), G.four_fifths(F.col("ratio")).alias("within_band"))


@query("g04_parity_gaps", GM + """SELECT max(stp) - min(stp) AS demographic_parity, max(tpr) - min(tpr) AS equal_opportunity,
GREATEST(max(tpr) - min(tpr), max(fpr) - min(fpr)) AS equalized_odds, max(ppv) - min(ppv) AS predictive_parity FROM gm""",
       dbl=["demographic_parity", "equal_opportunity", "equalized_odds", "predictive_parity"])
def g04_parity_gaps(spark, d):
    return G.parity_gaps(scored(Tables(spark, d)), "truth", "pred", "grp")


@query("g05_calibration_by_group", S + """SELECT grp, CAST(LEAST(floor(score * 10), 9) AS INTEGER) AS bin, count(*) AS n, avg(score) AS mean_score,
avg(CAST(truth = 1 AS DOUBLE)) AS observed_rate FROM s GROUP BY ALL""", dbl=["mean_score", "observed_rate"])
def g05_calibration_by_group(spark, d):
    return G.calibration_by_group(scored(Tables(spark, d)), "truth", "score", "grp", 10)


@query("g06_base_rates", GM + """SELECT b.grp, b.base_rate, gm.fpr, gm.fnr, gm.ppv FROM (SELECT grp, avg(CAST(truth = 1 AS DOUBLE)) AS base_rate FROM s GROUP BY 1) b
JOIN gm USING (grp)""", dbl=["base_rate", "fpr", "fnr", "ppv"])
def g06_base_rates(spark, d):
    return G.base_rates(scored(Tables(spark, d)), "truth", "pred", "grp")


SWEEP = S + f""", t AS (SELECT CAST(threshold AS DOUBLE) AS threshold FROM (VALUES {_thr}) v(threshold)),
k AS (SELECT grp, threshold, count_if(truth = 1 AND score >= threshold) AS tp, count_if(truth <> 1 AND score >= threshold) AS fp,
             count_if(truth = 1 AND score < threshold) AS fn, count_if(truth <> 1 AND score < threshold) AS tn FROM s, t GROUP BY ALL),
sw AS (SELECT grp, threshold, (tp + tn) / NULLIF(CAST(tp + fp + fn + tn AS DOUBLE), 0) AS accuracy,
       tp / NULLIF(CAST(tp + fn AS DOUBLE), 0) AS tpr, fp / NULLIF(CAST(fp + tn AS DOUBLE), 0) AS fpr FROM k)
"""


@query("g07_group_threshold_sweep", SWEEP + "SELECT * FROM sw", dbl=["threshold", "accuracy", "tpr", "fpr"])
def g07_group_threshold_sweep(spark, d):
    return G.group_threshold_sweep(scored(Tables(spark, d)), "truth", "score", "grp", THR)


@query("g08_match_fpr", SWEEP + """, tg AS (SELECT fpr AS target_fpr FROM sw WHERE grp = 'en' AND threshold = 0.5),
b AS (SELECT grp, target_fpr, min({'d': abs(fpr - target_fpr), 't': threshold, 'f': fpr}) AS b FROM sw, tg GROUP BY ALL)
SELECT grp, b.t AS cutoff, b.f AS fpr, target_fpr FROM b""", dbl=["cutoff", "fpr", "target_fpr"])
def g08_match_fpr(spark, d):
    return G.match_fpr(scored(Tables(spark, d)), "truth", "score", "grp", "en", THR)


CUTS = {"en": 0.5, "fr": 0.45, "de": 0.45, "es": 0.4}


@query("g09_apply_group_thresholds", S + """, a AS (SELECT *, CAST(score >= CASE grp WHEN 'en' THEN 0.5 WHEN 'fr' THEN 0.45 WHEN 'de' THEN 0.45
  WHEN 'es' THEN 0.4 ELSE 0.5 END AS INTEGER) AS pred_adj FROM s),
o AS (SELECT grp, count_if(truth <> 1 AND pred = 1) / NULLIF(CAST(count_if(truth <> 1) AS DOUBLE), 0) AS fpr_original,
        avg(CAST(truth = pred AS DOUBLE)) AS accuracy_original,
        count_if(truth <> 1 AND pred_adj = 1) / NULLIF(CAST(count_if(truth <> 1) AS DOUBLE), 0) AS fpr_mitigated,
        avg(CAST(truth = pred_adj AS DOUBLE)) AS accuracy_mitigated FROM a GROUP BY grp)
SELECT * FROM o""", dbl=["fpr_original", "accuracy_original", "fpr_mitigated", "accuracy_mitigated"])
def g09_apply_group_thresholds(spark, d):
    s = G.apply_group_thresholds(scored(Tables(spark, d)), "score", "grp", CUTS)
    return G.mitigation_report(s, "truth", "pred", "pred_adj", "grp")


@query("g10_threshold_policy_equal_approval", S + """SELECT grp, quantile_cont(score, 0.7) AS cutoff FROM s GROUP BY grp""", dbl=["cutoff"])
def g10_threshold_policy_equal_approval(spark, d):
    return G.threshold_policy(scored(Tables(spark, d)), "truth", "score", "grp", "equal_approval", rate=0.3)


@query("g10_threshold_policy_equal_fnr", S + """SELECT grp, quantile_cont(score, 0.2) AS cutoff FROM s WHERE truth = 1 GROUP BY grp""", dbl=["cutoff"])
def g10_threshold_policy_equal_fnr(spark, d):
    return G.threshold_policy(scored(Tables(spark, d)), "truth", "score", "grp", "equal_fnr", rate=0.8)


@query("g10_threshold_policy_same", S + """SELECT DISTINCT grp, 0.5 AS cutoff FROM s""", dbl=["cutoff"])
def g10_threshold_policy_same(spark, d):
    return G.threshold_policy(scored(Tables(spark, d)), "truth", "score", "grp", "same", rate=0.5)


@query("g11_reweigh", S + """, w AS (SELECT grp, truth, (SELECT count(*) FROM s s2 WHERE s2.grp = s1.grp) * CAST((SELECT count(*) FROM s s3 WHERE s3.truth = s1.truth) AS DOUBLE)
  / ((SELECT count(*) FROM s) * CAST(count(*) AS DOUBLE)) AS weight FROM s s1 GROUP BY grp, truth)
SELECT grp, truth, count(*) AS n, sum(weight) AS weighted_n FROM s JOIN w USING (grp, truth) GROUP BY ALL""", dbl=["weighted_n"])
def g11_reweigh(spark, d):
    w = G.reweigh(scored(Tables(spark, d)), "truth", "grp")
    return w.groupBy("grp", "truth").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weighted_n"))


@query("g12_reject_option", S + """SELECT grp, count(*) AS n, avg(CAST(abs(score - 0.5) >= 0.1 AS DOUBLE)) AS coverage,
count_if(abs(score - 0.5) >= 0.1 AND (score >= 0.5) = (truth = 1)) / NULLIF(CAST(count_if(abs(score - 0.5) >= 0.1) AS DOUBLE), 0) AS accuracy_decided
FROM s GROUP BY grp""", dbl=["coverage", "accuracy_decided"])
def g12_reject_option(spark, d):
    return G.reject_option(scored(Tables(spark, d)), "truth", "score", "grp", margin=0.1)


@query("g13_calibrate_by_group", f"""WITH s AS ({SCORED_SQL}), c AS (SELECT grp, score, count(truth) AS n, count_if(truth = 1) AS k FROM s GROUP BY ALL),
p AS (SELECT grp, score, row_number() OVER w AS i, sum(n) OVER w AS cn, sum(k) OVER w AS ck, n, k FROM c WHERE n > 0 WINDOW w AS (PARTITION BY grp ORDER BY score)),
a AS (SELECT a.grp, a.i AS a, b.i AS b, (b.ck - a.ck + a.k) / CAST(b.cn - a.cn + a.n AS DOUBLE) AS m FROM p a JOIN p b ON a.grp = b.grp AND a.i <= b.i),
lowest AS (SELECT grp, a, b AS i, min(m) OVER (PARTITION BY grp, a ORDER BY b DESC) AS m FROM a),
fit AS (SELECT grp, i, max(m) AS score_cal FROM lowest GROUP BY ALL)
SELECT s.doc_id, s.grp, s.score, fit.score_cal FROM s JOIN p ON s.grp = p.grp AND s.score = p.score JOIN fit ON fit.grp = p.grp AND fit.i = p.i""", dbl=["score", "score_cal"])
def g13_calibrate_by_group(spark, d):
    """Isotonic recalibration per group; the check takes the largest of the smallest means of all stretches around a score."""
    c = G.calibrate_by_group(scored(Tables(spark, d)), "truth", "score", "grp")
    return c.select("doc_id", "grp", "score", "score_cal")


@query("g14_proxy_scan", S + """, d AS (SELECT d.doc_id, d.lang AS grp, d.source, CAST(d.n_chars AS DOUBLE) AS n_chars FROM documents d),
na AS (SELECT grp, count(*) AS na FROM d GROUP BY 1), nb AS (SELECT source, count(*) AS nb FROM d GROUP BY 1),
nab AS (SELECT grp, source, count(*) AS nab FROM d GROUP BY ALL), n AS (SELECT count(*) AS n FROM d),
cells AS (SELECT na.grp, nb.source, na.na, nb.nb, COALESCE(nab.nab, 0) AS o, CAST(na.na AS DOUBLE) * nb.nb / n.n AS e, n.n FROM na CROSS JOIN nb CROSS JOIN n
          LEFT JOIN nab ON nab.grp = na.grp AND nab.source = nb.source),
cv AS (SELECT 'source' AS variable, 'cramers_v' AS measure, sqrt(sum((o - e) * (o - e) / e) / (max(n) * (LEAST(count(DISTINCT grp), count(DISTINCT source)) - 1))) AS association FROM cells),
g AS (SELECT grp, count(n_chars) AS ng, avg(n_chars) AS mg FROM d GROUP BY 1), t AS (SELECT avg(n_chars) AS m, var_pop(n_chars) * count(n_chars) AS sst FROM d),
eta AS (SELECT 'n_chars' AS variable, 'eta' AS measure, sqrt(sum(ng * (mg - m) * (mg - m)) / max(sst)) AS association FROM g, t)
SELECT * FROM cv UNION ALL SELECT * FROM eta""", dbl=["association"])
def g14_proxy_scan(spark, d):
    docs = Tables(spark, d).documents.select(F.col("lang").alias("grp"), "source", F.col("n_chars").cast("double").alias("n_chars"))
    return G.proxy_scan(docs, "grp", categorical=["source"], numeric=["n_chars"])


REF = {"en": 0.4, "es": 0.3, "fr": 0.15, "de": 0.15}


@query("g15_representation", S + """, c AS (SELECT grp, count(*) AS n, avg(CAST(truth <> pred AS DOUBLE)) AS error_rate FROM s GROUP BY 1),
r AS (SELECT * FROM (VALUES ('en', 0.4), ('es', 0.3), ('fr', 0.15), ('de', 0.15)) v(grp, reference_share))
SELECT COALESCE(c.grp, r.grp) AS grp, n, error_rate, n / CAST(sum(n) OVER () AS DOUBLE) AS share, CAST(reference_share AS DOUBLE) AS reference_share,
n / CAST(sum(n) OVER () AS DOUBLE) - reference_share AS share_gap FROM c FULL JOIN r ON c.grp = r.grp""",
       dbl=["error_rate", "share", "reference_share", "share_gap"])
def g15_representation(spark, d):
    return G.representation(scored(Tables(spark, d)), "grp", REF, "truth", "pred")


def _band(spark, d):
    s = scored(Tables(spark, d))
    docs = Tables(spark, d).documents.select("doc_id", "source")
    j = s.join(docs, "doc_id")
    num = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    # fixed values: band cut points (the reference's young < 30, adult < 50, older) applied to the source number
    return j.withColumn("band", case_when([(num < 7, "joven"), (num < 14, "adulto")], "mayor"))


@query("g16_derived_group_audit", f"""WITH s0 AS ({SCORED_SQL}),
s AS (SELECT s0.*, CASE WHEN CAST(regexp_extract(d.source, '(\\d+)', 1) AS INTEGER) < 7 THEN 'joven'
  WHEN CAST(regexp_extract(d.source, '(\\d+)', 1) AS INTEGER) < 14 THEN 'adulto' ELSE 'mayor' END AS band
  FROM s0 JOIN documents d USING (doc_id)),
c AS (SELECT band, count_if(truth = 1 AND pred = 1) AS tp, count_if(truth <> 1 AND pred = 1) AS fp,
count_if(truth = 1 AND pred <> 1) AS fn, count_if(truth <> 1 AND pred <> 1) AS tn FROM s GROUP BY band),
gm AS (SELECT band, {RATES} FROM c), p AS (SELECT * FROM gm WHERE band = 'adulto'),
l AS (""" + " UNION ALL ".join(
    f"SELECT gm.band, '{m}' AS metric, gm.{m} AS value, gm.{m} / NULLIF(p.{m}, 0) AS ratio FROM gm, p" for m in FC_METRICS) + """)
SELECT band, metric, value, ratio, ratio BETWEEN 0.8 AND 1.25 AS passes FROM l""", dbl=["value", "ratio"])
def g16_derived_group_audit(spark, d):
    return G.fairness_check(_band(spark, d), "truth", "pred", "band", "adulto")
