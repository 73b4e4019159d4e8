"""Profiling queries (Q01-Q13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from faro.operators import profile as Q
from faro.plans.inputs import SURVEY_SQL, survey
from faro.plans.registry import query
from faro.sources.tables import Tables

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("q01_glimpse", """SELECT CAST(ordinal_position AS INTEGER) AS position, column_name, data_type AS column_type,
(SELECT count(*) FROM events) AS n_rows FROM information_schema.columns WHERE table_name = 'events'""")
def q01_glimpse(spark, d):
    return Q.glimpse(Tables(spark, d).events)


@query("q01_shape", """SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem""")
def q01_shape(spark, d):
    return Q.shape(Tables(spark, d).lineitem)


_stats = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, min({c}) AS min, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, "
    f"avg({c}) AS mean, quantile_cont({c}, 0.75) AS q3, max({c}) AS max FROM lineitem" for c in NUM)


@query("q02_summary_stats", _stats, dbl=["min", "q1", "median", "mean", "q3", "max"])
def q02_summary_stats(spark, d):
    return Q.summary_stats(Tables(spark, d).lineitem, NUM)


# only some documents are labelled, so quality and toxic are NULL for the others
LABELLED_SQL = """SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def labelled(t):
    return t.documents.select("doc_id", "lang", "n_chars").join(t.labels.select("doc_id", "quality", "toxic"), "doc_id", "left")


_nc_cols = ["doc_id", "lang", "n_chars", "quality", "toxic"]
_nc = " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null FROM dl" for c in _nc_cols)


@query("q03_null_counts", f"""WITH dl AS ({LABELLED_SQL}), l AS ({_nc})
SELECT * FROM l UNION ALL SELECT '__total__', CAST(sum(n_null) AS BIGINT) FROM l""")
def q03_null_counts(spark, d):
    return Q.null_counts(labelled(Tables(spark, d)))


@query("q04_freq", """SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL""")
def q04_freq(spark, d):
    return Q.freq(Tables(spark, d).lineitem, ["l_returnflag", "l_linestatus"])


@query("q05_freq_prop", f"""WITH s AS ({SURVEY_SQL}), c AS (SELECT segment, y, count(*) AS n FROM s GROUP BY ALL)
SELECT segment, y, n, n / CAST(sum(n) OVER () AS DOUBLE) AS prop FROM c""", dbl=["prop"])
def q05_freq_prop(spark, d):
    return Q.freq_prop(survey(Tables(spark, d)), ["segment", "y"])


@query("q05_freq_prop_within", f"""WITH s AS ({SURVEY_SQL}), c AS (SELECT segment, y, count(*) AS n FROM s GROUP BY ALL)
SELECT segment, y, n, n / CAST(sum(n) OVER (PARTITION BY segment) AS DOUBLE) AS prop FROM c""", dbl=["prop"])
def q05_freq_prop_within(spark, d):
    return Q.freq_prop(survey(Tables(spark, d)), ["segment", "y"], within=["segment"])


@query("q06_contingency", f"""WITH s AS ({SURVEY_SQL}), a AS (SELECT DISTINCT segment FROM s), b AS (SELECT DISTINCT status FROM s),
c AS (SELECT segment, status, count(*) AS n FROM s GROUP BY ALL)
SELECT a.segment, b.status, COALESCE(c.n, 0) AS n FROM a CROSS JOIN b LEFT JOIN c ON a.segment = c.segment AND b.status = c.status""")
def q06_contingency(spark, d):
    return Q.contingency(survey(Tables(spark, d)), "segment", "status")


@query("q06_contingency_wide", f"""WITH s AS ({SURVEY_SQL})
SELECT segment, count_if(status = 'F') AS F, count_if(status = 'O') AS O, count_if(status = 'P') AS P FROM s GROUP BY segment""",
       big=["F", "O", "P"])
def q06_contingency_wide(spark, d):
    return Q.contingency_wide(survey(Tables(spark, d)), "segment", "status", ["F", "O", "P"])


_corr = " UNION ALL ".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, covar_samp({a}, {b}) / NULLIF(stddev_samp({a}) * stddev_samp({b}), 0) AS r FROM lineitem"
    for a in NUM for b in NUM)


@query("q07_correlation_matrix", _corr, dbl=["r"])
def q07_correlation_matrix(spark, d):
    return Q.correlation_matrix(Tables(spark, d).lineitem, NUM)


@query("q08_top_correlated_pair", f"""SELECT * FROM ({_corr}) WHERE var1 < var2 ORDER BY abs(r) DESC, var1, var2 LIMIT 1""", dbl=["r"])
def q08_top_correlated_pair(spark, d):
    return Q.top_correlated_pairs(Tables(spark, d).lineitem, NUM, 1)


_cw = " UNION ALL ".join(
    f"SELECT '{a}' AS variable, covar_samp({a}, l_extendedprice) / NULLIF(stddev_samp({a}) * stddev_samp(l_extendedprice), 0) AS r FROM lineitem"
    for a in NUM if a != "l_extendedprice")


@query("q08_correlations_with", f"""SELECT variable, r, abs(r) AS abs_r FROM ({_cw})""", dbl=["r", "abs_r"])
def q08_correlations_with(spark, d):
    return Q.correlations_with(Tables(spark, d).lineitem, "l_extendedprice", NUM)


@query("q09_duplicates", """SELECT sha256(text) AS record_hash, count(*) AS copies, min(doc_id) AS first_key
FROM documents GROUP BY 1 HAVING count(*) > 1""")
def q09_duplicates(spark, d):
    return Q.duplicates(Tables(spark, d).documents, ["text"], "doc_id")


@query("q10_outliers_iqr", """WITH q AS (SELECT l_returnflag, quantile_cont(l_quantity * l_discount, 0.25) AS q1,
  quantile_cont(l_quantity * l_discount, 0.75) AS q3 FROM lineitem GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT f.l_returnflag, q1, q3, lower, upper,
  CAST(count_if(l.l_quantity * l.l_discount < lower OR l.l_quantity * l.l_discount > upper) AS BIGINT) AS n_outliers
FROM lineitem l JOIN f USING (l_returnflag) GROUP BY ALL""", dbl=["q1", "q3", "lower", "upper"])
def q10_outliers_iqr(spark, d):
    li = Tables(spark, d).lineitem.withColumn("x", F.col("l_quantity") * F.col("l_discount"))
    return Q.outliers_iqr(li, "x", by=["l_returnflag"])


@query("q10_outliers_z", """WITH s AS (SELECT l_returnflag, avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS sd FROM lineitem GROUP BY 1)
SELECT l_returnflag, CAST(count_if(abs((l_extendedprice - m) / sd) > 2.5) AS BIGINT) AS n_outliers, count(*) AS n
FROM lineitem JOIN s USING (l_returnflag) GROUP BY 1""")
def q10_outliers_z(spark, d):
    z = Q.flag_outliers_z(Tables(spark, d).lineitem, "l_extendedprice", by=["l_returnflag"], k=2.5)
    return z.groupBy("l_returnflag").agg(F.count_if("is_outlier").alias("n_outliers"), F.count(F.lit(1)).alias("n"))


@query("q11_missingness_by", f"""WITH dl AS ({LABELLED_SQL})
SELECT lang, count(*) AS n, CAST(count_if(quality IS NULL) AS BIGINT) AS n_missing,
avg(CAST(quality IS NULL AS DOUBLE)) AS missing_rate FROM dl GROUP BY 1""", dbl=["missing_rate"])
def q11_missingness_by(spark, d):
    return Q.missingness_by(labelled(Tables(spark, d)), "quality", ["lang"])


@query("q12_class_balance", f"""WITH s AS ({SURVEY_SQL}), c AS (SELECT y, count(*) AS n FROM s GROUP BY 1)
SELECT y, n, n / CAST(sum(n) OVER () AS DOUBLE) AS prop, min(n) OVER () / CAST(sum(n) OVER () AS DOUBLE) AS minority_share,
max(n) OVER () / CAST(sum(n) OVER () AS DOUBLE) AS baseline_accuracy FROM c""", dbl=["prop", "minority_share", "baseline_accuracy"])
def q12_class_balance(spark, d):
    return Q.class_balance(survey(Tables(spark, d)), "y")


_leak_cols = ["price", "balance", "month"]
_leak_long = " UNION ALL ".join(f"SELECT '{c}' AS variable, CAST({c} AS DOUBLE) AS value, y FROM s" for c in _leak_cols)


@query("q13_leakage_scan", f"""WITH s AS ({SURVEY_SQL}), l AS ({_leak_long}),
sc AS (SELECT variable, value, count_if(y = 'si') AS pos, count_if(y <> 'si') AS neg FROM l GROUP BY ALL),
cum AS (SELECT *, COALESCE(sum(neg) OVER (PARTITION BY variable ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM sc),
auc AS (SELECT variable, sum(pos * (nb + neg * 0.5)) / NULLIF(CAST(sum(pos) AS DOUBLE) * sum(neg), 0) AS roc_auc FROM cum GROUP BY 1),
r AS (SELECT variable, covar_samp(value, CAST(y = 'si' AS DOUBLE)) / NULLIF(stddev_samp(value) * stddev_samp(CAST(y = 'si' AS DOUBLE)), 0) AS r
      FROM l GROUP BY 1)
SELECT variable, roc_auc, r, abs(r) AS abs_r, abs(roc_auc - 0.5) AS auc_distance FROM auc JOIN r USING (variable)""",
       dbl=["roc_auc", "r", "abs_r", "auc_distance"])
def q13_leakage_scan(spark, d):
    return Q.leakage_scan(survey(Tables(spark, d)), "y", "si", _leak_cols)
