"""Resampling queries (R01-R08) on the survey stand-in and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from faro.operators import resample as R
from faro.plans.inputs import SURVEY_SQL, survey
from faro.plans.registry import query
from faro.sources.tables import Tables

RANKED_SQL = f"""WITH s AS ({SURVEY_SQL}),
r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(concat_ws(':', '42', CAST(id AS VARCHAR))), id) AS rk,
             count(*) OVER (PARTITION BY y) AS n FROM s)
"""


@query("r01_initial_split", RANKED_SQL + """SELECT id, y, CASE WHEN rk <= floor(n * 0.75) THEN 'train' ELSE 'test' END AS split FROM r""")
def r01_initial_split(spark, d):
    return R.initial_split(survey(Tables(spark, d)), "id", 0.75, strata="y", seed=42).select("id", "y", "split")


@query("r02_training_rows", RANKED_SQL + """SELECT y, count(*) AS n FROM r WHERE rk <= floor(n * 0.75) GROUP BY y""")
def r02_training_rows(spark, d):
    sp = R.initial_split(survey(Tables(spark, d)), "id", 0.75, strata="y", seed=42)
    return R.training(sp).groupBy("y").agg(F.count(F.lit(1)).alias("n"))


@query("r03_split_report", RANKED_SQL + """, sp AS (SELECT y, CASE WHEN rk <= floor(n * 0.75) THEN 'train' ELSE 'test' END AS split FROM r),
c AS (SELECT split, y, count(*) AS n FROM sp GROUP BY ALL), t AS (SELECT split, count(*) AS n_split FROM sp GROUP BY ALL)
SELECT split, y, n, n_split, n / CAST(n_split AS DOUBLE) AS prop FROM c JOIN t USING (split)""", dbl=["prop"])
def r03_split_report(spark, d):
    sp = R.initial_split(survey(Tables(spark, d)), "id", 0.75, strata="y", seed=42)
    return R.split_report(sp, "split", "y")


@query("r04_vfold", RANKED_SQL + """SELECT id, y, CAST((rk - 1) % 5 + 1 AS INTEGER) AS fold FROM r""")
def r04_vfold(spark, d):
    return R.vfold(survey(Tables(spark, d)), "id", v=5, strata="y", seed=42).select("id", "y", "fold")


@query("r04_vfold_unstratified", f"""WITH s AS ({SURVEY_SQL}),
r AS (SELECT id, row_number() OVER (ORDER BY md5(concat_ws(':', '7', CAST(id AS VARCHAR))), id) AS rk FROM s)
SELECT CAST((rk - 1) % 10 + 1 AS INTEGER) AS fold, count(*) AS n FROM r GROUP BY ALL""")
def r04_vfold_unstratified(spark, d):
    f = R.vfold(survey(Tables(spark, d)), "id", v=10, seed=7)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query("r06_time_folds", """WITH o AS (SELECT CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INTEGER) AS p FROM orders),
rg AS (SELECT min(p) AS p0, max(p) AS p1 FROM o),
f AS (SELECT p0, CAST(fold AS INTEGER) AS fold, p0 + 24 + (fold - 1) * 12 AS a_end
      FROM rg, range(1, CAST(floor((p1 - p0 - 24 - 6 + 1) / 12) AS BIGINT) + 2) t(fold)),
plan AS (SELECT fold, unnest(range(p0, a_end)) AS period, 'analysis' AS role FROM f
         UNION ALL SELECT fold, unnest(range(a_end, a_end + 6)) AS period, 'assessment' AS role FROM f)
SELECT fold, role, count(*) AS n, CAST(min(period) AS INTEGER) AS first_period, CAST(max(period) AS INTEGER) AS last_period
FROM o JOIN plan ON o.p = plan.period GROUP BY fold, role""")
def r06_time_folds(spark, d):
    o = Tables(spark, d).orders
    plan = R.time_folds(o, "o_orderdate", initial=24, assess=6, step=12, unit="month")
    od = o.select(R.period_index("o_orderdate", "month").alias("period"))
    return (od.join(plan, "period").groupBy("fold", "role")
            .agg(F.count(F.lit(1)).alias("n"), F.min("period").cast("int").alias("first_period"),
                 F.max("period").cast("int").alias("last_period")))


BOOT_U = "CAST('0x' || substr(md5(concat_ws(':', '42', CAST(id AS VARCHAR), CAST(r AS VARCHAR))), 1, 8) AS BIGINT) / 4294967296.0"


@query("r07_bootstrap", f"""WITH s AS ({SURVEY_SQL}), u AS (SELECT r, {BOOT_U} AS u FROM s, range(1, 4) t(r)),
w AS (SELECT r, CASE WHEN u < 0.36787944117144233 THEN 0 WHEN u < 0.7357588823428847 THEN 1 WHEN u < 0.9196986029286058 THEN 2
  WHEN u < 0.9810118431238462 THEN 3 WHEN u < 0.9963401531726563 THEN 4 WHEN u < 0.9994058151824183 THEN 5
  WHEN u < 0.9999167588507119 THEN 6 WHEN u < 0.9999897508033253 THEN 7 ELSE 8 END AS w FROM u)
SELECT CAST(r AS INTEGER) AS rep, CAST(sum(w) AS BIGINT) AS total_weight, count_if(w = 0) AS n_out_of_bag,
       avg(CAST(w AS DOUBLE)) AS mean_weight FROM w GROUP BY r""", dbl=["mean_weight"], big=["n_out_of_bag"])
def r07_bootstrap(spark, d):
    b = R.bootstrap_weights(survey(Tables(spark, d)), "id", 3, seed=42)
    parts = [b.select(F.lit(r).alias("rep"), F.col(f"w_{r}").alias("w")) for r in (1, 2, 3)]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy("rep").agg(F.sum("w").cast("bigint").alias("total_weight"),
                                F.count_if(F.col("w") == 0).alias("n_out_of_bag"),
                                F.avg(F.col("w").cast("double")).alias("mean_weight"))


@query("r08_learning_curve_sets", f"""WITH s AS ({SURVEY_SQL}),
r AS (SELECT row_number() OVER (ORDER BY md5(concat_ws(':', '42', CAST(id AS VARCHAR))), id) AS rk, count(*) OVER () AS n FROM s),
f AS (SELECT CAST(fraction AS DOUBLE) AS fraction FROM (VALUES (0.1), (0.25), (0.5), (1.0)) v(fraction))
SELECT fraction, count_if(rk <= floor(n * fraction)) AS n_train FROM r, f GROUP BY fraction""", dbl=["fraction"], big=["n_train"])
def r08_learning_curve_sets(spark, d):
    fr = [0.1, 0.25, 0.5, 1.0]
    s = R.learning_curve_sets(survey(Tables(spark, d)), "id", fr, seed=42)
    grid = spark.createDataFrame([(f,) for f in fr], "fraction double")
    return (s.crossJoin(F.broadcast(grid)).groupBy("fraction")
            .agg(F.count_if(F.col("min_fraction") <= F.col("fraction")).alias("n_train")))
