"""Recipe queries (F01-F16): parameters estimated on the training split only,
applied to the test split.  Oracles recompute the train statistics in a CTE."""

from __future__ import annotations

from pyspark.sql import functions as F

from faro.operators import resample as R
from faro.operators.recipe import Recipe
from faro.plans.inputs import SURVEY_SQL, survey
from faro.plans.registry import query
from faro.sources.tables import Tables

SPLIT_SQL = f"""WITH s0 AS ({SURVEY_SQL}),
r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(concat_ws(':', '42', CAST(id AS VARCHAR))), id) AS rk,
             count(*) OVER (PARTITION BY y) AS n FROM s0),
s AS (SELECT * EXCLUDE (rk, n), CASE WHEN rk <= floor(n * 0.75) THEN 'train' ELSE 'test' END AS split FROM r),
train AS (SELECT * FROM s WHERE split = 'train'), test AS (SELECT * FROM s WHERE split = 'test')
"""


def _split(spark, d):
    sp = R.initial_split(survey(Tables(spark, d)), "id", 0.75, strata="y", seed=42)
    return R.training(sp).drop("split"), R.testing(sp).drop("split")


@query("f02_prep_bake_normalize", SPLIT_SQL + """, st AS (SELECT avg(price) AS mp, stddev_samp(price) AS sp, avg(balance) AS mb, stddev_samp(balance) AS sb FROM train)
SELECT id, y, (price - mp) / sp AS price, (balance - mb) / sb AS balance FROM test, st""", dbl=["price", "balance"])
def f02_prep_bake_normalize(spark, d):
    train, test = _split(spark, d)
    rec = Recipe("y", ids=["id"], predictors=["price", "balance"]).step_normalize()
    return rec.prep(train).bake(test)


@query("f02_juice", SPLIT_SQL + """, st AS (SELECT avg(price) AS mp, stddev_samp(price) AS sp FROM train)
SELECT id, y, (price - mp) / sp AS price FROM train, st""", dbl=["price"])
def f02_juice(spark, d):
    train, _ = _split(spark, d)
    return Recipe("y", ids=["id"], predictors=["price"]).step_normalize().prep(train).juice()


@query("f04_step_normalize", SPLIT_SQL + """, st AS (SELECT avg(price) AS m, stddev_samp(price) AS s FROM train)
SELECT id, y, (price - m) / s AS price, balance, CAST(0 AS DOUBLE) AS same FROM test, st""", dbl=["price", "balance", "same"])
def f04_step_normalize(spark, d):
    """One column normalised by the training rows, one left alone, and one without variance, which is only centred."""
    train, test = (x.withColumn("same", F.lit(7.0)) for x in _split(spark, d))
    return Recipe("y", ids=["id"], predictors=["price", "balance", "same"]).step_normalize(["price", "same"]).prep(train).bake(test)


_SEG = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("f03_step_dummy", SPLIT_SQL + "SELECT id, y, " + ", ".join(
    f"CAST(segment = '{v}' AS DOUBLE) AS segment_{v}" for v in _SEG[1:]) + " FROM test", dbl=[f"segment_{v}" for v in _SEG[1:]])
def f03_step_dummy(spark, d):
    train, test = _split(spark, d)
    return Recipe("y", ids=["id"], predictors=["segment"]).step_dummy().prep(train).bake(test)


@query("f03_step_dummy_one_hot", SPLIT_SQL + "SELECT id, y, " + ", ".join(
    f"CAST(segment = '{v}' AS DOUBLE) AS segment_{v}" for v in _SEG) + " FROM test", dbl=[f"segment_{v}" for v in _SEG])
def f03_step_dummy_one_hot(spark, d):
    train, test = _split(spark, d)
    return Recipe("y", ids=["id"], predictors=["segment"]).step_dummy(one_hot=True).prep(train).bake(test)


@query("f05_step_zv", SPLIT_SQL + """, st AS (SELECT avg(price) AS mp, stddev_samp(price) AS sp FROM train)
SELECT id, y, (price - mp) / sp AS price FROM test, st""", dbl=["price"])
def f05_step_zv(spark, d):
    train, test = _split(spark, d)
    train, test = train.withColumn("const", F.lit(1.0)), test.withColumn("const", F.lit(1.0))
    # normalise runs before zv (as in the reference labs): the constant column must not divide by zero
    rec = Recipe("y", ids=["id"], predictors=["price", "const"]).step_normalize().step_zv()
    return rec.prep(train).bake(test)


@query("f06_step_novel", SPLIT_SQL + """SELECT id, y, CASE WHEN segment IN (SELECT DISTINCT segment FROM train WHERE segment <> 'MACHINERY')
THEN segment ELSE 'new' END AS segment FROM test""")
def f06_step_novel(spark, d):
    train, test = _split(spark, d)
    rec = Recipe("y", ids=["id"], predictors=["segment"]).step_novel()
    return rec.prep(train.filter(F.col("segment") != "MACHINERY")).bake(test)


# only some documents are labelled, so the joined column is NULL for the others
CO_SPLIT_SQL = """WITH co AS (SELECT d.doc_id AS id, CASE WHEN l.doc_id IS NOT NULL THEN CAST(d.n_chars AS DOUBLE) END AS price
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
r AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', '42', CAST(id AS VARCHAR))), id) AS rk, count(*) OVER () AS n FROM co),
train AS (SELECT * FROM r WHERE rk <= floor(n * 0.75)), test AS (SELECT * FROM r WHERE rk > floor(n * 0.75))
"""


def _co_split(spark, d):
    t = Tables(spark, d)
    lab = t.labels.select(F.col("doc_id").alias("id"), F.lit(True).alias("labelled"))
    co = (t.documents.select(F.col("doc_id").alias("id"), "n_chars").join(lab, "id", "left")
          .select("id", F.when(F.col("labelled"), F.col("n_chars").cast("double")).alias("price")))
    sp = R.initial_split(co, "id", 0.75, seed=42)
    return R.training(sp).drop("split"), R.testing(sp).drop("split")


@query("f07_impute_median", CO_SPLIT_SQL + """SELECT id, COALESCE(price, (SELECT quantile_cont(price, 0.5) FROM train)) AS price FROM test""",
       dbl=["price"])
def f07_impute_median(spark, d):
    train, test = _co_split(spark, d)
    return Recipe(None, ids=["id"], predictors=["price"]).step_impute_median().prep(train).bake(test)


@query("f09_missing_indicator", CO_SPLIT_SQL + """SELECT id, price, CAST(price IS NULL AS INTEGER) AS na_ind_price FROM test""",
       dbl=["price"])
def f09_missing_indicator(spark, d):
    train, test = _co_split(spark, d)
    return Recipe(None, ids=["id"], predictors=["price"]).step_indicate_na().prep(train).bake(test)


@query("f10_step_other", SPLIT_SQL + """, keep AS (SELECT country FROM train GROUP BY 1 HAVING count(*) >= 0.041 * (SELECT count(*) FROM train))
SELECT CASE WHEN country IN (SELECT country FROM keep) THEN country ELSE 'other' END AS country, count(*) AS n FROM test GROUP BY 1""")
def f10_step_other(spark, d):
    train, test = _split(spark, d)
    baked = Recipe("y", ids=["id"], predictors=["country"]).step_other(threshold=0.041).prep(train).bake(test)
    return baked.groupBy("country").agg(F.count(F.lit(1)).alias("n"))


@query("f12_step_log", SPLIT_SQL + """SELECT id, y, ln(price + 1) AS price FROM test""", dbl=["price"])
def f12_step_log(spark, d):
    train, test = _split(spark, d)
    return Recipe("y", ids=["id"], predictors=["price"]).step_log(["price"], offset=1.0).prep(train).bake(test)


@query("f13_step_interact", SPLIT_SQL + """SELECT id, y, month, year, CAST(month AS DOUBLE) * year AS month_x_year FROM test""")
def f13_step_interact(spark, d):
    train, test = _split(spark, d)
    return Recipe("y", ids=["id"], predictors=["month", "year"]).step_interact("month", "year").prep(train).bake(test)


@query("f15_step_rm", SPLIT_SQL + """SELECT id, y, price FROM test""", dbl=["price"])
def f15_step_rm(spark, d):
    train, test = _split(spark, d)
    return Recipe("y", ids=["id"], predictors=["price", "balance"]).step_rm(["balance"]).prep(train).bake(test)


@query("f16_step_range", SPLIT_SQL + """, st AS (SELECT min(balance) AS lo, max(balance) AS hi FROM train)
SELECT id, y, (balance - lo) / (hi - lo) AS balance FROM test, st""", dbl=["balance"])
def f16_step_range(spark, d):
    train, test = _split(spark, d)
    return Recipe("y", ids=["id"], predictors=["balance"]).step_range().prep(train).bake(test)


_F01_IND = {**{f"segment_{v}": f"CAST(segment = '{v}' AS DOUBLE)" for v in _SEG[1:]},
            "status_O": "CAST(status = 'O' AS DOUBLE)", "status_P": "CAST(status = 'P' AS DOUBLE)"}
_F01_ALL = {"price": "price", "balance": "balance", "month": "month", "year": "year", **_F01_IND}


# dummies come first, so normalise (all numeric predictors) also standardises the indicators, as in R
@query("f01_formula_recipe", SPLIT_SQL + ", st AS (SELECT " + ", ".join(
    f"avg({e}) AS m_{k}, stddev_samp({e}) AS s_{k}" for k, e in _F01_ALL.items()) + " FROM train)\nSELECT id, y, " + ", ".join(
    f"({e} - m_{k}) / s_{k} AS {k}" for k, e in _F01_ALL.items()) + " FROM test, st", dbl=list(_F01_ALL))
def f01_formula_recipe(spark, d):
    train, test = _split(spark, d)
    rec = Recipe.from_formula("y ~ . - country", ids=["id"]).step_dummy().step_normalize().step_zv()
    return rec.prep(train).bake(test)


_F11_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "revenue"]


@query("f11_step_corr", "WITH li AS (SELECT *, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem), r AS ("
       + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, abs(corr({a}, {b})) AS r FROM li" for a in _F11_COLS for b in _F11_COLS if a != b)
       + """), m AS (SELECT a, avg(r) AS mean FROM r GROUP BY a),
w AS (SELECT * FROM r WHERE r > 0.9 AND a < b ORDER BY r DESC LIMIT 1),
x AS (SELECT CASE WHEN ma.mean >= mb.mean THEN w.a ELSE w.b END AS gone FROM w JOIN m ma ON ma.a = w.a JOIN m mb ON mb.a = w.b)
SELECT a AS kept FROM m WHERE a NOT IN (SELECT gone FROM x)""")
def f11_step_corr(spark, d):
    """Columns kept after the greedy correlation filter (one pair exceeds the threshold here)."""
    li = Tables(spark, d).lineitem.select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    pr = Recipe(None, predictors=li.columns).step_corr(threshold=0.9).prep(li)
    # the kept-column list is bounded by the number of predictors
    return spark.createDataFrame([(c,) for c in pr.bake(li).columns], "kept string")


@query("f14_step_poly")
def f14_step_poly(spark, d):
    """Orthogonal polynomial columns of price on the training split (property-checked)."""
    train, test = _split(spark, d)
    return Recipe("y", ids=["id"], predictors=["price"]).step_poly(["price"], degree=3).prep(train).juice()


@query("f08_impute_knn", """WITH co AS (SELECT d.doc_id AS id, d.n_chars, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
q AS (SELECT id, n_chars FROM co WHERE quality IS NULL), done AS (SELECT id, n_chars, quality FROM co WHERE quality IS NOT NULL),
d AS (SELECT q.id AS qid, done.quality, row_number() OVER (PARTITION BY q.id ORDER BY abs(done.n_chars - q.n_chars), done.id) AS r FROM q, done),
f AS (SELECT qid, avg(quality) AS fill FROM d WHERE r <= 5 GROUP BY 1)
SELECT id, COALESCE(CAST(quality AS DOUBLE), fill) AS quality FROM co LEFT JOIN f ON co.id = f.qid""", dbl=["quality"])
def f08_impute_knn(spark, d):
    from faro.operators.models import knn_impute

    t = Tables(spark, d)
    lab = t.labels.select(F.col("doc_id").alias("id"), "quality")
    co = t.documents.select(F.col("doc_id").alias("id"), "n_chars").join(lab, "id", "left")
    return knn_impute(co, "id", "quality", ["n_chars"], k=5).select("id", "quality")
