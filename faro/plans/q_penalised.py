"""Penalised paths and their cross-validation from one scan (K04, K14, V05, V07), with coordinate descent in SQL as the check."""

from __future__ import annotations

from pyspark.sql import functions as F

from faro.operators import penalised as P
from faro.operators import resample as R
from faro.plans.registry import query
from faro.sources.tables import Tables

FEATURES = ["l_quantity", "l_discount", "quantity_discount"]
PENALTIES = [0.05, 0.5, 2.0, 8.0]
MIXTURES = [0.0, 0.5, 1.0]
MODELS = {"ols": (0.0, 1.0), "ridge": (2.0, 0.0), "lasso": (2.0, 1.0), "enet": (2.0, 0.5)}


def _folds(spark, d):
    """Order items with an outcome that rises with the quantity and falls with the discount, around the price."""
    it = Tables(spark, d).lineitem.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"), "l_quantity", "l_discount", "l_extendedprice")
    it = it.withColumn("value", F.col("l_extendedprice") / 1000 + 0.8 * F.col("l_quantity") - 60 * F.col("l_discount"))
    it = it.withColumn("quantity_discount", F.col("l_quantity") * F.col("l_discount"))
    return R.vfold(it, "id", v=5, seed=42)


_SUMS = ["n", "sy", "syy", *(f"s{i}" for i in (1, 2, 3)), *(f"y{i}" for i in (1, 2, 3)), "s11", "s12", "s13", "s22", "s23", "s33"]
_UNIT = 300     # sweeps of the check: far more than the three predictors need


def _cd_sql(grid: str) -> str:
    """CTEs up to ``fit``: intercept and slopes b0..b3 in own units per (held, mixture, penalty); held 0 = all rows."""
    tot = ", ".join(f"sum({c}) AS {c}" for c in _SUMS)
    new = {1: "y1s - r12 * b2 - r13 * b3", 2: "y2s - r12 * b1 - r23 * b3", 3: "y3s - r13 * b1 - r23 * b2"}

    def soft(i: int) -> str:
        return f"sign({new[i]}) * greatest(abs({new[i]}) - penalty * mixture, 0) / (1 + penalty * (1 - mixture))"

    cov = ", ".join(f"(s{i}{j} / n - s{i} * s{j} / n / n) / (d{i} * d{j}) AS r{i}{j}" for i, j in ((1, 2), (1, 3), (2, 3)))
    return f"""WITH RECURSIVE it AS (SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id FROM lineitem),
f AS (SELECT (row_number() OVER (ORDER BY md5(concat_ws(':', '42', id)), id) - 1) % 5 + 1 AS fold,
      l_extendedprice / 1000 + 0.8 * l_quantity - 60 * l_discount AS y, l_quantity AS x1, l_discount AS x2, l_quantity * l_discount AS x3 FROM it),
g AS (SELECT fold, CAST(count(*) AS DOUBLE) AS n, sum(y) AS sy, sum(y * y) AS syy, sum(x1) AS s1, sum(x2) AS s2, sum(x3) AS s3, sum(x1 * y) AS y1,
      sum(x2 * y) AS y2, sum(x3 * y) AS y3, sum(x1 * x1) AS s11, sum(x1 * x2) AS s12, sum(x1 * x3) AS s13, sum(x2 * x2) AS s22,
      sum(x2 * x3) AS s23, sum(x3 * x3) AS s33 FROM f GROUP BY fold),
t AS (SELECT h.fold AS held, {", ".join(f"sum(g.{c}) AS {c}" for c in _SUMS)} FROM g JOIN g AS h ON g.fold <> h.fold GROUP BY h.fold
      UNION ALL SELECT 0, {tot} FROM g),
sd AS (SELECT *, sqrt(s11 / n - s1 * s1 / n / n) AS d1, sqrt(s22 / n - s2 * s2 / n / n) AS d2, sqrt(s33 / n - s3 * s3 / n / n) AS d3 FROM t),
m AS (SELECT *, {cov}, {", ".join(f"(y{i} / n - s{i} * sy / n / n) / d{i} AS y{i}s" for i in (1, 2, 3))} FROM sd),
grid AS ({grid}),
cd AS (SELECT held, mixture, penalty, 0 AS k, CAST(0 AS DOUBLE) AS b1, CAST(0 AS DOUBLE) AS b2, CAST(0 AS DOUBLE) AS b3 FROM m, grid
       UNION ALL
       SELECT held, mixture, penalty, k, b1, b2, {soft(3)} AS b3 FROM (
         SELECT * REPLACE ({soft(2)} AS b2) FROM (
           SELECT cd.held, cd.mixture, cd.penalty, cd.k + 1 AS k, cd.b2, cd.b3, r12, r13, r23, y1s, y2s, y3s,
                  {soft(1).replace("b2", "cd.b2").replace("b3", "cd.b3").replace("penalty", "cd.penalty").replace("mixture", "cd.mixture")} AS b1
           FROM cd JOIN m ON cd.held = m.held WHERE cd.k < {_UNIT}))),
fit AS (SELECT cd.held, mixture, penalty, (sy - b1 / d1 * s1 - b2 / d2 * s2 - b3 / d3 * s3) / n AS c0, b1 / d1 AS c1, b2 / d2 AS c2, b3 / d3 AS c3,
        CAST((b1 = 0) AS INT) + CAST((b2 = 0) AS INT) + CAST((b3 = 0) AS INT) AS n_zero
        FROM cd JOIN m ON cd.held = m.held WHERE k = {_UNIT})"""


_GRID = ("SELECT * FROM (VALUES " + ", ".join(f"({float(a)})" for a in MIXTURES) + ") a(mixture), (VALUES " + ", ".join(f"({float(p)})" for p in PENALTIES) + ") p(penalty)")
_GRID = f"SELECT CAST(mixture AS DOUBLE) AS mixture, CAST(penalty AS DOUBLE) AS penalty FROM ({_GRID})"
_TERMS = "(VALUES ('(Intercept)', 0), ('l_quantity', 1), ('l_discount', 2), ('quantity_discount', 3)) terms(term, i)"
_PICK = "CASE i WHEN 0 THEN c0 WHEN 1 THEN c1 WHEN 2 THEN c2 ELSE c3 END"
_CV = _cd_sql(_GRID) + """,
e AS (SELECT mixture, penalty, held, g.n, g.syy - 2 * (c0 * g.sy + c1 * g.y1 + c2 * g.y2 + c3 * g.y3) + c0 * c0 * g.n + c1 * c1 * g.s11 + c2 * c2 * g.s22 + c3 * c3 * g.s33
      + 2 * (c0 * c1 * g.s1 + c0 * c2 * g.s2 + c0 * c3 * g.s3 + c1 * c2 * g.s12 + c1 * c3 * g.s13 + c2 * c3 * g.s23) AS sse, g.syy - g.sy * g.sy / g.n AS syy
      FROM fit JOIN g ON fit.held = g.fold),
fs AS (SELECT mixture, penalty, held, 'rmse' AS metric, sqrt(sse / n) AS estimate FROM e UNION ALL SELECT mixture, penalty, held, 'rsq_trad', 1 - sse / syy FROM e),
sm AS (SELECT mixture, penalty, metric, avg(estimate) AS mean, count(*) AS n, stddev_samp(estimate) / sqrt(count(*)) AS std_err FROM fs GROUP BY ALL)"""


@query("k04_enet_path", _cd_sql(_GRID) + f" SELECT mixture, penalty, term, {_PICK} AS estimate, n_zero FROM fit, {_TERMS} WHERE held = 0",
       dbl=["mixture", "penalty", "estimate"])
def k04_enet_path(spark, d):
    """Ridge, elastic-net and LASSO coefficients along a path, from one scan."""
    return P.coefficient_path(_folds(spark, d), "value", FEATURES, PENALTIES, MIXTURES)


@query("v05_penalised_cv", _CV + " SELECT * FROM sm", dbl=["mixture", "penalty", "mean", "std_err"])
def v05_penalised_cv(spark, d):
    """Cross-validated errors of every point of three paths, from one scan."""
    cv = P.penalised_cv(_folds(spark, d), "fold", "value", FEATURES, PENALTIES, MIXTURES)
    return cv.summary.filter(F.col("metric").isin("rmse", "rsq_trad"))


@query("v07_penalised_choice", _CV + f""", b AS (SELECT mixture, penalty, mean, std_err FROM sm WHERE metric = 'rmse' ORDER BY mean, mixture, penalty LIMIT 1),
o AS (SELECT sm.mixture, sm.penalty FROM sm, b WHERE metric = 'rmse' AND sm.mean <= b.mean + b.std_err ORDER BY sm.penalty DESC, sm.mixture DESC LIMIT 1),
c AS (SELECT 'best' AS choice, mixture, penalty FROM b UNION ALL SELECT 'one_std_err', mixture, penalty FROM o)
SELECT choice, fit.mixture, fit.penalty, term, {_PICK} AS estimate FROM c JOIN fit ON c.mixture = fit.mixture AND c.penalty = fit.penalty, {_TERMS} WHERE held = 0""",
       dbl=["mixture", "penalty", "estimate"])
def v07_penalised_choice(spark, d):
    """Best and simplest-within-one-SE points of the paths, and their final coefficients."""
    cv = P.penalised_cv(_folds(spark, d), "fold", "value", FEATURES, PENALTIES, MIXTURES)
    parts = [cv.final(pick).withColumn("choice", F.lit(name)) for name, pick in (("best", cv.best()), ("one_std_err", cv.one_std_err()))]
    return parts[0].unionByName(parts[1])


_MODEL_GRID = "SELECT CAST(mixture AS DOUBLE) AS mixture, CAST(penalty AS DOUBLE) AS penalty FROM (VALUES " + ", ".join(f"({a}, {p})" for p, a in MODELS.values()) + ") v(mixture, penalty)"


@query("k14_penalised_comparison", _cd_sql(_MODEL_GRID) + ", w AS (SELECT term, mixture, penalty, " + _PICK + f" AS v FROM fit, {_TERMS} WHERE held = 0) SELECT term, "
       + ", ".join(f"max(v) FILTER (mixture = {a} AND penalty = {p}) AS {name}" for name, (p, a) in MODELS.items()) + " FROM w GROUP BY term", dbl=list(MODELS))
def k14_penalised_comparison(spark, d):
    """OLS, ridge, LASSO and elastic net side by side, from one scan."""
    return P.compare_penalised(_folds(spark, d), "value", FEATURES, MODELS)
