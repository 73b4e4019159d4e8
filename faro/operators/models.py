"""Models (K01-K16): MLlib estimators behind a small spec/fit/predict layer,
plus exact sufficient-statistics fits where they exist.

* Linear/logistic/tree/forest/boosting fits are MLlib estimators: they run
  distributed and cache their input for the iterations.
* OLS inference, per-group fits and per-fold ridge use X'X / X'y sums from
  one aggregation (map-side partial sums; a group holding a third of the
  rows costs the same as any other) and a p x p solve on the driver.
* ``predict`` keeps every input column (the key travels with the row, so
  predictions never need a positional bind).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import add

import numpy as np
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faro.functions.core import col, safe_div
from faro.operators.neighbours import nearest
from faro.operators.ranking import stage
from faro.operators.trees import PrunedTree, pruned

# ------------------------------------------------------------------ specs


@dataclass(frozen=True)
class ModelSpec:
    """What to fit: kind in linear_reg, logistic_reg, decision_tree, rand_forest, boost_tree."""

    kind: str
    mode: str = "classification"
    penalty: float = 0.0
    mixture: float = 0.0
    params: dict = field(default_factory=dict)

    def set(self, **kw) -> "ModelSpec":
        p = dict(self.params)
        top = {k: kw.pop(k) for k in list(kw) if k in ("penalty", "mixture", "mode")}
        p.update(kw)
        return replace(self, params=p, **top)


def linear_reg(penalty: float = 0.0, mixture: float = 0.0) -> ModelSpec:
    return ModelSpec("linear_reg", "regression", penalty, mixture)


def logistic_reg(penalty: float = 0.0, mixture: float = 0.0) -> ModelSpec:
    return ModelSpec("logistic_reg", "classification", penalty, mixture)


def decision_tree(mode="classification", tree_depth=5, min_n=2, cost_complexity=0.0) -> ModelSpec:
    """``cost_complexity`` > 0 prunes the grown tree by weakest links (see ``trees``): risk of the root = 1, as misclassified rows or squared errors."""
    return ModelSpec("decision_tree", mode, params={"maxDepth": tree_depth, "minInstancesPerNode": min_n,
                                                     "cost_complexity": cost_complexity})


def rand_forest(mode="classification", trees=500, mtry=None, min_n=1, seed=42) -> ModelSpec:
    return ModelSpec("rand_forest", mode, params={"numTrees": trees, "mtry": mtry, "minInstancesPerNode": min_n, "seed": seed})


def boost_tree(mode="classification", trees=100, tree_depth=3, learn_rate=0.1, min_n=1, seed=42) -> ModelSpec:
    return ModelSpec("boost_tree", mode, params={"maxIter": trees, "maxDepth": tree_depth, "stepSize": learn_rate,
                                                  "minInstancesPerNode": min_n, "seed": seed})


# ------------------------------------------------------------------ fitted model


@dataclass
class Fitted:
    spec: ModelSpec
    model: object
    features: list[str]
    outcome: str
    levels: list | None  # classification: [negative, event]
    cuts: list[list[float]] | None = None  # boosting: the model knows a feature as the number of its cuts below the value

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds .pred (regression) or pred_class and pred_<level> probabilities."""
        from pyspark.ml.functions import array_to_vector, vector_to_array

        if isinstance(self.model, PrunedTree):
            return self.model.predict(df)
        d = _assemble(df, self.features)
        if self.cuts is not None:
            d = d.withColumn("_features", array_to_vector(F.array(*[b.cast("double") for b in _bins(vector_to_array("_features"), self.cuts)])))
        out = self.model.transform(d)
        keep = [c for c in df.columns]
        if self.spec.mode == "regression":
            return out.select(*keep, F.col("_pred").alias("pred"))
        prob = vector_to_array("_prob")
        lv = self.levels
        cls = F.when(F.col("_pred") == 1.0, F.lit(lv[1])).otherwise(F.lit(lv[0]))
        return out.select(*keep, cls.alias("pred_class"), prob[0].alias(f"pred_{lv[0]}"), prob[1].alias(f"pred_{lv[1]}"))


def _assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return df.withColumn("_features", array_to_vector(F.array(*[F.col(c).cast("double") for c in features])))


def _label(df: DataFrame, outcome: str, levels) -> DataFrame:
    if levels is None:
        return df.withColumn("_label", F.col(outcome).cast("double"))
    return df.withColumn("_label", (F.col(outcome) == F.lit(levels[1])).cast("double"))


def fit(spec: ModelSpec, train: DataFrame, outcome: str, features: Sequence[str], levels: Sequence | None = None) -> Fitted:
    """Fit on ``train``; classification outcomes use ``levels`` = [negative, event]."""
    from pyspark.ml import classification as MC
    from pyspark.ml import regression as MR

    features = list(features)
    lv = list(levels) if levels is not None else None
    cuts = None
    d = _label(_assemble(train, features), outcome, lv if spec.mode == "classification" else None)
    common = dict(featuresCol="_features", labelCol="_label", predictionCol="_pred")
    p = dict(spec.params)
    reg = spec.mode == "regression"
    if spec.kind == "linear_reg":
        # textbook objective 1/(2n) RSS + lam (a L1 + (1-a)/2 L2) mapped onto MLlib's parameterisation
        lam, a = spec.penalty, spec.mixture
        if lam > 0:
            sdy = d.agg(F.stddev_pop("_label")).first()[0] or 1.0
            rp = lam * a + lam * (1 - a) * sdy
            en = (lam * a) / rp if rp > 0 else 0.0
        else:
            rp, en = 0.0, 0.0
        est = MR.LinearRegression(regParam=rp, elasticNetParam=en, solver="normal" if en == 0 else "auto", **common)
    elif spec.kind == "logistic_reg":
        est = MC.LogisticRegression(regParam=spec.penalty, elasticNetParam=spec.mixture, probabilityCol="_prob",
                                    rawPredictionCol="_raw", **common)
    elif spec.kind == "decision_tree":
        cls = MR.DecisionTreeRegressor if reg else MC.DecisionTreeClassifier
        extra = {} if reg else {"probabilityCol": "_prob", "rawPredictionCol": "_raw"}
        est = cls(maxDepth=p["maxDepth"], minInstancesPerNode=p["minInstancesPerNode"], **extra, **common)
    elif spec.kind == "rand_forest":
        cls = MR.RandomForestRegressor if reg else MC.RandomForestClassifier
        extra = {} if reg else {"probabilityCol": "_prob", "rawPredictionCol": "_raw"}
        mtry = p.get("mtry")
        est = cls(numTrees=p["numTrees"], featureSubsetStrategy=str(mtry) if mtry else "auto",
                  minInstancesPerNode=p["minInstancesPerNode"], seed=p["seed"], **extra, **common)
    elif spec.kind == "boost_tree":
        cls = MR.GBTRegressor if reg else MC.GBTClassifier
        est = cls(maxIter=p["maxIter"], maxDepth=p["maxDepth"], stepSize=p["stepSize"],
                  minInstancesPerNode=p["minInstancesPerNode"], seed=p["seed"], **common)
        d, cuts, rows, cells = _cells(d, len(features), est.getMaxBins(), reg)
        if cells:
            # a node needs min_n rows, not cells; and MLlib looks for its cuts in at least maxBins^2 rows: in all cells
            est = est.setWeightCol("_weight").setMinInstancesPerNode(1).setMinWeightFractionPerNode((p["minInstancesPerNode"] - 0.5) / rows if p["minInstancesPerNode"] > 1 else 0.0)
            est = est.setMaxBins(max(est.getMaxBins(), math.isqrt(cells) + 1)) if cells <= SMALL_CELLS else est
    else:
        raise ValueError(spec.kind)
    model = est.fit(d)
    if spec.kind == "decision_tree" and p["cost_complexity"] > 0:
        model = pruned(model, train, features, outcome, None if reg else lv, p["cost_complexity"])
    if not reg and spec.kind == "boost_tree":
        model.setProbabilityCol("_prob").setRawPredictionCol("_raw")
    return Fitted(spec, model, features, outcome, lv, cuts)


#: most distinct values of a feature that are counted one by one, cells in which all cuts are looked for, and cells of a task
COUNTED_VALUES, SMALL_CELLS, CELLS_A_TASK = 10_000, 1_000_000, 20_000


def _bins(x, cuts: Sequence[Sequence[float]]) -> list:
    """The number of cuts below each feature's value (NaN: all of them); ``x`` is an array column."""
    return [reduce(add, [(x[i] > F.lit(c)).cast("int") for c in cut], F.lit(0)) for i, cut in enumerate(cuts)]


def _find_cuts(values: Sequence[tuple[float, float]], most: int) -> list[float]:
    """MLlib's cuts of a continuous feature into at most ``most`` bins: between all values, or nearest to equal shares of the rows.

    ``values``: (distinct value, rows), sorted.
    """
    between = [(a + b) / 2 for (a, _), (b, _) in zip(values, values[1:])]
    if len(between) < most:
        return between
    stride = sum(n for _, n in values) / most
    cuts, upto, target = [], values[0][1], stride
    for i in range(1, len(values)):
        before, upto = upto, upto + values[i][1]
        if abs(before - target) < abs(upto - target):
            cuts.append(between[i - 1])
            target += stride
    return cuts


def _cells(d: DataFrame, p: int, bins: int, reg: bool) -> tuple[DataFrame, list[list[float]] | None, int, int]:
    """The training rows as cells: (rows for MLlib, cuts, number of rows, number of cells).

    Trees see a feature as its bin only, so rows of the same bins (and of one
    class) take the same way through every tree.  A cell is such rows: their
    number is its weight, their mean its label, which gives the same sums as
    the rows themselves.  All rows are read to find the cuts and once more to
    fill the cells; the trees are then grown on the cells, at most one a row.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array

    x = [f"_x{i}" for i in range(p)]
    rows = stage(d.select(vector_to_array("_features").alias("_a"), "_label").select(*[F.col("_a")[i].alias(c) for i, c in enumerate(x)], "_label"))
    got = rows.agg(F.count(F.lit(1)).alias("n"), F.count("_label").alias("known"), *[F.approx_count_distinct(c, 0.02).alias(c) for c in x]).first()
    n = got["n"]
    if got["known"] < n:
        raise ValueError("the outcome has missing values")
    if not n or not p:
        return d, None, n, 0
    cuts = []
    for c in x:
        values = None
        if got[c] <= COUNTED_VALUES * 1.1:
            counted = rows.groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n")).limit(2 * COUNTED_VALUES).collect()
            values = sorted((r["v"], float(r["n"])) for r in counted)
        else:
            at = rows.agg(F.percentile_approx(c, [(i + 0.5) / COUNTED_VALUES for i in range(COUNTED_VALUES)], 10 * COUNTED_VALUES)).first()[0]
            values = sorted((v, k * n / COUNTED_VALUES) for v, k in Counter(at).items())
        cuts.append(_find_cuts(values, min(bins, n)))
    label = [] if reg else [F.col("_label")]
    binned = rows.select(*[b.alias(c) for b, c in zip(_bins([F.col(c) for c in x], cuts), x)], "_label")
    cells = stage(binned.groupBy(*x, *label).agg(F.count(F.lit(1)).cast("double").alias("_weight"), *([F.avg("_label").alias("_label")] if reg else [])))
    made = cells.count()
    out = cells.select(array_to_vector(F.array(*[F.col(c).cast("double") for c in x])).alias("_features"), "_label", "_weight")
    return out.coalesce(max(1, -(-made // CELLS_A_TASK))), cuts, n, made


def tidy(fitted: Fitted) -> DataFrame:
    """term, estimate (and std_error, statistic, p_value where MLlib reports them)."""
    m = fitted.model
    spark = _spark()
    names = ["(Intercept)"] + fitted.features
    est = [float(m.intercept)] + [float(x) for x in m.coefficients]
    se = st = pv = [None] * len(est)
    if fitted.spec.kind == "linear_reg" and fitted.spec.penalty == 0:
        try:
            s = m.summary
            # MLlib puts the intercept last
            se, st, pv = ([v[-1], *v[:-1]] for v in (list(s.coefficientStandardErrors), list(s.tValues), list(s.pValues)))
        except UnsupportedOperationException:  # collinear features: MLlib solved iteratively, without standard errors
            pass
    rows = [(n, e, s_, t_, p_) for n, e, s_, t_, p_ in zip(names, est, se, st, pv)]
    return spark.createDataFrame(rows, "term string, estimate double, std_error double, statistic double, p_value double")


def _spark():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


def logistic_inference(train: DataFrame, outcome: str, features: Sequence[str], levels: Sequence) -> DataFrame:
    """Unpenalised logistic regression with Wald inference (GLM binomial/logit)."""
    from pyspark.ml.regression import GeneralizedLinearRegression

    d = _label(_assemble(train, features), outcome, list(levels))
    m = GeneralizedLinearRegression(family="binomial", link="logit", featuresCol="_features", labelCol="_label").fit(d)
    s = m.summary
    names = list(features) + ["(Intercept)"]
    est = list(m.coefficients) + [m.intercept]
    rows = [(n, float(e), float(se), float(z), float(p)) for n, e, se, z, p in
            zip(names, est, s.coefficientStandardErrors, s.tValues, s.pValues)]
    return _spark().createDataFrame(rows, "term string, estimate double, std_error double, statistic double, p_value double")


def odds_ratios(tidy_df: DataFrame, z: float = 1.96) -> DataFrame:
    """exp(b), 95% CI exp(b +/- z se) and significance stars (.001 / .01 / .05)."""
    # fixed values: significance cut points and their stars
    stars = F.when(F.col("p_value") < 0.001, "***").when(F.col("p_value") < 0.01, "**").when(F.col("p_value") < 0.05, "*").otherwise("")
    return tidy_df.select("term", "estimate", F.exp("estimate").alias("odds_ratio"),
                          F.exp(F.col("estimate") - z * F.col("std_error")).alias("ci_low"),
                          F.exp(F.col("estimate") + z * F.col("std_error")).alias("ci_high"), "p_value",
                          stars.alias("stars"))


# ------------------------------------------------------------------ exact linear algebra from sums


def gram(df: DataFrame, features: Sequence[str], y: str, by: Sequence[str] = ()) -> DataFrame:
    """X'X, X'y, y'y and n per group (X with a leading intercept column), one aggregation.

    Output columns: by..., n, yy, xy_<i>, xx_<i>_<j> (i <= j), i over 0..p.
    """
    xs = [F.lit(1.0)] + [F.col(c).cast("double") for c in features]
    yy = F.col(y).cast("double")
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(yy * yy).alias("yy")]
    aggs += [F.sum(xs[i] * yy).alias(f"xy_{i}") for i in range(len(xs))]
    aggs += [F.sum(xs[i] * xs[j]).alias(f"xx_{i}_{j}") for i in range(len(xs)) for j in range(i, len(xs))]
    return df.groupBy(*by).agg(*aggs)


def _unpack(row, p: int):
    XtX = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            XtX[i, j] = XtX[j, i] = row[f"xx_{i}_{j}"]
    Xty = np.array([row[f"xy_{i}"] for i in range(p)])
    return XtX, Xty, row["yy"], row["n"]


def ols_from_gram(row, features: Sequence[str], ridge: float = 0.0) -> dict:
    """Coefficients (and, without ridge, Wald t inference) from one gram row."""
    p = len(features) + 1
    XtX, Xty, yy, n = _unpack(row, p)
    A = XtX + ridge * np.diag([0.0] + [1.0] * (p - 1))
    beta = np.linalg.solve(A, Xty)
    out = {"beta": beta, "n": n}
    if ridge == 0.0 and n > p:
        rss = yy - 2 * beta @ Xty + beta @ XtX @ beta
        sigma2 = rss / (n - p)
        cov = sigma2 * np.linalg.inv(XtX)
        out.update(se=np.sqrt(np.diag(cov)), rss=rss, sigma2=sigma2, inv=np.linalg.inv(XtX))
    return out


def _incomplete_beta(a: float, b: float, x: float, y: float) -> float:
    """Regularised I_x(a, b) with y = 1 - x: its continued fraction, evaluated from the inside out."""
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _incomplete_beta(b, a, y, x)
    if x <= 0:
        return 0.0
    f = 1.0
    for k in range(200 + 4 * math.isqrt(int(max(a, b))), 0, -1):
        m = k // 2
        num = -(a + m) * (a + b + m) if k % 2 else m * (b - m)
        f = 1.0 + num * x / ((a + k - 1) * (a + k)) / f
    scale = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(y)
    return math.exp(scale) / (a * f)


def t_two_sided(t: float, dof: int) -> float:
    """P(|T| >= |t|) under Student's t with ``dof`` degrees of freedom."""
    total = dof + t * t
    return _incomplete_beta(dof / 2, 0.5, dof / total, t * t / total)


def ols(df: DataFrame, y: str, features: Sequence[str]) -> DataFrame:
    """OLS with inference (term, estimate, std_error, statistic, p_value) from X'X, X'y."""
    row = gram(df, features, y).first()
    r = ols_from_gram(row, features)
    names = ["(Intercept)"] + list(features)
    rows = []
    for i, nme in enumerate(names):
        se = float(r["se"][i]) if "se" in r else None
        t = float(r["beta"][i] / se) if se else None
        p = t_two_sided(t, r["n"] - len(names)) if t is not None else None
        rows.append((nme, float(r["beta"][i]), se, t, p))
    return _spark().createDataFrame(rows, "term string, estimate double, std_error double, statistic double, p_value double")


def press_residuals(df: DataFrame, key: str, y: str, features: Sequence[str]) -> DataFrame:
    """Leave-one-out residuals of OLS without N refits: e_i / (1 - h_ii), h_ii = x_i'(X'X)^-1 x_i.

    (X'X)^-1 is p x p from one aggregation; the rest is a projection.
    """
    row = gram(df, features, y).first()
    r = ols_from_gram(row, features)
    inv, beta = r["inv"], r["beta"]
    xs = [F.lit(1.0)] + [F.col(c).cast("double") for c in features]
    p = len(xs)
    fitted = sum((xs[i] * float(beta[i]) for i in range(p)), F.lit(0.0))
    h = sum((xs[i] * xs[j] * float(inv[i, j]) for i in range(p) for j in range(p)), F.lit(0.0))
    resid = F.col(y).cast("double") - fitted
    return df.select(key, fitted.alias("fitted"), h.alias("leverage"), (resid / (1 - h)).alias("press_residual"))


def fit_by_group(df: DataFrame, group: str, y: str, features: Sequence[str]) -> DataFrame:
    """OLS coefficients per group (train-by-subset) from per-group gram sums.

    The aggregation is a map-side partial sum (hot groups are combined before
    the shuffle); each group's p x p solve runs in a grouped pandas UDF over
    a one-row input.
    """
    g = gram(df, features, y, [group])
    names = ["(Intercept)"] + list(features)
    p = len(names)

    def solve(pdf):
        import pandas as pd

        rows = []
        for _, r in pdf.iterrows():
            try:
                beta = ols_from_gram(r, features)["beta"]
            except np.linalg.LinAlgError:
                beta = [float("nan")] * p
            rows += [(r[group], names[i], float(beta[i])) for i in range(p)]
        return pd.DataFrame(rows, columns=[group, "term", "estimate"])

    gt = df.schema[group].dataType.simpleString()
    return g.groupBy(group).applyInPandas(solve, f"{group} {gt}, term string, estimate double")


def fit_by_subset(spec: ModelSpec, df: DataFrame, group: str, y: str, features: Sequence[str], levels: Sequence | None = None,
                  max_groups: int = 1000) -> dict:
    """One fit of any model per level of ``group`` (train by subset): {level: fitted model}.

    Every fit is a Spark job over its subset, so the levels are bounded: beyond
    ``max_groups`` this raises (``fit_by_group`` solves OLS for any number of
    groups in one pass).  Rows without a level belong to no subset.
    """
    found = sorted(r[0] for r in df.select(group).na.drop().distinct().limit(max_groups + 1).collect())
    if len(found) > max_groups:
        raise ValueError(f"{group} has more than {max_groups} levels")
    return {g: fit(spec, df.filter(F.col(group) == F.lit(g)), y, features, levels) for g in found}


def gram_by_fold(df: DataFrame, fold: str, y: str, features: Sequence[str]) -> DataFrame:
    """Per-fold X'X, X'y, y'y in one pass."""
    return gram(df, features, y, [fold])


def ridge_cv_from_gram(gram_rows: list, features: Sequence[str], lambdas: Sequence[float]) -> list[tuple]:
    """Leave-one-fold-out ridge RMSE for every lambda from per-fold grams (no refits on data).

    Training gram = total - fold gram; assessment SSE = yy - 2 b'Xy + b'XXb on the held fold.
    """
    p = len(features) + 1
    parts = {r["fold"]: _unpack(r, p) for r in gram_rows}
    tot = [sum(v[i] for v in parts.values()) for i in range(4)]
    out = []
    for lam in lambdas:
        for f, (XX, Xy, yy, n) in sorted(parts.items()):
            A = tot[0] - XX + lam * np.diag([0.0] + [1.0] * (p - 1))
            b = np.linalg.solve(A, tot[1] - Xy)
            sse = yy - 2 * b @ Xy + b @ XX @ b
            out.append((float(lam), int(f), float(math.sqrt(max(sse, 0.0) / n))))
    return out


# ------------------------------------------------------------------ k-NN


def knn_predict(queries: DataFrame, train: DataFrame, qid: str, vec: str, label: str, k: int, key: str,
                mode: str = "classification") -> DataFrame:
    """Exact k nearest neighbours (Euclidean; ties by the training ``key``) of any number of rows (see ``neighbours``).

    classification: ``pred_label`` (any orderable type; ties in the vote go
    to the smallest label), its ``votes`` and ``prob`` = votes / neighbours.
    regression: ``pred``, the neighbours' mean.  Training rows without a
    label are no neighbours.
    """
    q = queries.select(F.col(qid).alias("_q"), F.col(vec).alias("_qv"))
    t = train.filter(F.col(label).isNotNull()).select(F.col(key).alias("_n"), F.col(vec).alias("_nv"), F.col(label).alias("_t"))
    nn = nearest(q, t, k)
    if mode == "regression":
        return nn.groupBy(F.col("_q").alias(qid)).agg(F.avg(F.col("_t").cast("double")).alias("pred"))
    votes = nn.groupBy("_q", "_t").agg(F.count(F.lit(1)).alias("_v"))
    best = votes.groupBy("_q").agg(F.min(F.struct((-F.col("_v")).alias("neg"), "_t")).alias("_b"), F.sum("_v").alias("_k"))
    return best.select(F.col("_q").alias(qid), F.col("_b._t").alias("pred_label"), (-F.col("_b.neg")).alias("votes"),
                       (-F.col("_b.neg") / F.col("_k")).alias("prob"))


# ------------------------------------------------------------------ Gini split search


MAX_CLASSES = 1000  # one running sum a class


def best_split_gini(df: DataFrame, y: str, cols: Sequence[str]) -> DataFrame:
    """Best threshold per numeric column by weighted child Gini (binary or multiclass y).

    Per column: class counts per distinct value (partial aggregation), running
    class counts in value order (two-level running sums), and
    the weighted Gini of each cut x <= v.  Node Gini and the chosen cut
    (rows with x <= threshold go left) are reported.
    """
    from faro.operators.ranking import running_sums

    long = df.select(col(y).cast("string").alias("_y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in cols])).alias("kv")).select("_y", "kv.*")
    classes = [r[0] for r in df.select(col(y).cast("string")).distinct().limit(MAX_CLASSES + 1).collect()]
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"{y} has more than {MAX_CLASSES} classes")
    counts = long.groupBy("variable", "value").agg(*[F.count_if(F.col("_y") == F.lit(k)).alias(f"c_{i}") for i, k in enumerate(classes)])
    cc = [f"c_{i}" for i in range(len(classes))]
    cum = running_sums(counts, "value", cc, ["variable"])
    tot = cum.groupBy("variable").agg(*[F.sum(c).alias(f"t_{c}") for c in cc])
    j = cum.join(tot, "variable")
    nl = sum((F.col(f"{c}_cum") for c in cc), F.lit(0)).cast("double")
    nt = sum((F.col(f"t_{c}") for c in cc), F.lit(0)).cast("double")
    nr = nt - nl
    gl = 1 - sum((F.pow(safe_div(F.col(f"{c}_cum"), nl), 2) for c in cc), F.lit(0.0))
    gr = 1 - sum((F.pow(safe_div(F.col(f"t_{c}") - F.col(f"{c}_cum"), nr), 2) for c in cc), F.lit(0.0))
    gnode = 1 - sum((F.pow(F.col(f"t_{c}") / nt, 2) for c in cc), F.lit(0.0))
    # every cut "x <= value" that leaves rows on both sides; no per-column window over values
    cand = (j.filter(nr > 0)
            .select("variable", "value", gnode.alias("node_gini"), ((nl * gl + nr * gr) / nt).alias("weighted_gini")))
    best = cand.groupBy("variable").agg(F.min(F.struct("weighted_gini", "value", "node_gini")).alias("b"))
    return best.select("variable", F.col("b.value").alias("threshold"),
                       F.col("b.node_gini").alias("node_gini"), F.col("b.weighted_gini").alias("weighted_gini"),
                       (F.col("b.node_gini") - F.col("b.weighted_gini")).alias("gain"))


def knn_impute(df: DataFrame, key: str, target: str, features: Sequence[str], k: int = 5) -> DataFrame:
    """Fill NULL ``target`` values with the mean of the k nearest complete rows (Euclidean on
    ``features``; ties by key).  A row with a missing feature stays unfilled."""
    vec = F.array(*[F.col(c).cast("double") for c in features])
    miss = df.filter(F.col(target).isNull()).select(F.col(key).alias("_q"), vec.alias("_qv"))
    done = df.filter(F.col(target).isNotNull()).select(F.col(key).alias("_n"), vec.alias("_nv"), F.col(target).cast("double").alias("_t"))
    fill = nearest(miss, done, k).groupBy("_q").agg(F.avg("_t").alias("_fill"))
    out = df.join(fill, df[key] == fill["_q"], "left")
    return out.withColumn(target, F.coalesce(F.col(target).cast("double"), F.col("_fill"))).drop("_q", "_fill")


def compare_coefficients(fits: dict, wide: bool = True) -> DataFrame:
    """Coefficients of several fitted linear models side by side (joined by term) and zero counts."""
    parts = [tidy(f).select("term", F.col("estimate").alias(name)) for name, f in fits.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "term", "full")
    return out
