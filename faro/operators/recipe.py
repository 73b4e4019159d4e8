"""Preprocessing recipes: estimate on training data, apply anywhere.

``Recipe`` is a declarative list of steps.  ``prep(train)`` walks the steps
in order; each step estimates its parameters with one aggregation over the
training data *as transformed by the previous steps* (lazy, so Catalyst
fuses the expressions) and keeps only small state on the driver (means,
level lists, medians: bounded by columns x levels).  ``bake(df)`` is then a
pure column projection -- no shuffle, no join -- usable on test data, new
data, or a stream.  Parameters never see rows outside ``train``, so
resampling stays leak-free when a recipe is prepped inside each fold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faro.functions.core import numeric_columns, string_columns
from faro.operators.ranking import quantiles

ALL_NUMERIC = "all_numeric"
ALL_NOMINAL = "all_nominal"
ALL_PREDICTORS = "all_predictors"


@dataclass
class Step:
    kind: str
    cols: Sequence[str] | str
    params: dict = field(default_factory=dict)


@dataclass
class FittedStep:
    kind: str
    state: dict

    def apply(self, df: DataFrame) -> DataFrame:
        return _APPLY[self.kind](df, self.state)


class Recipe:
    """``recipe(y ~ ., data)`` with roles: an outcome and id columns are never predictors."""

    def __init__(self, outcome: str | None = None, ids: Sequence[str] = (), predictors: Sequence[str] | None = None):
        self.outcome = outcome
        self.ids = list(ids)
        self.predictors = list(predictors) if predictors is not None else None
        self.steps: list[Step] = []

    @classmethod
    def from_formula(cls, formula: str, ids: Sequence[str] = ()) -> "Recipe":
        """``y ~ .``, ``y ~ a + b`` or ``y ~ . - x`` (terms separated by + / -)."""
        lhs, rhs = (s.strip() for s in formula.split("~"))
        rhs = rhs.replace("-", "+-")
        terms = [t.strip() for t in rhs.split("+") if t.strip()]
        keep = [t for t in terms if not t.startswith("-") and t != "."]
        drop = [t[1:].strip() for t in terms if t.startswith("-")]
        r = cls(lhs, ids, None if "." in terms else keep)
        r._exclude = drop
        return r

    _exclude: list = []

    # -- step constructors (chainable) -------------------------------------------------
    def _add(self, kind, cols, **params):
        self.steps.append(Step(kind, cols, params))
        return self

    def step_dummy(self, cols=ALL_NOMINAL, one_hot: bool = False, levels: dict | None = None):
        return self._add("dummy", cols, one_hot=one_hot, levels=levels or {})

    def step_normalize(self, cols=ALL_NUMERIC):
        return self._add("normalize", cols)

    def step_range(self, cols=ALL_NUMERIC):
        return self._add("range", cols)

    def step_zv(self, cols=ALL_PREDICTORS):
        return self._add("zv", cols)

    def step_novel(self, cols=ALL_NOMINAL, new_level: str = "new"):
        return self._add("novel", cols, new_level=new_level)

    def step_impute_median(self, cols=ALL_NUMERIC):
        return self._add("impute_median", cols)

    def step_impute_mean(self, cols=ALL_NUMERIC):
        return self._add("impute_mean", cols)

    def step_indicate_na(self, cols=ALL_PREDICTORS):
        return self._add("indicate_na", cols)

    def step_other(self, cols=ALL_NOMINAL, threshold: float = 0.05, other: str = "other"):
        return self._add("other", cols, threshold=threshold, other=other)

    def step_corr(self, cols=ALL_NUMERIC, threshold: float = 0.9):
        return self._add("corr", cols, threshold=threshold)

    def step_log(self, cols, offset: float = 0.0):
        return self._add("log", cols, offset=offset)

    def step_interact(self, a: str, b: str):
        return self._add("interact", [a, b])

    def step_poly(self, cols, degree: int = 2):
        return self._add("poly", cols, degree=degree)

    def step_rm(self, cols):
        return self._add("rm", cols)

    # -- roles ---------------------------------------------------------------------------
    def _predictors(self, df: DataFrame) -> list[str]:
        base = self.predictors if self.predictors is not None else [
            c for c in df.columns if c != self.outcome and c not in self.ids]
        return [c for c in base if c not in self._exclude and c in df.columns]

    def _resolve(self, sel, df: DataFrame, current: list[str]) -> list[str]:
        if isinstance(sel, str) and sel in (ALL_NUMERIC, ALL_NOMINAL, ALL_PREDICTORS):
            if sel == ALL_NUMERIC:
                num = set(numeric_columns(df))
                return [c for c in current if c in num]
            if sel == ALL_NOMINAL:
                nom = set(string_columns(df))
                return [c for c in current if c in nom]
            return list(current)
        cols = [sel] if isinstance(sel, str) else list(sel)
        return [c for c in cols if c in df.columns]

    def prep(self, train: DataFrame) -> "PreppedRecipe":
        current = self._predictors(train)
        df = train.select(*[c for c in train.columns if c in current or c == self.outcome or c in self.ids])
        # one aggregation per step: keep the (projected) training rows cached for the
        # duration of the fit, as MLlib estimators do for multi-pass fits
        cached = not train.storageLevel.useMemory and not train.storageLevel.useDisk and len(self.steps) > 1
        base = df.persist(StorageLevel.MEMORY_AND_DISK) if cached else df
        df = base
        fitted = []
        try:
            for st in self.steps:
                cols = self._resolve(st.cols, df, current)
                fs = FittedStep(st.kind, _FIT[st.kind](df, cols, st.params))
                df = fs.apply(df)
                # predictor set follows the columns each step adds/removes
                current = [c for c in df.columns if c != self.outcome and c not in self.ids]
                fitted.append(fs)
        finally:
            if cached:
                base.unpersist()
        return PreppedRecipe(self, fitted, self._bake(train, fitted))

    def _bake(self, df: DataFrame, steps: list[FittedStep]) -> DataFrame:
        pred = self._predictors(df)
        out = df.select(*[c for c in df.columns if c in pred or c == self.outcome or c in self.ids])
        for s in steps:
            out = s.apply(out)
        return out


class PreppedRecipe:
    def __init__(self, recipe: Recipe, steps: list[FittedStep], juiced: DataFrame):
        self.recipe, self.steps, self._juiced = recipe, steps, juiced

    def bake(self, df: DataFrame) -> DataFrame:
        return self.recipe._bake(df, self.steps)

    def juice(self) -> DataFrame:
        return self._juiced

    def state(self) -> list[dict]:
        return [{"kind": s.kind, **s.state} for s in self.steps]


# ------------------------------------------------------------------------- fit / apply

MAX_LEVELS = 10_000  # levels of one factor that may come to the driver


def _levels(df, c):
    """Sorted levels of a column; a column with more than ``MAX_LEVELS`` is no factor and raises (see step_other)."""
    rows = df.select(c).na.drop().distinct().limit(MAX_LEVELS + 1).collect()
    if len(rows) > MAX_LEVELS:
        raise ValueError(f"{c} has more than {MAX_LEVELS} levels: lump them with step_other or declare them")
    return sorted(r[0] for r in rows)


def _fit_dummy(df, cols, p):
    levels = dict(p.get("levels") or {})
    need = [c for c in cols if c not in levels]
    if need:
        for c in need:
            levels[c] = _levels(df, c)
    return {"cols": cols, "levels": {c: levels[c] for c in cols}, "one_hot": p.get("one_hot", False)}


def _apply_dummy(df, s):
    out = df
    for c in s["cols"]:
        lv = s["levels"][c] if s["one_hot"] else s["levels"][c][1:]
        out = out.withColumns({f"{c}_{v}": (F.col(c) == F.lit(v)).cast("double") for v in lv}).drop(c)
    return out


def _fit_moments(df, cols, p):
    if not cols:
        return {"mean": {}, "sd": {}}
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols],
                 *[F.stddev_samp(F.col(c).cast("double")).alias(f"s_{c}") for c in cols]).first()
    return {"mean": {c: row[f"m_{c}"] for c in cols}, "sd": {c: row[f"s_{c}"] for c in cols}}


def _apply_normalize(df, s):
    ex = {}
    for c, m in s["mean"].items():
        sd = s["sd"][c]
        x = F.col(c).cast("double") - F.lit(m)
        # a constant column (sd 0) stays centred instead of dividing by zero
        ex[c] = x / F.lit(sd) if sd not in (None, 0.0) else x
    return df.withColumns(ex) if ex else df


def _fit_range(df, cols, p):
    if not cols:
        return {"min": {}, "max": {}}
    row = df.agg(*[F.min(F.col(c).cast("double")).alias(f"a_{c}") for c in cols],
                 *[F.max(F.col(c).cast("double")).alias(f"b_{c}") for c in cols]).first()
    return {"min": {c: row[f"a_{c}"] for c in cols}, "max": {c: row[f"b_{c}"] for c in cols}}


def _apply_range(df, s):
    ex = {}
    for c, lo in s["min"].items():
        hi = s["max"][c]
        x = F.col(c).cast("double") - F.lit(lo)
        ex[c] = x / F.lit(hi - lo) if hi is not None and lo is not None and hi > lo else x
    return df.withColumns(ex) if ex else df


def _fit_zv(df, cols, p):
    if not cols:
        return {"drop": []}
    # zero variance <=> min == max over non-null values (no distinct-count Expand needed)
    row = df.agg(*[F.min(c).alias(f"a_{c}") for c in cols], *[F.max(c).alias(f"b_{c}") for c in cols]).first()
    return {"drop": [c for c in cols if row[f"a_{c}"] is None or row[f"a_{c}"] == row[f"b_{c}"]]}


def _apply_drop(df, s):
    return df.drop(*s["drop"])


def _fit_levels(df, cols, p):
    if not cols:
        return {"levels": {}, "new_level": p.get("new_level", "new")}
    return {"levels": {c: _levels(df, c) for c in cols}, "new_level": p.get("new_level", "new")}


def _apply_novel(df, s):
    ex = {c: F.when(F.col(c).isNull() | F.col(c).isin(lv), F.col(c)).otherwise(F.lit(s["new_level"]))
          for c, lv in s["levels"].items()}
    return df.withColumns(ex) if ex else df


def _fit_median(df, cols, p):
    med = {}
    for c in cols:
        r = quantiles(df, c, [0.5]).first()
        med[c] = r["quantile"] if r else None
    return {"value": med}


def _fit_mean(df, cols, p):
    return {"value": _fit_moments(df, cols, p)["mean"]}


def _apply_impute(df, s):
    ex = {c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in s["value"].items() if v is not None}
    return df.withColumns(ex) if ex else df


def _fit_indicate(df, cols, p):
    return {"cols": cols}


def _apply_indicate(df, s):
    return df.withColumns({f"na_ind_{c}": F.col(c).isNull().cast("int") for c in s["cols"]}) if s["cols"] else df


def _fit_other(df, cols, p):
    keep = {}
    thr = p["threshold"]
    for c in cols:
        rows = df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        tot = rows.agg(F.sum("n")).first()[0] or 0
        # level list is bounded by the column's cardinality
        keep[c] = sorted(r[c] for r in rows.filter(F.col("n") >= F.lit(thr * tot)).collect() if r[c] is not None)
    return {"keep": keep, "other": p.get("other", "other")}


def _apply_other(df, s):
    ex = {c: F.when(F.col(c).isNull() | F.col(c).isin(lv), F.col(c)).otherwise(F.lit(s["other"]))
          for c, lv in s["keep"].items()}
    return df.withColumns(ex) if ex else df


def greedy_corr_filter(names: Sequence[str], r: np.ndarray, threshold: float) -> list[str]:
    """Drop columns until every |r| <= threshold: of the worst pair, drop the
    column with the larger mean |r| against the remaining columns."""
    names = list(names)
    a = np.abs(np.nan_to_num(np.asarray(r, dtype=float)))
    np.fill_diagonal(a, 0.0)
    alive = list(range(len(names)))
    dropped = []
    while len(alive) > 1:
        sub = a[np.ix_(alive, alive)]
        i, j = np.unravel_index(np.argmax(sub), sub.shape)
        if sub[i, j] <= threshold:
            break
        mi, mj = sub[i].mean(), sub[j].mean()
        k = alive[i] if mi >= mj else alive[j]
        dropped.append(names[k])
        alive.remove(k)
    return dropped


def _fit_corr(df, cols, p):
    if len(cols) < 2:
        return {"drop": []}
    aggs = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            x, y = F.col(a).cast("double"), F.col(b).cast("double")
            aggs.append(F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)).alias(f"{a}__{b}"))
    row = df.agg(*aggs).first()
    n = len(cols)
    r = np.eye(n)
    for i, a in enumerate(cols):
        for j in range(i + 1, n):
            v = row[f"{a}__{cols[j]}"]
            r[i, j] = r[j, i] = 0.0 if v is None else v
    return {"drop": greedy_corr_filter(cols, r, p["threshold"])}


def _fit_log(df, cols, p):
    return {"cols": cols, "offset": p.get("offset", 0.0)}


def _apply_log(df, s):
    return df.withColumns({c: F.ln(F.col(c).cast("double") + F.lit(s["offset"])) for c in s["cols"]}) if s["cols"] else df


def _fit_interact(df, cols, p):
    return {"a": cols[0], "b": cols[1]}


def _apply_interact(df, s):
    a, b = s["a"], s["b"]
    return df.withColumn(f"{a}_x_{b}", F.col(a).cast("double") * F.col(b).cast("double"))


def _fit_poly(df, cols, p):
    """Orthogonal polynomial basis on train (three-term recurrence, R ``poly``).

    Needs sums of x^k for k <= 2*degree: one aggregation; coefficients are
    solved on the driver (degree x degree).
    """
    deg = p["degree"]
    out = {}
    for c in cols:
        x = F.col(c).cast("double")
        st = df.agg(F.avg(x).alias("m"), F.stddev_samp(x).alias("s")).first()
        m, sd = st["m"] or 0.0, st["s"] or 1.0
        z = (x - F.lit(m)) / F.lit(sd)  # the basis is invariant to this affine map; it keeps the sums well scaled
        row = df.agg(F.count(x).alias("n"), *[F.sum(F.pow(z, k)).alias(f"s{k}") for k in range(1, 2 * deg + 1)]).first()
        mom = [float(row["n"])] + [float(row[f"s{k}"]) for k in range(1, 2 * deg + 1)]  # sums of z^k

        # polynomials as monomial coefficient lists in z; <p, q> = sum_i p(z_i) q(z_i)
        def ip(pc, qc):
            return sum(pc[i] * qc[j] * mom[i + j] for i in range(len(pc)) for j in range(len(qc)))

        basis = [[1.0]]
        norms = [ip(basis[0], basis[0])]
        for k in range(deg):
            pk = basis[-1]
            zpk = [0.0] + pk
            a = ip(zpk, pk) / norms[-1]
            nxt = [zpk[i] - a * (pk[i] if i < len(pk) else 0.0) for i in range(len(zpk))]
            if k > 0:
                b = norms[-1] / norms[-2]
                pm = basis[-2]
                nxt = [nxt[i] - b * (pm[i] if i < len(pm) else 0.0) for i in range(len(nxt))]
            basis.append(nxt)
            norms.append(ip(nxt, nxt))
        # unit-norm columns as in R poly()
        out[c] = {"mean": m, "sd": sd, "polys": [[v / np.sqrt(norms[k]) for v in basis[k]] for k in range(1, deg + 1)]}
    return {"coef": out}


def _apply_poly(df, s):
    ex = {}
    for c, st in s["coef"].items():
        z = (F.col(c).cast("double") - F.lit(st["mean"])) / F.lit(st["sd"])
        for k, coefs in enumerate(st["polys"], start=1):
            e: Column = F.lit(0.0)
            for pw, a in enumerate(coefs):
                e = e + F.lit(float(a)) * (F.pow(z, pw) if pw else F.lit(1.0))
            ex[f"{c}_poly_{k}"] = e
    return df.withColumns(ex).drop(*s["coef"].keys()) if ex else df


def _fit_rm(df, cols, p):
    return {"drop": cols}


_FIT = {"dummy": _fit_dummy, "normalize": _fit_moments, "range": _fit_range, "zv": _fit_zv, "novel": _fit_levels,
        "impute_median": _fit_median, "impute_mean": _fit_mean, "indicate_na": _fit_indicate, "other": _fit_other,
        "corr": _fit_corr, "log": _fit_log, "interact": _fit_interact, "poly": _fit_poly, "rm": _fit_rm}
_APPLY = {"dummy": _apply_dummy, "normalize": _apply_normalize, "range": _apply_range, "zv": _apply_drop,
          "novel": _apply_novel, "impute_median": _apply_impute, "impute_mean": _apply_impute,
          "indicate_na": _apply_indicate, "other": _apply_other, "corr": _apply_drop, "log": _apply_log,
          "interact": _apply_interact, "poly": _apply_poly, "rm": _apply_drop}
