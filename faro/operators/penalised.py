"""Penalised linear regression paths from cross-product sums.

The data is scanned once: ``gram_by_fold`` sums X'X, X'y and y'y per fold.
Everything after that works on these p x p matrices, on the driver and
independent of the number of rows: the training sums of a fold are the total
less the fold's own, predictors are standardised by the training rows only (so
nothing leaks), the whole path of every fold is cyclic coordinate descent with
warm starts, and the assessment error comes from the held fold's sums.

Objective, for standardised predictors (population sd) and an unpenalised
intercept: RSS / (2 n) + penalty * (mixture * |b|_1 + (1 - mixture) / 2 * |b|^2).
Coefficients are reported in the predictors' own units.  A predictor without
variance in the training rows has coefficient 0.

The sums are exact to about 1e-16 of the squared sizes: shift columns that are
large against their spread (or run ``step_normalize`` first).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faro.operators.models import _unpack, gram_by_fold
from faro.operators.tuning import collect_metrics, select_by_one_std_err, show_best

#: largest KKT residual at which coordinate descent stops, as a share of the largest correlation
TOLERANCE = 1e-12
MOST_SWEEPS = 200_000


@dataclass(frozen=True)
class Sums:
    """Cross products of the rows of some folds (leading intercept column)."""

    xx: np.ndarray
    xy: np.ndarray
    yy: float
    n: int

    def less(self, other: "Sums") -> "Sums":
        return Sums(self.xx - other.xx, self.xy - other.xy, self.yy - other.yy, self.n - other.n)

    def plus(self, other: "Sums") -> "Sums":
        return Sums(self.xx + other.xx, self.xy + other.xy, self.yy + other.yy, self.n + other.n)


@dataclass(frozen=True)
class Standard:
    """Centred, standardised moments of the training rows."""

    corr: np.ndarray      # correlations of the predictors (0 rows where there is no variance)
    cov_y: np.ndarray     # mean product of standardised predictor and centred outcome
    mean: np.ndarray
    sd: np.ndarray
    mean_y: float

    @staticmethod
    def of(s: Sums) -> "Standard":
        mean, mean_y = s.xx[0, 1:] / s.n, s.xy[0] / s.n
        cov = s.xx[1:, 1:] / s.n - np.outer(mean, mean)
        var = np.diag(cov).copy()
        flat = var <= 1e-13 * np.maximum(np.diag(s.xx)[1:] / s.n, 1e-300)
        sd = np.where(flat, 0.0, np.sqrt(np.where(flat, 1.0, var)))
        inv = np.where(flat, 0.0, 1 / np.where(flat, 1.0, sd))
        return Standard(cov * np.outer(inv, inv), (s.xy[1:] / s.n - mean * mean_y) * inv, mean, sd, float(mean_y))

    def own_units(self, b: np.ndarray) -> np.ndarray:
        """Intercept and slopes for the predictors as they are."""
        slope = np.where(self.sd > 0, b / np.where(self.sd > 0, self.sd, 1), 0.0)
        return np.concatenate([[self.mean_y - slope @ self.mean], slope])


def kkt_residual(m: Standard, b: np.ndarray, penalty: float, mixture: float) -> float:
    """How far standardised coefficients are from the optimum: the largest violation of the KKT conditions."""
    g = m.cov_y - m.corr @ b - penalty * (1 - mixture) * b
    l1 = penalty * mixture
    off = np.where(b != 0, np.abs(g - l1 * np.sign(b)), np.maximum(np.abs(g) - l1, 0))
    return float(np.where(m.sd > 0, off, 0).max(initial=0))


def descend(m: Standard, penalty: float, mixture: float, start: np.ndarray) -> np.ndarray:
    """Cyclic coordinate descent on the moments: sweeps over the active set, then one over all, until the KKT conditions hold."""
    b = start.copy()
    g = m.cov_y - m.corr @ b                 # gradient of the fit, kept up to date
    l1, ridge = penalty * mixture, penalty * (1 - mixture)
    usable = [j for j in range(len(b)) if m.sd[j] > 0]
    goal = TOLERANCE * max(float(np.abs(m.cov_y).max(initial=0)), 1e-300)

    def sweep(these) -> None:
        for j in these:
            z = g[j] + m.corr[j, j] * b[j]
            new = math.copysign(max(abs(z) - l1, 0.0), z) / (m.corr[j, j] + ridge)
            if new != b[j]:
                g[:] -= m.corr[:, j] * (new - b[j])
                b[j] = new

    for k in range(MOST_SWEEPS):
        sweep(usable if k % 10 == 0 else [j for j in usable if b[j] != 0])
        if k % 10 in (0, 9) and kkt_residual(m, b, penalty, mixture) <= goal:
            return b
    raise ValueError(f"coordinate descent did not settle (penalty {penalty}, mixture {mixture}); are predictors collinear without a ridge part?")


def path(s: Sums, penalties: Sequence[float], mixture: float) -> dict[float, np.ndarray]:
    """Standardised coefficients at every penalty, from the largest down with warm starts."""
    m = Standard.of(s)
    b = np.zeros(len(m.cov_y))
    out = {}
    for lam in sorted(set(map(float, penalties)), reverse=True):
        b = descend(m, lam, mixture, b)
        out[lam] = b
    return out


def penalty_path(s: Sums, mixture: float = 1.0, n: int = 50, ratio: float = 1e-4) -> list[float]:
    """``n`` penalties on a log scale from the smallest that sets every coefficient to zero down to ``ratio`` of it."""
    top = float(np.abs(Standard.of(s).cov_y).max(initial=0)) / max(mixture, 1e-3)
    if top <= 0:
        return [0.0]
    return [top * ratio ** (k / max(n - 1, 1)) for k in range(n)]


def held_out(s: Sums, beta: np.ndarray) -> dict[str, float]:
    """Errors of intercept and slopes on the rows behind ``s``, from their sums only."""
    sse = float(s.yy - 2 * beta @ s.xy + beta @ s.xx @ beta)
    mean_y = s.xy[0] / s.n
    syy = float(s.yy - s.n * mean_y ** 2)
    fitted = float(beta @ s.xx[0]) / s.n
    cov = float(beta @ s.xy) - s.n * fitted * mean_y
    var = float(beta @ s.xx @ beta) - s.n * fitted ** 2
    flat = var <= 1e-12 * max(float(beta @ s.xx @ beta), 1e-300) or syy <= 0
    return {"rmse": math.sqrt(max(sse, 0.0) / s.n), "mse": max(sse, 0.0) / s.n,
            "rsq": None if flat else float(cov * cov / (var * syy)), "rsq_trad": None if syy <= 0 else float(1 - sse / syy)}


def sums_by_fold(df: DataFrame, fold: str, y: str, features: Sequence[str]) -> dict[int, Sums]:
    """One scan: the sums of every fold (rows with a missing predictor or outcome are left out)."""
    whole = df.na.drop(subset=[y, *features])
    p = len(features) + 1
    return {int(r[fold]): Sums(*_unpack(r, p)) for r in gram_by_fold(whole, fold, y, features).collect()}  # one row a fold


def total(parts: dict[int, Sums]) -> Sums:
    out = None
    for f in sorted(parts):
        out = parts[f] if out is None else out.plus(parts[f])
    return out


@dataclass
class PenalisedCV:
    """Cross-validated paths: fold scores, their summary, the best and the simplest within one standard error."""

    features: list[str]
    mixtures: list[float]
    parts: dict[int, Sums] = field(repr=False)
    fold_scores: DataFrame
    summary: DataFrame
    metric: str

    def best(self) -> DataFrame:
        return show_best(self.summary, self.metric, 1, ["mixture", "penalty"])

    def one_std_err(self) -> DataFrame:
        """The largest penalty (then the largest mixture) whose mean is within one standard error of the best."""
        return select_by_one_std_err(self.summary, self.metric, [F.desc("penalty"), F.desc("mixture")], ["mixture", "penalty"])

    def coefficients(self, penalty: float, mixture: float) -> np.ndarray:
        """Intercept and slopes of all rows at one point (no further scan)."""
        s = total(self.parts)
        return Standard.of(s).own_units(path(s, [penalty], mixture)[float(penalty)])

    def final(self, choice: DataFrame) -> DataFrame:
        """(penalty, mixture, term, estimate) of the rows of ``choice`` (such as ``best()``), fitted to all folds."""
        rows = [(r["penalty"], r["mixture"]) for r in choice.select("penalty", "mixture").collect()]
        terms = ["(Intercept)", *self.features]
        out = [(p, m, t, float(b)) for p, m in rows for t, b in zip(terms, self.coefficients(p, m))]
        return choice.sparkSession.createDataFrame(out, "penalty double, mixture double, term string, estimate double")


def penalised_cv(df: DataFrame, fold: str, y: str, features: Sequence[str], penalties: Sequence[float] | None = None,
                 mixtures: Sequence[float] = (1.0,), metric: str = "rmse") -> PenalisedCV:
    """LASSO (mixture 1), ridge (0) or elastic-net paths of all folds from one aggregation, with their cross-validated errors.

    Without ``penalties`` each mixture gets the ``penalty_path`` of all rows.
    ``best()``, ``one_std_err()`` and ``final()`` answer from the same sums.
    """
    parts = sums_by_fold(df, fold, y, features)
    if len(parts) < 2:
        raise ValueError("cross-validation needs rows in two folds or more")
    every = total(parts)
    rows = []
    for a in mixtures:
        grid = penalty_path(every, a) if penalties is None else penalties
        for f, held in sorted(parts.items()):
            train = every.less(held)
            m = Standard.of(train)
            for lam, b in path(train, grid, a).items():
                rows += [(float(a), lam, f, k, v) for k, v in held_out(held, m.own_units(b)).items()]
    spark = df.sparkSession
    scores = spark.createDataFrame(rows, "mixture double, penalty double, fold int, metric string, estimate double")
    return PenalisedCV(list(features), [float(a) for a in mixtures], parts, scores, collect_metrics(scores, ["mixture", "penalty"]), metric)


def coefficient_path(df: DataFrame, y: str, features: Sequence[str], penalties: Sequence[float] | None = None,
                     mixtures: Sequence[float] = (1.0,)) -> DataFrame:
    """(mixture, penalty, term, estimate, n_zero) along the path; one scan of the data."""
    return path_rows(df.sparkSession, total(sums_by_fold(df.withColumn("_all", F.lit(1)), "_all", y, features)), features, penalties, mixtures)


def path_rows(spark: SparkSession, s: Sums, features: Sequence[str], penalties: Sequence[float] | None, mixtures: Sequence[float]) -> DataFrame:
    m, terms, out = Standard.of(s), ["(Intercept)", *features], []
    for a in mixtures:
        for lam, b in path(s, penalty_path(s, a) if penalties is None else penalties, a).items():
            zero = int((b == 0).sum())
            out += [(float(a), lam, t, float(v), zero) for t, v in zip(terms, m.own_units(b))]
    return spark.createDataFrame(out, "mixture double, penalty double, term string, estimate double, n_zero int")


def compare_penalised(df: DataFrame, y: str, features: Sequence[str], models: dict[str, tuple[float, float]]) -> DataFrame:
    """(term, one column per model) for models {name: (penalty, mixture)}, side by side from one scan."""
    s = total(sums_by_fold(df.withColumn("_all", F.lit(1)), "_all", y, features))
    m = Standard.of(s)
    fits = {name: m.own_units(path(s, [lam], a)[float(lam)]) for name, (lam, a) in models.items()}
    terms = ["(Intercept)", *features]
    rows = [(t, *(float(b[k]) for b in fits.values())) for k, t in enumerate(terms)]
    return df.sparkSession.createDataFrame(rows, ", ".join(["term string", *(f"`{n}` double" for n in fits)]))
