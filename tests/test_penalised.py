"""Penalised paths from cross products: KKT conditions on the rows, refits per fold, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from faro.operators import penalised as P


def table(spark, n=400, p=5, seed=0, constant=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)) @ (np.eye(p) + 0.4 * rng.normal(size=(p, p))) * np.arange(1, p + 1) + 3
    if constant:
        x[:, 1] = 7.0
    y = 3 + 2 * x[:, 0] - x[:, 2] + rng.normal(size=n)
    names = [f"x{j}" for j in range(p)]
    rows = [(k, k % 4 + 1, float(y[k]), *map(float, x[k])) for k in range(n)]
    return spark.createDataFrame(rows, ["id", "fold", "y", *names]), x, y, names


def kkt(x, y, beta, lam, a):
    """Largest KKT violation on the rows, for slopes of standardised predictors."""
    sd = x.std(axis=0)
    keep = sd > 0
    z = (x[:, keep] - x[:, keep].mean(axis=0)) / sd[keep]
    b = beta[1:][keep] * sd[keep]
    r = y - y.mean() - z @ b
    g = z.T @ r / len(y) - lam * (1 - a) * b
    return max(abs(gj - lam * a * np.sign(bj)) if bj else max(abs(gj) - lam * a, 0) for gj, bj in zip(g, b))


@pytest.mark.parametrize("mixture", [0.0, 0.3, 1.0])
def test_path_meets_the_kkt_conditions_of_the_rows(spark, mixture):
    df, x, y, names = table(spark)
    rows = P.coefficient_path(df, "y", names, mixtures=[mixture]).collect()
    lams = sorted({r["penalty"] for r in rows})
    assert len(lams) == 50
    zero = []
    for lam in lams:
        beta = np.array([next(r["estimate"] for r in rows if r["penalty"] == lam and r["term"] == t) for t in ["(Intercept)", *names]])
        assert kkt(x, y, beta, lam, mixture) < 1e-8
        assert abs(y.mean() - beta[0] - x.mean(axis=0) @ beta[1:]) < 1e-9
        zero.append(next(r["n_zero"] for r in rows if r["penalty"] == lam))
    if mixture == 1.0:
        assert zero[-1] == len(names) and zero[0] == 0


def test_fold_errors_equal_refits_without_the_fold(spark):
    df, x, y, names = table(spark, seed=1)
    cv = P.penalised_cv(df, "fold", "y", names, [0.05, 0.4], [0.5, 1.0])
    got = {(r["mixture"], r["penalty"], r["fold"], r["metric"]): r["estimate"] for r in cv.fold_scores.collect()}
    fold = np.arange(len(y)) % 4 + 1
    for f in range(1, 5):
        tr, te = fold != f, fold == f
        only = P.coefficient_path(df.filter(F.col("fold") != f), "y", names, [0.05, 0.4], [0.5, 1.0]).collect()
        for a in (0.5, 1.0):
            for lam in (0.05, 0.4):
                beta = np.array([next(r["estimate"] for r in only if (r["mixture"], r["penalty"], r["term"]) == (a, lam, t)) for t in ["(Intercept)", *names]])
                assert kkt(x[tr], y[tr], beta, lam, a) < 1e-8
                fit = beta[0] + x[te] @ beta[1:]
                assert abs(got[(a, lam, f, "rmse")] - np.sqrt(((y[te] - fit) ** 2).mean())) < 1e-9
                assert abs(got[(a, lam, f, "rsq")] - np.corrcoef(fit, y[te])[0, 1] ** 2) < 1e-9
                assert abs(got[(a, lam, f, "rsq_trad")] - (1 - ((y[te] - fit) ** 2).sum() / ((y[te] - y[te].mean()) ** 2).sum())) < 1e-9


def test_choices_and_final_coefficients(spark):
    df, x, y, names = table(spark, seed=2)
    cv = P.penalised_cv(df, "fold", "y", names, mixtures=[1.0])
    best, simple = cv.best().first(), cv.one_std_err().first()
    s = {r["penalty"]: r for r in cv.summary.filter("metric = 'rmse'").collect()}
    assert best["mean"] == min(r["mean"] for r in s.values())
    assert simple["penalty"] == max(p for p, r in s.items() if r["mean"] <= best["mean"] + best["std_err"]) >= best["penalty"]
    final = {r["term"]: r["estimate"] for r in cv.final(cv.one_std_err()).collect()}
    beta = np.array([final[t] for t in ["(Intercept)", *names]])
    assert kkt(x, y, beta, simple["penalty"], 1.0) < 1e-8 and final["x0"] > 0 > final["x2"]


def test_constant_predictors_missing_rows_and_no_penalty(spark):
    df, x, y, names = table(spark, constant=True)
    rows = {r["term"]: r for r in P.coefficient_path(df, "y", names, [0.0], [1.0]).collect()}
    a = np.column_stack([np.ones(len(y)), np.delete(x, 1, axis=1)])
    ols = np.linalg.lstsq(a, y, rcond=None)[0]
    assert rows["x1"]["estimate"] == 0 and abs(rows["x4"]["estimate"] - ols[-1]) < 1e-8
    gaps = df.withColumn("x0", F.when(F.col("id") % 10 != 0, F.col("x0")))
    keep = np.arange(len(y)) % 10 != 0
    part = {r["term"]: r["estimate"] for r in P.coefficient_path(gaps, "y", names, [0.2], [1.0]).collect()}
    assert kkt(x[keep], y[keep], np.array([part[t] for t in ["(Intercept)", *names]]), 0.2, 1.0) < 1e-8
    with pytest.raises(ValueError):
        P.penalised_cv(df.filter("fold = 1"), "fold", "y", names, [0.1])
    twin = df.withColumn("x9", F.col("x0"))
    both = {r["term"]: r["estimate"] for r in P.coefficient_path(twin, "y", [*names, "x9"], [0.3], [0.5]).collect()}
    assert abs(both["x0"] - both["x9"]) < 1e-6                       # the ridge part shares between equal predictors
