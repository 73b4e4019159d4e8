"""Resampled evaluation, tuning grids and model selection.

Fits are orchestrated from the driver (one Spark job graph per fold x
config), with the analysis/assessment frames derived from one ``fold``
column on a cached table; every recipe is re-prepped inside its fold, so
no statistic leaks from the assessment rows.  Summaries (mean, n, std_err,
best, one-SE) are aggregations over the small fold-score table.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faro.functions.core import hash_unit


def grid_regular(spark, params: Mapping[str, tuple], levels: int | Mapping[str, int] = 3) -> DataFrame:
    """Cartesian grid.  A param given as ("log10", lo, hi) spans 10^lo..10^hi on a log scale;
    ("int", lo, hi) or ("num", lo, hi) span linearly; a list is taken as is."""
    axes = {}
    for name, spec in params.items():
        lv = levels[name] if isinstance(levels, Mapping) else levels
        if isinstance(spec, (list, tuple)) and spec and spec[0] in ("log10", "num", "int"):
            kind, lo, hi = spec
            pts = [lo + (hi - lo) * i / (lv - 1) for i in range(lv)] if lv > 1 else [lo]
            axes[name] = [10 ** x for x in pts] if kind == "log10" else ([int(round(x)) for x in pts] if kind == "int" else pts)
        else:
            axes[name] = list(spec)
    names = list(axes)
    rows = list(itertools.product(*[axes[n] for n in names]))
    return spark.createDataFrame([tuple(float(v) if isinstance(v, float) else v for v in r) for r in rows], names)


def grid_random(spark, params: Mapping[str, tuple], size: int, seed: int = 42) -> DataFrame:
    """``size`` random points; uniforms come from md5(seed:i:param) so the grid is reproducible."""
    base = spark.range(1, size + 1).withColumnRenamed("id", "config")
    cols = []
    for name, (kind, lo, hi) in params.items():
        u = hash_unit(seed, F.col("config"), F.lit(name))
        x = F.lit(lo) + (F.lit(hi) - F.lit(lo)) * u
        cols.append((F.pow(F.lit(10.0), x) if kind == "log10" else (F.round(x).cast("int") if kind == "int" else x)).alias(name))
    return base.select("config", *cols)


def collect_metrics(fold_scores: DataFrame, config: Sequence[str], metric: str = "metric", estimate: str = "estimate") -> DataFrame:
    """mean, n and std_err = sd / sqrt(n) of each metric per configuration."""
    return fold_scores.groupBy(*config, metric).agg(
        F.avg(estimate).alias("mean"), F.count(estimate).alias("n"),
        (F.stddev_samp(estimate) / F.sqrt(F.count(estimate))).alias("std_err"))


_HIGHER_BETTER = {"accuracy", "roc_auc", "rsq", "rsq_trad", "f_meas", "precision", "recall", "kap", "sens", "spec",
                  "ppv", "npv", "mcc", "j_index", "bal_accuracy"}
_LOWER_BETTER = {"rmse", "mae", "mape", "mse", "mn_log_loss", "brier"}


def higher_is_better(metric: str) -> bool:
    """Direction of a metric; an unknown one is an error, not a guess."""
    if metric in _HIGHER_BETTER:
        return True
    if metric in _LOWER_BETTER:
        return False
    raise ValueError(f"unknown direction of metric {metric!r}")


def show_best(summary: DataFrame, metric: str, n: int = 5, config: Sequence[str] = ()) -> DataFrame:
    """Top-n configurations for one metric (direction by metric name; ties by config)."""
    s = summary.filter(F.col("metric") == metric)
    o = F.desc("mean") if higher_is_better(metric) else F.asc("mean")
    return s.orderBy(o, *config).limit(n)


def select_by_one_std_err(summary: DataFrame, metric: str, simplicity: Sequence, config: Sequence[str]) -> DataFrame:
    """Simplest configuration whose mean is within one standard error of the best.

    ``simplicity``: order columns, simplest first (e.g. ``F.desc("penalty")``).
    """
    s = summary.filter(F.col("metric") == metric)
    hi = higher_is_better(metric)
    best = s.orderBy(F.desc("mean") if hi else F.asc("mean"), *config).limit(1) \
            .select((F.col("mean") - F.col("std_err")).alias("_lo") if hi else (F.col("mean") + F.col("std_err")).alias("_hi"))
    j = s.crossJoin(F.broadcast(best))
    ok = (F.col("mean") >= F.col("_lo")) if hi else (F.col("mean") <= F.col("_hi"))
    return j.filter(ok).orderBy(*simplicity).limit(1).drop("_lo", "_hi")


def fit_resamples(data: DataFrame, fold: str, n_folds: int, fit_score: Callable[[DataFrame, DataFrame], list[tuple[str, float]]],
                  threads: int = 4) -> list[tuple[int, str, float]]:
    """Run ``fit_score(analysis, assessment) -> [(metric, value)]`` for each fold.

    Folds run concurrently from a driver thread pool (each is its own set of
    Spark jobs); the input should be cached by the caller.
    """
    def one(f):
        a = data.filter(F.col(fold) != f)
        b = data.filter(F.col(fold) == f)
        return [(f, m, float(v) if v is not None else None) for m, v in fit_score(a, b)]

    with ThreadPoolExecutor(max_workers=threads) as ex:
        res = list(ex.map(one, range(1, n_folds + 1)))
    return [r for part in res for r in part]


def tune_grid(data: DataFrame, fold: str, n_folds: int, grid: list[dict],
              fit_score: Callable[[dict, DataFrame, DataFrame], list[tuple[str, float]]], threads: int = 4) -> list[tuple]:
    """``fit_resamples`` over every grid point: rows (config_index, fold, metric, value)."""
    jobs = [(ci, f) for ci in range(len(grid)) for f in range(1, n_folds + 1)]

    def one(job):
        ci, f = job
        a = data.filter(F.col(fold) != f)
        b = data.filter(F.col(fold) == f)
        return [(ci, f, m, float(v) if v is not None else None) for m, v in fit_score(grid[ci], a, b)]

    with ThreadPoolExecutor(max_workers=threads) as ex:
        res = list(ex.map(one, jobs))
    return [r for part in res for r in part]


def std_err(values: Sequence[float]) -> float:
    v = [x for x in values if x is not None]
    if len(v) < 2:
        return float("nan")
    m = sum(v) / len(v)
    return math.sqrt(sum((x - m) ** 2 for x in v) / (len(v) - 1)) / math.sqrt(len(v))



