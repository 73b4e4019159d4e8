"""Group-fairness audit over a predictions table.

Every audit reduces to per-group confusion counters (one aggregation with
map-side partial sums) plus joins against tables whose size is bounded by
groups x thresholds.  Thresholds sweeps never replicate rows: each row is
assigned to the interval between consecutive cutoffs it falls in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faro.functions.core import col, safe_div
from faro.operators import metrics as M
from faro.operators.isotonic import calibrate_by_group  # noqa: F401
from faro.operators.ranking import quantiles

RATE_METRICS = ["accuracy", "tpr", "tnr", "ppv", "npv", "fpr", "fnr", "stp"]


def _rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    tp, fp, fn, tn = (c.cast("double") for c in (tp, fp, fn, tn))
    return {
        "accuracy": safe_div(tp + tn, tp + fp + fn + tn),
        "tpr": safe_div(tp, tp + fn), "tnr": safe_div(tn, tn + fp),
        "ppv": safe_div(tp, tp + fp), "npv": safe_div(tn, tn + fn),
        "fpr": safe_div(fp, fp + tn), "fnr": safe_div(fn, fn + tp),
        "stp": safe_div(tp + fp, tp + fp + fn + tn),
    }


def group_metrics(df: DataFrame, truth: str, pred: str, group: str, event=1) -> DataFrame:
    """n, accuracy, TPR, TNR, PPV, NPV, FPR, FNR and statistical parity (positive rate) per group."""
    c = M.binary_counts(df, truth, pred, event, [group])
    r = _rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    n = (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n")
    return c.select(group, n, *[v.alias(k) for k, v in r.items()])


def fairness_check(df: DataFrame, truth: str, pred: str, group: str, privileged: str, event=1,
                   metrics: Sequence[str] = ("accuracy", "ppv", "fpr", "tpr", "stp"),
                   lo: float = 0.8, hi: float = 1.25) -> DataFrame:
    """Ratio of each metric to the privileged group's value, flagged outside [lo, hi]."""
    gm = group_metrics(df, truth, pred, group, event)
    priv = gm.filter(F.col(group) == F.lit(privileged)).select(*[F.col(m).alias(f"_p_{m}") for m in metrics])
    j = gm.crossJoin(F.broadcast(priv))  # one row
    long = j.select(group, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"), safe_div(F.col(m), F.col(f"_p_{m}")).alias("ratio"))
        for m in metrics])).alias("s")).select(group, "s.*")
    return long.withColumn("passes", four_fifths(F.col("ratio"), lo, hi))


def four_fifths(ratio: Column, lo: float = 0.8, hi: float = 1.25) -> Column:
    """True when the ratio lies inside [lo, hi] (80% rule), NULL when undefined."""
    return ratio.between(lo, hi)


def parity_gaps(df: DataFrame, truth: str, pred: str, group: str, event=1) -> DataFrame:
    """Max-min across groups: demographic parity (STP), equal opportunity (TPR),
    equalized odds (max of TPR and FPR gaps), predictive parity (PPV)."""
    gm = group_metrics(df, truth, pred, group, event)
    g = gm.agg(*[(F.max(m) - F.min(m)).alias(f"{m}_gap") for m in ("stp", "tpr", "fpr", "ppv")])
    return g.select(F.col("stp_gap").alias("demographic_parity"), F.col("tpr_gap").alias("equal_opportunity"),
                    F.greatest("tpr_gap", "fpr_gap").alias("equalized_odds"), F.col("ppv_gap").alias("predictive_parity"))


def calibration_by_group(df: DataFrame, truth: str, score: str, group: str, bins: int = 10, event=1) -> DataFrame:
    """Observed event rate vs mean score per score bin and group (bin = floor(p * B), top bin closed)."""
    b = F.least(F.floor(col(score).cast("double") * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(group, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(col(score).cast("double")).alias("mean_score"),
        F.avg((col(truth) == F.lit(event)).cast("double")).alias("observed_rate"))


def base_rates(df: DataFrame, truth: str, pred: str, group: str, event=1) -> DataFrame:
    """Base rate with FPR, FNR and PPV per group -- the quantities the impossibility theorem trades off."""
    gm = group_metrics(df, truth, pred, group, event)
    br = df.groupBy(group).agg(F.avg((col(truth) == F.lit(event)).cast("double")).alias("base_rate"))
    return br.join(gm.select(group, "fpr", "fnr", "ppv"), group)


def group_threshold_sweep(df: DataFrame, truth: str, score: str, group: str, thresholds: Sequence[float],
                          event=1) -> DataFrame:
    """Accuracy, TPR and FPR per group x cutoff (positive when score >= cutoff)."""
    s = M.threshold_sweep(df, truth, score, event, thresholds, by=[group])
    return s.select(group, "threshold", "accuracy", F.col("recall").alias("tpr"), "fpr")


def match_fpr(df: DataFrame, truth: str, score: str, group: str, reference: str, thresholds: Sequence[float],
              base_cutoff: float = 0.5, event=1) -> DataFrame:
    """Per group, the cutoff whose FPR is nearest the reference group's FPR at ``base_cutoff``.

    Ties on distance go to the smaller cutoff.
    """
    sw = group_threshold_sweep(df, truth, score, group, sorted(set(list(thresholds) + [base_cutoff])), event)
    target = sw.filter((F.col(group) == F.lit(reference)) & (F.col("threshold") == F.lit(float(base_cutoff)))) \
               .select(F.col("fpr").alias("target_fpr"))
    j = sw.filter(F.col("threshold").isin([float(t) for t in thresholds])).crossJoin(F.broadcast(target))
    best = j.groupBy(group, "target_fpr").agg(
        F.min(F.struct(F.abs(F.col("fpr") - F.col("target_fpr")).alias("d"), F.col("threshold").alias("t"),
                       F.col("fpr").alias("f"))).alias("b"))
    return best.select(group, F.col("b.t").alias("cutoff"), F.col("b.f").alias("fpr"), "target_fpr")


def apply_group_thresholds(df: DataFrame, score: str, group: str, cutoffs: Mapping[str, float] | DataFrame,
                           default: float = 0.5, out: str = "pred_adj") -> DataFrame:
    """Prediction with a per-group cutoff (literal map or a (group, cutoff) table)."""
    if isinstance(cutoffs, Mapping):
        cut = None
        for g, c in cutoffs.items():
            cut = F.when(col(group) == F.lit(g), F.lit(float(c))) if cut is None else cut.when(col(group) == F.lit(g), F.lit(float(c)))
        cut = cut.otherwise(F.lit(default)) if cut is not None else F.lit(default)
        return df.withColumn(out, (col(score).cast("double") >= cut).cast("int"))
    j = df.join(F.broadcast(cutoffs.select(group, F.col("cutoff").alias("_cut"))), group, "left")
    return j.withColumn(out, (col(score).cast("double") >= F.coalesce("_cut", F.lit(default))).cast("int")).drop("_cut")


def mitigation_report(df: DataFrame, truth: str, pred: str, pred_adj: str, group: str, event=1) -> DataFrame:
    """FPR and accuracy per group, original vs mitigated predictions."""
    a = group_metrics(df, truth, pred, group, event).select(group, F.col("fpr").alias("fpr_original"),
                                                             F.col("accuracy").alias("accuracy_original"))
    b = group_metrics(df, truth, pred_adj, group, event).select(group, F.col("fpr").alias("fpr_mitigated"),
                                                                 F.col("accuracy").alias("accuracy_mitigated"))
    return a.join(b, group)


def threshold_policy(df: DataFrame, truth: str, score: str, group: str, kind: str, rate: float = 0.5,
                     event=1) -> DataFrame:
    """Per-group cutoffs for three lending policies.

    * ``same``: one cutoff ``rate`` for everyone,
    * ``equal_approval``: cutoff = (1 - rate) quantile of each group's scores,
    * ``equal_fnr``: cutoff = (1 - rate) quantile of each group's *positive* scores
      (equal true-positive rate).
    """
    groups = df.select(group).distinct()
    if kind == "same":
        return groups.withColumn("cutoff", F.lit(float(rate)))
    src = df if kind == "equal_approval" else df.filter(col(truth) == F.lit(event))
    if kind not in ("equal_approval", "equal_fnr"):
        raise ValueError(kind)
    q = quantiles(src, score, [1.0 - rate], [group])
    return q.select(group, F.col("quantile").alias("cutoff"))


def reweigh(df: DataFrame, truth: str, group: str) -> DataFrame:
    """Kamiran-Calders weights w = P(g) P(y) / P(g, y), attached to every row.

    Marginals come from three small aggregations joined back (groups x classes rows).
    """
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    g = df.groupBy(group).agg(F.count(F.lit(1)).alias("_ng"))
    y = df.groupBy(truth).agg(F.count(F.lit(1)).alias("_ny"))
    gy = df.groupBy(group, truth).agg(F.count(F.lit(1)).alias("_ngy"))
    w = (gy.join(g, group).join(y, truth).crossJoin(n)
         .select(group, truth, (F.col("_ng").cast("double") * F.col("_ny") / (F.col("_n").cast("double") * F.col("_ngy"))).alias("weight")))
    return df.join(F.broadcast(w), [group, truth], "left")


def reject_option(df: DataFrame, truth: str, score: str, group: str, margin: float = 0.1, cutoff: float = 0.5,
                  event=1) -> DataFrame:
    """Abstain when |score - cutoff| < margin; coverage and accuracy on decided rows per group."""
    s = col(score).cast("double")
    decided = F.abs(s - cutoff) >= margin
    correct = ((s >= cutoff) == (col(truth) == F.lit(event)))
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(decided.cast("double")).alias("coverage"),
        safe_div(F.count_if(decided & correct), F.count_if(decided)).alias("accuracy_decided"))


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cramér's V between two categorical columns.

    chi^2 over all cells = sum over observed cells of (o - e)^2 / e plus,
    for the empty cells, the sum of their expected counts, which equals
    n - (sum of e over observed cells).  So only observed cells are visited.
    """
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    ca = df.groupBy(a).agg(F.count(F.lit(1)).alias("_na"))
    cb = df.groupBy(b).agg(F.count(F.lit(1)).alias("_nb"))
    cab = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("_nab"))
    k = ca.agg(F.count(F.lit(1)).alias("ka")).crossJoin(cb.agg(F.count(F.lit(1)).alias("kb")))  # one row x one row
    cells = cab.join(ca, a).join(cb, b).crossJoin(F.broadcast(n))  # attach the scalar n
    e = F.col("_na").cast("double") * F.col("_nb") / F.col("_n")
    o = F.col("_nab").cast("double")
    obs = cells.agg(F.sum((o - e) * (o - e) / e).alias("_chi_obs"), F.sum(e).alias("_e_obs"), F.first("_n").alias("n"))
    chi = obs.crossJoin(k).withColumn("chi2", F.col("_chi_obs") + (F.col("n") - F.col("_e_obs")))
    return chi.select("chi2", F.sqrt(safe_div(F.col("chi2"), F.col("n") * (F.least("ka", "kb") - 1))).alias("cramers_v"))


def proxy_scan(df: DataFrame, protected: str, categorical: Sequence[str] = (), numeric: Sequence[str] = ()) -> DataFrame:
    """Association of each predictor with the protected attribute.

    Categorical: Cramér's V.  Numeric: correlation ratio eta = sqrt(SS_between / SS_total).
    """
    parts = []
    for c in categorical:
        parts.append(cramers_v(df, protected, c).select(F.lit(c).alias("variable"), F.lit("cramers_v").alias("measure"),
                                                         F.col("cramers_v").alias("association")))
    for c in numeric:
        x = col(c).cast("double")
        g = df.groupBy(protected).agg(F.count(x).alias("_ng"), F.avg(x).alias("_mg"))
        tot = df.agg(F.avg(x).alias("_m"), (F.var_pop(x) * F.count(x)).alias("_sst"))
        eta = g.crossJoin(tot).agg(F.sqrt(safe_div(F.sum(F.col("_ng") * (F.col("_mg") - F.col("_m")) ** 2), F.first("_sst"))).alias("a"))
        parts.append(eta.select(F.lit(c).alias("variable"), F.lit("eta").alias("measure"), F.col("a").alias("association")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def representation(df: DataFrame, group: str, reference_shares: Mapping[str, float], truth: str | None = None,
                   pred: str | None = None) -> DataFrame:
    """Group share in the data vs a reference population share, with the error rate per group."""
    spark = df.sparkSession
    ref = spark.createDataFrame([(k, float(v)) for k, v in reference_shares.items()], f"{group} string, reference_share double")
    c = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"),
                              *([F.avg((col(truth) != col(pred)).cast("double")).alias("error_rate")] if truth and pred else []))
    c = c.crossJoin(c.agg(F.sum("n").alias("_t"))).withColumn("share", safe_div(F.col("n"), F.col("_t"))).drop("_t")
    return c.join(F.broadcast(ref), group, "full").withColumn("share_gap", F.col("share") - F.col("reference_share"))
