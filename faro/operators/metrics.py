"""Evaluation metrics over a predictions table (truth, estimate, score, ...).

All metrics are aggregations: partial aggregation runs map-side and only a
handful of counters per group are shuffled.  Curves (ROC) aggregate by
distinct score first and use two-level running sums (``ranking``), never a
single-partition window.  0/0 yields NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faro.functions.core import col, safe_div
from faro.operators.ranking import running_sums

# yardstick-style clamp for log loss: probabilities kept in [eps, 1 - eps]
LOG_LOSS_EPS = 2.0 ** -52


def binary_counts(df: DataFrame, truth: str, estimate: str, event, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn (bigint) per group for one event level."""
    t, e = col(truth) == F.lit(event), col(estimate) == F.lit(event)
    return df.groupBy(*by).agg(
        F.count_if(t & e).alias("tp"),
        F.count_if(~t & e).alias("fp"),
        F.count_if(t & ~e).alias("fn"),
        F.count_if(~t & ~e).alias("tn"),
    )


def conf_mat(df: DataFrame, truth: str, estimate: str, levels: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """Confusion matrix in long form (truth, prediction, n) with zero cells kept.

    The level grid is a literal of len(levels)^2 rows (bounded by the
    declared levels); it is crossed with the distinct groups and left-joined
    to the counts.
    """
    spark = df.sparkSession
    tdt, edt = df.schema[truth].dataType, df.schema[estimate].dataType
    grid = (spark.createDataFrame([(a, b) for a in levels for b in levels], ["truth", "prediction"])
            .select(F.col("truth").cast(tdt), F.col("prediction").cast(edt)))
    counts = (df.groupBy(*by, F.col(truth).alias("truth"), F.col(estimate).alias("prediction"))
              .agg(F.count(F.lit(1)).alias("n")))
    if by:
        groups = df.select(*by).distinct()
        grid = groups.crossJoin(F.broadcast(grid))
    else:
        grid = F.broadcast(grid)
    return (grid.join(counts, [*by, "truth", "prediction"], "left")
            .select(*by, "truth", "prediction", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def class_metrics(df: DataFrame, truth: str, estimate: str, event, by: Sequence[str] = ()) -> DataFrame:
    """Wide binary summary: the ``summary(conf_mat)`` set for one event level."""
    c = binary_counts(df, truth, estimate, event, by)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    sens = safe_div(tp, tp + fn)
    spec = safe_div(tn, tn + fp)
    ppv = safe_div(tp, tp + fp)
    npv = safe_div(tn, tn + fn)
    acc = safe_div(tp + tn, n)
    p_e = safe_div((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn), n * n)
    kappa = safe_div(acc - p_e, F.lit(1.0) - p_e)
    mcc = safe_div(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)))
    f1 = safe_div(2 * ppv * sens, ppv + sens)
    return c.select(
        *by,
        acc.alias("accuracy"), kappa.alias("kap"), sens.alias("sens"), spec.alias("spec"),
        ppv.alias("ppv"), npv.alias("npv"), mcc.alias("mcc"), (sens + spec - 1).alias("j_index"),
        ((sens + spec) / 2).alias("bal_accuracy"), safe_div(tp + fp, n).alias("detection_prevalence"),
        ppv.alias("precision"), sens.alias("recall"), f1.alias("f_meas"),
    )


SUMMARY_METRICS = ["accuracy", "kap", "sens", "spec", "ppv", "npv", "mcc", "j_index", "bal_accuracy",
                   "detection_prevalence", "precision", "recall", "f_meas"]


def to_long(df: DataFrame, metrics: Sequence[str], by: Sequence[str] = (), name: str = "metric",
            value: str = "estimate") -> DataFrame:
    """Wide metric columns -> (by..., metric, estimate) rows (NULLs kept)."""
    return df.unpivot(list(by), [F.col(m).cast("double").alias(m) for m in metrics], name, value)


def accuracy(df: DataFrame, truth: str, estimate: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.avg((col(truth) == col(estimate)).cast("double")).alias("accuracy"),
        F.avg((col(truth) != col(estimate)).cast("double")).alias("error_rate"),
    )


def kappa(df: DataFrame, truth: str, estimate: str, by: Sequence[str] = ()) -> DataFrame:
    """Multiclass Cohen's kappa: (p_o - p_e) / (1 - p_e)."""
    n = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.count_if(col(truth) == col(estimate)).alias("_agree"))
    rows = df.groupBy(*by, col(truth).alias("_lvl")).agg(F.count(F.lit(1)).alias("_r"))
    cols_ = df.groupBy(*by, col(estimate).alias("_lvl")).agg(F.count(F.lit(1)).alias("_c"))
    exp = (rows.join(cols_, [*by, "_lvl"], "inner").groupBy(*by)
           .agg(F.sum(F.col("_r").cast("double") * F.col("_c")).alias("_rc")))
    j = n.join(exp, list(by), "left") if by else n.crossJoin(exp)
    p_o = safe_div(F.col("_agree"), F.col("_n"))
    p_e = safe_div(F.coalesce(F.col("_rc"), F.lit(0.0)), F.col("_n").cast("double") * F.col("_n"))
    return j.select(*by, safe_div(p_o - p_e, F.lit(1.0) - p_e).alias("kap"))


def mn_log_loss(df: DataFrame, truth: str, prob_event: str, event, by: Sequence[str] = ()) -> DataFrame:
    """Mean binary log loss from the event probability, p clamped to [eps, 1-eps]."""
    p = F.least(F.greatest(col(prob_event).cast("double"), F.lit(LOG_LOSS_EPS)), F.lit(1.0 - LOG_LOSS_EPS))
    p_true = F.when(col(truth) == F.lit(event), p).otherwise(F.lit(1.0) - p)
    return df.groupBy(*by).agg((-F.avg(F.ln(p_true))).alias("mn_log_loss"))


def multinomial_log_loss(df: DataFrame, truth: str, probs: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Mean log loss over any number of classes; ``probs`` maps each level of ``truth`` to its probability column.

    Probabilities are clamped to [eps, 1-eps]; a row whose truth is NULL or no
    listed level does not count.
    """
    p_true = F.coalesce(*[F.when(col(truth) == F.lit(lv), col(c).cast("double")) for lv, c in probs.items()])
    p = F.least(F.greatest(p_true, F.lit(LOG_LOSS_EPS)), F.lit(1.0 - LOG_LOSS_EPS))
    return df.groupBy(*by).agg((-F.avg(F.ln(F.when(p_true.isNotNull(), p)))).alias("mn_log_loss"))


def _score_counts(df: DataFrame, truth: str, score: str, event, by: Sequence[str]) -> DataFrame:
    return (df.groupBy(*by, col(score).cast("double").alias("threshold"))
            .agg(F.count_if(col(truth) == F.lit(event)).alias("pos"),
                 F.count_if(col(truth) != F.lit(event)).alias("neg")))


def roc_curve(df: DataFrame, truth: str, score: str, event, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, specificity, sensitivity) with -inf / +inf end points.

    Predicted positive when score >= threshold.
    """
    by = list(by)
    sc = _score_counts(df, truth, score, event, by)
    cum = running_sums(sc, "threshold", ["pos", "neg"], by, descending=True)  # counts with score >= t
    tot = cum.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))  # reads the checkpointed counts
    j = cum.join(tot, by, "inner") if by else cum.crossJoin(tot)
    pts = j.select(*by, "threshold", safe_div(F.col("pos_cum"), F.col("P")).alias("sensitivity"),
                   (F.lit(1.0) - safe_div(F.col("neg_cum"), F.col("N"))).alias("specificity"))
    ends = tot.select(*by, F.lit(float("-inf")).alias("threshold"),
                      F.when(F.col("P") > 0, F.lit(1.0)).alias("sensitivity"),
                      F.when(F.col("N") > 0, F.lit(0.0)).alias("specificity"))
    ends2 = tot.select(*by, F.lit(float("inf")).alias("threshold"),
                       F.when(F.col("P") > 0, F.lit(0.0)).alias("sensitivity"),
                       F.when(F.col("N") > 0, F.lit(1.0)).alias("specificity"))
    return pts.unionByName(ends).unionByName(ends2).select(*by, "threshold", "specificity", "sensitivity")


def roc_auc(df: DataFrame, truth: str, score: str, event, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve; tied scores count one half (Mann-Whitney)."""
    by = list(by)
    sc = _score_counts(df, truth, score, event, by)
    cum = running_sums(sc, "threshold", ["neg"], by, inclusive=False)  # negatives strictly below
    return cum.groupBy(*by).agg(
        safe_div(F.sum(F.col("pos") * (F.col("neg_cum") + F.col("neg") * 0.5)),
                 F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))


def regression_metrics(df: DataFrame, truth: str, estimate: str, by: Sequence[str] = ()) -> DataFrame:
    """rmse, mae, mse, rsq (squared correlation) and rsq_trad (1 - SSres/SStot)."""
    y, yh = col(truth).cast("double"), col(estimate).cast("double")
    r = y - yh
    return df.groupBy(*by).agg(
        F.sqrt(F.avg(r * r)).alias("rmse"),
        F.avg(F.abs(r)).alias("mae"),
        F.avg(r * r).alias("mse"),
        # NULL where the estimate does not vary beyond rounding (``corr`` would divide by zero)
        F.when(F.var_pop(yh) > 1e-24 * F.avg(yh * yh), safe_div(F.pow(F.covar_pop(y, yh), 2), F.var_pop(y) * F.var_pop(yh))).alias("rsq"),
        (F.lit(1.0) - safe_div(F.sum(r * r), F.var_pop(y) * F.count(y))).alias("rsq_trad"),
    )


def threshold_sweep(df: DataFrame, truth: str, score: str, event, thresholds: Sequence[float],
                    by: Sequence[str] = (), inclusive: bool = True) -> DataFrame:
    """Confusion counts and precision/recall/F1/accuracy per cutoff.

    One pass: each row is assigned to the interval between consecutive
    thresholds it falls in (no N x T expansion); counts per interval are
    turned into per-threshold counts with a running sum over a table of at
    most (groups x T) rows.  ``inclusive``: positive when score >= t, else >.
    """
    by = list(by)
    thr = sorted(float(t) for t in thresholds)
    arr = F.array(*[F.lit(t) for t in thr])
    s = col(score).cast("double")
    # idx = number of thresholds the score clears; positive at threshold i (1-based) iff idx >= i
    cleared = F.filter(arr, lambda t: (t <= s) if inclusive else (t < s))
    idx = F.size(cleared)
    spark = df.sparkSession
    grid = spark.createDataFrame([(i + 1, t) for i, t in enumerate(thr)], "i int, threshold double")
    per = (df.groupBy(*by, idx.alias("idx"))
           .agg(F.count_if(col(truth) == F.lit(event)).alias("pos"),
                F.count_if(col(truth) != F.lit(event)).alias("neg")))
    groups = per.select(*by).distinct() if by else None
    g = groups.crossJoin(F.broadcast(grid)) if by else grid
    # pair each threshold with intervals at or above it (T x (T+1) per group at most)
    j = g.join(per, [*by], "inner") if by else g.crossJoin(per)
    agg = j.groupBy(*by, "threshold").agg(
        F.sum(F.when(F.col("idx") >= F.col("i"), F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("idx") >= F.col("i"), F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(F.col("idx") < F.col("i"), F.col("pos")).otherwise(0)).alias("fn"),
        F.sum(F.when(F.col("idx") < F.col("i"), F.col("neg")).otherwise(0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    prec = safe_div(tp, tp + fp)
    rec = safe_div(tp, tp + fn)
    return agg.select(*by, "threshold", F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
                      F.col("fn").cast("bigint").alias("fn"), F.col("tn").cast("bigint").alias("tn"),
                      prec.alias("precision"), rec.alias("recall"),
                      safe_div(2 * prec * rec, prec + rec).alias("f_meas"),
                      safe_div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                      safe_div(fp, fp + tn).alias("fpr"))


def uncertain(df: DataFrame, prob: str, margin: float = 0.1) -> DataFrame:
    """Rows whose probability is within ``margin`` of 0.5, most uncertain first."""
    d = F.abs(col(prob).cast("double") - 0.5)
    return df.filter(d < margin).withColumn("distance", d).orderBy("distance")


def metric_set(parts: dict[str, DataFrame]) -> DataFrame:
    """Stack per-model long metric tables (metric, estimate) with a model column."""
    out = None
    for name, d in parts.items():
        d = d.select(F.lit(name).alias("model"), *d.columns)
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def overfit_gap(scored: DataFrame, truth: str, estimate: str, split: str, by: Sequence[str] = ()) -> DataFrame:
    """Train vs test error per complexity setting (columns in ``by``)."""
    err = F.avg((col(truth) != col(estimate)).cast("double"))
    w = scored.groupBy(*by).pivot(split, ["train", "test"]).agg(err)
    return w.select(*by, F.col("train").alias("train_error"), F.col("test").alias("test_error"),
                    (F.col("test") - F.col("train")).alias("gap"))

