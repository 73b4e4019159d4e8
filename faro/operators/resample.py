"""Deterministic, partition-independent resampling.

Every draw is ordered by ``md5(seed:key)``, so a split or fold assignment is
a pure function of the key: identical under any partitioning, re-executable
after an executor loss, and reproducible in SQL.  Ranks inside strata use the
two-level ``hash_rank`` (no single-partition window, hot strata spread over
4096 hash buckets).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faro.functions.core import col, hash_unit, safe_div, stable_hash
from faro.operators.ranking import HASH_PREFIX_DIGITS, hash_rank, materialize


def _ranked(df: DataFrame, key: str | Sequence[str], strata: Sequence[str] | str | None, seed) -> tuple[DataFrame, list[str]]:
    keys = [key] if isinstance(key, str) else list(key)
    strata = [strata] if isinstance(strata, str) else list(strata or [])
    d = df.withColumn("_h", stable_hash(seed, *keys))
    return hash_rank(d, "_h", strata, keys, out="_rank", total="_n"), keys


def initial_split(df: DataFrame, key: str | Sequence[str], prop: float = 0.75, strata=None, seed: int = 42,
                  out: str = "split") -> DataFrame:
    """Add ``split`` = 'train' / 'test'; exactly floor(prop * n) training rows per stratum.

    The training rows of a stratum are those up to its cut, the hash at rank
    floor(prop * n), so no row is moved: the cuts are found from counts, and
    the rows compared with them.  Where a cut falls among rows of one hash
    (repeated keys), these rows alone are ranked, and written.
    """
    strata = [strata] if isinstance(strata, str) else list(strata or [])
    cuts = _cuts(df, key, strata, prop, seed)
    if cuts is None:
        d, _ = _ranked(df, key, strata, seed)
        cut = F.floor(F.col("_n") * F.lit(float(prop)))
        return d.withColumn(out, F.when(F.col("_rank") <= cut, "train").otherwise("test")).drop("_h", "_rank", "_n")
    cuts, divided = cuts
    h = stable_hash(seed, *_keys(key))
    d = df.join(F.broadcast(cuts), strata) if strata else df.crossJoin(F.broadcast(cuts))
    side = lambda train: F.when(train, "train").otherwise("test").alias(out)
    kept = [*strata, *[c for c in df.columns if c not in strata and c != out]]
    if not divided:
        return d.select(*kept, side(h <= F.col("_cut")))
    among = F.col("_part").isNotNull() & (h == F.col("_cut"))
    hashable = [c for c, t in df.dtypes if "map<" not in t]
    w = Window.partitionBy(*(strata or [F.lit(0)])).orderBy(*_keys(key), F.xxhash64(*hashable))
    ties = d.filter(among).withColumn("_place", F.row_number().over(w)).select(*kept, side(F.col("_place") <= F.col("_part")))
    return d.filter(~among).select(*kept, side(h <= F.col("_cut"))).unionByName(materialize(ties))


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


#: most strata whose cuts are broadcast; rows of more are ranked
MOST_STRATA = 10_000


def _cuts(df: DataFrame, key, strata: list[str], prop: float, seed) -> tuple[DataFrame, bool] | None:
    """(strata..., _cut, _part) and whether any ``_part`` is given; None for more than ``MOST_STRATA`` strata.

    ``_cut``: hash of the last training row ('' for none); ``_part``: training rows among those of that hash, where not all are.
    """
    h = df.select(*strata, stable_hash(seed, *_keys(key)).alias("_h")).withColumn("_bkt", F.substring("_h", 1, HASH_PREFIX_DIGITS))
    counts = materialize(h.groupBy(*strata, "_bkt").agg(F.count(F.lit(1)).alias("_nb")))
    most = counts.select(*strata).distinct().limit(MOST_STRATA + 1).count() if strata else 1
    if most > MOST_STRATA:
        return None
    w = Window.partitionBy(*strata) if strata else Window.partitionBy(F.lit(0))
    upto = counts.withColumn("_upto", F.sum("_nb").over(w.orderBy("_bkt"))).withColumn("_take", F.floor(F.sum("_nb").over(w) * F.lit(float(prop))))
    # the bucket that holds the last training row, and how many of its rows are training rows
    edge = upto.filter((F.col("_take") > F.col("_upto") - F.col("_nb")) & (F.col("_take") <= F.col("_upto"))) \
               .select(*strata, "_bkt", (F.col("_take") - F.col("_upto") + F.col("_nb")).alias("_r"))
    at = h.join(F.broadcast(edge), [*strata, "_bkt"]).groupBy(*strata, "_bkt", "_r", "_h").agg(F.count(F.lit(1)).alias("_c"))
    at = at.withColumn("_s", F.sum("_c").over(Window.partitionBy(*strata, "_bkt").orderBy("_h")))
    found = at.filter((F.col("_s") >= F.col("_r")) & (F.col("_s") - F.col("_c") < F.col("_r"))) \
              .select(*strata, F.col("_h").alias("_cut"), F.when(F.col("_s") > F.col("_r"), F.col("_r") - F.col("_s") + F.col("_c")).alias("_part"))
    if strata:
        cuts = counts.select(*strata).distinct().join(found, strata, "left")
    else:
        cuts = found.agg(F.max("_cut").alias("_cut"), F.max("_part").alias("_part"))
    cuts = materialize(cuts.withColumn("_cut", F.coalesce("_cut", F.lit(""))))
    return cuts, not cuts.filter("_part is not null").isEmpty()


def training(df: DataFrame, split: str = "split") -> DataFrame:
    return df.filter(F.col(split) == "train")


def testing(df: DataFrame, split: str = "split") -> DataFrame:
    return df.filter(F.col(split) == "test")


def vfold(df: DataFrame, key: str | Sequence[str], v: int = 5, strata=None, seed: int = 42,
          out: str = "fold") -> DataFrame:
    """Add ``fold`` in 1..v; folds balanced within each stratum, each row assessed once."""
    d, _ = _ranked(df, key, strata, seed)
    return d.withColumn(out, (((F.col("_rank") - 1) % v) + 1).cast("int")).drop("_h", "_rank", "_n")


def split_report(df: DataFrame, split: str, y: str) -> DataFrame:
    """Rows per split and class share within each split."""
    c = df.groupBy(split, y).agg(F.count(F.lit(1)).alias("n"))
    tot = df.groupBy(split).agg(F.count(F.lit(1)).alias("n_split"))
    return c.join(tot, split).select(split, y, "n", "n_split", safe_div(F.col("n"), F.col("n_split")).alias("prop"))


def leave_one_out(df: DataFrame, key: str) -> DataFrame:
    """Fold = row key (K = N).  Intended for bounded inputs; linear models
    should use the closed-form PRESS residuals instead of N refits."""
    return df.withColumn("fold", col(key))


def period_index(ts: str, unit: str = "month") -> "F.Column":
    """Calendar period number of a timestamp (months or days since epoch)."""
    if unit == "month":
        return (F.year(ts) * 12 + F.month(ts) - 1).cast("int")
    if unit == "week":
        return F.floor(F.datediff(F.to_date(ts), F.lit("1970-01-05")) / 7).cast("int")
    if unit == "day":
        return F.datediff(F.to_date(ts), F.lit("1970-01-01")).cast("int")
    raise ValueError(unit)


def time_folds(df: DataFrame, ts: str, initial: int, assess: int, step: int = 1, unit: str = "day",
               cumulative: bool = True) -> DataFrame:
    """Rolling-origin folds over calendar periods; never trains on the future.

    Returns the fold plan as a small table (fold, period, role) with one row
    per (fold, period) -- bounded by #periods x #folds, not by rows.  Join it
    to data on the period index to materialise fold membership.
    """
    p = period_index(ts, unit)
    rng = df.agg(F.min(p).alias("p0"), F.max(p).alias("p1"))
    # fold f: analysis ends before p0 + initial + (f-1)*step; assessment is the next `assess` periods
    n_folds = F.floor((F.col("p1") - F.col("p0") - initial - assess + 1) / step).cast("int") + 1
    plan = (rng.filter(n_folds >= 1)
            .select("p0", "p1", F.explode(F.sequence(F.lit(1), n_folds)).alias("fold"))
            .withColumn("a_end", F.col("p0") + initial + (F.col("fold") - 1) * step)
            .withColumn("a_start", F.col("p0") if cumulative else F.col("a_end") - initial))
    analysis = plan.select("fold", F.explode(F.sequence("a_start", F.col("a_end") - 1)).alias("period"),
                           F.lit("analysis").alias("role"))
    assessment = plan.select("fold", F.explode(F.sequence("a_end", F.col("a_end") + assess - 1)).alias("period"),
                             F.lit("assessment").alias("role"))
    return analysis.unionByName(assessment).withColumn("fold", F.col("fold").cast("int"))


def bootstrap_weights(df: DataFrame, key: str, n_reps: int, seed: int = 42) -> DataFrame:
    """One Poisson(1) weight column per replicate (``w_1`` .. ``w_n``).

    Poisson bootstrap: drawing with replacement is replaced by an independent
    count per (row, replicate) from a hash, so no shuffle or global sample.
    """
    cdf = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462,
           0.9963401531726563, 0.9994058151824183, 0.9999167588507119, 0.9999897508033253]
    out = df
    for r in range(1, n_reps + 1):
        u = hash_unit(seed, key, F.lit(r))
        w = F.lit(len(cdf))
        for k in range(len(cdf) - 1, -1, -1):
            w = F.when(u < cdf[k], F.lit(k)).otherwise(w)
        out = out.withColumn(f"w_{r}", w.cast("int"))
    return out


def learning_curve_sets(df: DataFrame, key: str, fractions: Sequence[float], seed: int = 42) -> DataFrame:
    """Nested training subsets: a row in fraction f is in every larger fraction.

    Adds ``min_fraction``: the smallest listed fraction that includes the row
    (rank by hash <= floor(f * n)); filter ``min_fraction <= f`` for subset f.
    """
    d, _ = _ranked(df, key, None, seed)
    fr = sorted(float(f) for f in fractions)
    m = None
    for f in reversed(fr):
        cond = F.col("_rank") <= F.floor(F.col("_n") * F.lit(f))
        m = F.when(cond, F.lit(f)).otherwise(m) if m is not None else F.when(cond, F.lit(f))
    return d.withColumn("min_fraction", m).drop("_h", "_rank", "_n")
