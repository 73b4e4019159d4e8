"""Isotonic regression per group on mergeable blocks.

Outcomes are first summed per distinct score; the fit only depends on these
counts.  Pool-adjacent-violators then runs within ranges of ``RANGE`` neighbouring
blocks, each range in one task, and gives fewer, longer blocks of rising means.
Where a range ends above the start of the next one, the blocks are ranked and
cut into ranges anew, half a range further, and pooled again, until no pair of
neighbours is out of order.  Pooling pooled blocks gives the same fit as
pooling the rows, so the result is exact for any cut.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faro.functions.core import col
from faro.operators.ranking import materialize, running_sums, value_rank

RANGE = 200_000     # blocks that one task pools
MOST_ROUNDS = 1000


def pool(lo: Sequence[float], n: Sequence[float], s: Sequence[float]) -> list[tuple[float, float, float]]:
    """Blocks (first score, rows, sum) with rising means from neighbours in score order."""
    out: list[tuple[float, float, float]] = []
    for block in zip(lo, n, s):
        while out and out[-1][2] * block[1] >= block[2] * out[-1][1]:       # mean before >= mean of this one
            before = out.pop()
            block = (before[0], before[1] + block[1], before[2] + block[2])
        out.append(block)
    return out


def isotonic_blocks(counts: DataFrame, group: str, at: str = "lo", range_size: int | None = None) -> DataFrame:
    """(group, lo, n, s): the blocks of the fit from counts (group, lo score, n rows, s outcome sum), by group.

    The value of a block is s / n, for scores from ``lo`` up to the next block's.
    """
    size = range_size or RANGE
    kind = counts.schema[group].dataType.simpleString()

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lo")
        got = pd.DataFrame(pool(pdf["lo"], pdf["n"], pdf["s"]), columns=["lo", "n", "s"])
        got.insert(0, "_cut", pdf["_cut"].iloc[0])
        got.insert(0, group, pdf[group].iloc[0])
        return got

    blocks = counts.select(group, F.col(at).alias("lo"), F.col("n").cast("double").alias("n"), F.col("s").cast("double").alias("s"))
    for k in range(MOST_ROUNDS):
        ranked = value_rank(blocks, "lo", descending=False, out="_rank", groups=[group])
        cut = F.floor((F.col("_rank") - 1 + (k % 2) * (size // 2)) / size).alias("_cut")
        pooled = materialize(ranked.select(group, "lo", "n", "s", cut).groupBy(group, "_cut").applyInPandas(work, f"`{group}` {kind}, _cut long, lo double, n double, s double"))
        mean = F.col("s") / F.col("n")
        ends = pooled.groupBy(group, "_cut").agg(F.min_by(mean, "lo").alias("first"), F.max_by(mean, "lo").alias("last"))      # one row a range
        wrong = ends.withColumn("before", F.lag("last").over(Window.partitionBy(group).orderBy("_cut"))).filter("before >= first")
        blocks = pooled.drop("_cut")
        if wrong.isEmpty():
            return blocks
    raise RuntimeError(f"isotonic fit did not settle in {MOST_ROUNDS} rounds")


def calibrate_by_group(df: DataFrame, truth: str, score: str, group: str, event=1, out: str = "score_cal", range_size: int | None = None) -> DataFrame:
    """``df`` with the isotonic estimate of the event's rate at each row's score, fitted per group.

    Rows without an outcome take no part in the fit but get an estimate: that of
    the block their score falls in (the first block below all of them).  Rows
    without a group or score, and groups without outcomes, get NULL.
    """
    v = col(score).cast("double")
    hit = F.when(col(truth).isNotNull(), (col(truth) == F.lit(event)).cast("long"))
    per = materialize(df.filter(v.isNotNull() & ~F.isnan(v) & col(group).isNotNull()).groupBy(F.col(group).alias("_g"), v.alias("_x"))
                      .agg(F.count(hit).alias("n"), F.coalesce(F.sum(hit), F.lit(0)).alias("s")))
    blocks = materialize(isotonic_blocks(per.filter("n > 0"), "_g", "_x", range_size))
    starts = per.join(blocks.select("_g", F.col("lo").alias("_x"), F.lit(1).alias("_start")), ["_g", "_x"], "left").select("_g", "_x", F.coalesce("_start", F.lit(0)).alias("_start"))
    numbered = running_sums(starts, "_x", ["_start"], ["_g"]).select("_g", "_x", F.greatest("_start_cum", F.lit(1)).alias("_block"), "_start")
    own = numbered.filter("_start = 1").join(blocks.select("_g", F.col("lo").alias("_x"), (F.col("s") / F.col("n")).alias(out)), ["_g", "_x"]).select("_g", "_block", out)
    values = numbered.join(own, ["_g", "_block"], "left").select("_g", "_x", out)
    joined = df.withColumn("_v", v).join(values, (F.col(group) == F.col("_g")) & (F.col("_v") == F.col("_x")), "left")
    return joined.drop("_g", "_x", "_v")
