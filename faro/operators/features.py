"""Feature engineering outside recipes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faro.functions.core import col, epoch_micros, level_index


def rfm_features(events: DataFrame, key: str, ts: str, amount: str, as_of: str) -> DataFrame:
    """Recency / frequency / monetary features per key, one aggregation.

    days_since_first, days_since_last (to ``as_of``), n_events, mean_amount,
    total_amount and a trend = least-squares slope of amount over time
    (per day).  Partial aggregation runs map-side, so a hot key costs no
    more than any other.
    """
    t_days = epoch_micros(ts) / 86_400_000_000.0
    asof = F.to_timestamp(F.lit(as_of))
    return events.groupBy(key).agg(
        F.datediff(asof, F.min(ts)).alias("days_since_first"),
        F.datediff(asof, F.max(ts)).alias("days_since_last"),
        F.count(F.lit(1)).alias("n_events"),
        F.avg(col(amount).cast("double")).alias("mean_amount"),
        F.sum(col(amount).cast("double")).alias("total_amount"),
        F.regr_slope(col(amount).cast("double"), t_days).alias("trend"),
    )


def calendar_features(df: DataFrame, ts: str, prefix: str | None = None) -> DataFrame:
    """ISO weekday (1 = Monday), month and year."""
    p = prefix or ts
    return df.withColumns({
        f"{p}_weekday": ((F.dayofweek(ts) + 5) % 7 + 1).cast("int"),
        f"{p}_month": F.month(ts).cast("int"),
        f"{p}_year": F.year(ts).cast("int"),
    })


def text_length_features(df: DataFrame, text: str, prefix: str = "text") -> DataFrame:
    """Characters and whitespace-separated words of the whole text."""
    words = F.size(F.filter(F.split(F.col(text), r"\s+"), lambda w: w != ""))
    return df.withColumns({f"{prefix}_chars": F.char_length(text).cast("int"), f"{prefix}_words": words.cast("int")})


def numeric_transforms(df: DataFrame, c: str, offset: float = 1.0) -> DataFrame:
    """log(x + offset), sqrt, square."""
    x = col(c).cast("double")
    return df.withColumns({f"{c}_log": F.ln(x + offset), f"{c}_sqrt": F.sqrt(x), f"{c}_sq": x * x})


def ratio(a: str, b: str):
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def label_encode(df: DataFrame, c: str, levels: Sequence[str], out: str | None = None) -> DataFrame:
    """Integer code = 1-based position in the declared level order (NULL if absent)."""
    return df.withColumn(out or f"{c}_code", level_index(c, levels))
