"""Column-expression helpers shared by all operators.

Everything here returns a ``Column`` (JVM-side, codegen friendly); no Python
runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stable_hash(seed: int | str, *keys: str | Column) -> Column:
    """md5 of ``seed:key1:key2...`` as lowercase hex.

    Identical in Spark and in SQL engines that expose ``md5`` and
    ``concat_ws``, so every sample, split and fold has an exact SQL oracle
    and does not depend on partitioning or row order.
    """
    parts = [F.lit(str(seed))] + [col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts))


def hash_unit(seed: int | str, *keys: str | Column) -> Column:
    """Deterministic uniform in [0, 1) from the first 8 hex digits of the md5."""
    h = stable_hash(seed, *keys)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (0/0 metrics are NULL, never NaN)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def level_index(c: str | Column, levels: Sequence[str]) -> Column:
    """1-based position of the value in the declared level list, NULL if absent."""
    arr = F.array(*[F.lit(v) for v in levels])
    pos = F.array_position(arr, col(c))
    return F.when(pos > 0, pos.cast("int"))


def as_factor(c: str | Column, levels: Sequence[str]) -> Column:
    """Keep values that belong to the declared levels, NULL otherwise."""
    c = col(c)
    return F.when(c.isin(list(levels)), c)


def cut_expr(c: str | Column, breaks: Sequence[float], labels: Sequence[str] | None = None,
             include_lowest: bool = False) -> Column:
    """Right-closed intervals (a, b]; values outside every interval are NULL.

    With ``include_lowest`` the first interval is [a, b].
    """
    c = col(c)
    if labels is None:
        labels = [f"({breaks[i]},{breaks[i + 1]}]" for i in range(len(breaks) - 1)]
        if include_lowest:
            labels[0] = "[" + labels[0][1:]
    assert len(labels) == len(breaks) - 1
    out = None
    for i in range(len(breaks) - 1):
        lo, hi = float(breaks[i]), float(breaks[i + 1])
        cond = (c > lo) & (c <= hi)
        if i == 0 and include_lowest:
            cond = (c >= lo) & (c <= hi)
        out = F.when(cond, F.lit(labels[i])) if out is None else out.when(cond, F.lit(labels[i]))
    return out


def cut_by_bounds(c: str | Column, bounds: Column, labels: Sequence[str]) -> Column:
    """Right-closed binning against an array column of breaks (lowest included).

    ``bounds`` has len(labels)+1 ascending values; used when the breaks are
    data-derived (quantiles) and arrive through a one-row join.
    """
    c = col(c)
    out = None
    for i, lab in enumerate(labels):
        lo = F.element_at(bounds, i + 1)
        hi = F.element_at(bounds, i + 2)
        cond = (c > lo) & (c <= hi) if i > 0 else (c >= lo) & (c <= hi)
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    num = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, num) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double/float column (output normalisation for comparisons).

    Computed as round(x * 10^d) / 10^d: integer rounding of the same IEEE
    product behaves identically across engines, whereas rounding at d
    decimals may treat a tie in the decimal representation differently.
    """
    scale = float(10 ** digits)
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append((F.round(F.col(f.name).cast("double") * scale) / scale).alias(f.name))
        else:
            exprs.append(F.col(f.name))
    return df.select(*exprs)


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine similarity of two equal-length numeric arrays (NULL for a zero vector)."""
    a, b = col(a), col(b)
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                      lambda acc, v: acc + v)
    na = F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    nb = F.sqrt(F.aggregate(b, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.try_divide(dot, na * nb)


def dot(a: str | Column, b: str | Column) -> Column:
    a, b = col(a), col(b)
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                       lambda acc, v: acc + v)


def epoch_micros(ts: str) -> Column:
    """Microseconds since 1970-01-01 of a timestamp column, independent of the session time zone
    for zone-less timestamps (the testdata loads as TIMESTAMP_NTZ)."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(`{ts}` AS TIMESTAMP_NTZ))")
