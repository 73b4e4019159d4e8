"""Profiling and data-quality operators (Q01-Q13).

Each profile is one aggregation pass (all columns in a single ``agg``)
followed by a reshape of the one-row result; nothing row-sized reaches the
driver.  Quantiles use the exact distributed ``ranking.quantiles``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faro.functions.core import col, numeric_columns, safe_div
from faro.operators.ranking import materialize, quantiles, quantiles_of_counts
from faro.operators import metrics as M

_SQL_TYPE = {
    T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE", T.FloatType: "FLOAT",
    T.StringType: "VARCHAR", T.BooleanType: "BOOLEAN", T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP",
    T.TimestampType: "TIMESTAMP WITH TIME ZONE", T.ShortType: "SMALLINT", T.ByteType: "TINYINT",
}


def sql_type_name(dt: T.DataType) -> str:
    if isinstance(dt, T.ArrayType):
        return sql_type_name(dt.elementType) + "[]"
    return _SQL_TYPE.get(type(dt), dt.simpleString().upper())


def glimpse(df: DataFrame) -> DataFrame:
    """One row per column: position, name, SQL type, and the table's row count."""
    spark = df.sparkSession
    meta = spark.createDataFrame(
        [(i + 1, f.name, sql_type_name(f.dataType)) for i, f in enumerate(df.schema.fields)],
        "position int, column_name string, column_type string")
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return F.broadcast(meta).crossJoin(n)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def summary_stats(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(variable, min, q1, median, mean, q3, max) per numeric column, exact quartiles."""
    cols = list(cols or numeric_columns(df))
    simple = df.agg(*[F.struct(F.min(F.col(c).cast("double")).alias("min"), F.avg(F.col(c).cast("double")).alias("mean"),
                               F.max(F.col(c).cast("double")).alias("max")).alias(c) for c in cols])
    simple = simple.select(F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"`{c}`.*")) for c in cols])).alias("s")).select("s.*")
    # quartiles for all columns in one pass over a long (variable, value) view
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value"))
                                         for c in cols])).alias("kv")).select("kv.*")
    q = quantiles(long, "value", [0.25, 0.5, 0.75], by=["variable"])
    qw = q.groupBy("variable").pivot("prob", [0.25, 0.5, 0.75]).agg(F.first("quantile"))
    qw = qw.select("variable", F.col("`0.25`").alias("q1"), F.col("`0.5`").alias("median"), F.col("`0.75`").alias("q3"))
    return simple.join(qw, "variable", "left").select("variable", "min", "q1", "median", "mean", "q3", "max")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n_null) for every column, plus a ``__total__`` row."""
    cols = list(cols or df.columns)
    w = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = w.unpivot([], [F.col(f"`{c}`").cast("bigint").alias(c) for c in cols], "column_name", "n_null")
    tot = long.agg(F.lit("__total__").alias("column_name"), F.sum("n_null").cast("bigint").alias("n_null"))
    return long.unionByName(tot)


def freq(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def freq_prop(df: DataFrame, cols: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Counts with their share of the total, or of the ``within`` group.

    Totals come from a second aggregation joined back (one row, or one row
    per group), not from an unpartitioned window.
    """
    c = freq(df, cols)
    if within:
        tot = c.groupBy(*within).agg(F.sum("n").alias("_tot"))
        j = c.join(tot, list(within))
    else:
        j = c.crossJoin(c.agg(F.sum("n").alias("_tot")))
    return j.withColumn("prop", safe_div(F.col("n"), F.col("_tot"))).drop("_tot")


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long cross-tab (a, b, n) with zero cells kept.

    The levels of ``b`` travel as one array to each level of ``a`` (the answer
    holds them there anyway), so every cell appears whatever their number.
    """
    c = df.filter(F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    levels = c.agg(F.collect_set(b).alias("_levels"))  # one row
    cells = c.select(F.col(a).alias("_a")).distinct().crossJoin(F.broadcast(levels)).select("_a", F.explode("_levels").alias("_b"))
    j = cells.join(c, cells["_a"].eqNullSafe(c[a]) & (cells["_b"] == c[b]), "left")
    return j.select(F.col("_a").alias(a), F.col("_b").alias(b), F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def contingency_wide(df: DataFrame, a: str, b: str, b_levels: Sequence[str]) -> DataFrame:
    """Wide cross-tab with declared column levels, zeros filled."""
    w = df.groupBy(a).pivot(b, list(b_levels)).agg(F.count(F.lit(1)))
    return w.fillna(0, subset=[str(x) for x in b_levels])


def _pair_corr(a: str, b: str):
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson r for every ordered pair (var1, var2), diagonal included.

    All p^2 coefficients come from one aggregation; constant columns give
    NULL instead of a division-by-zero error.
    """
    cols = list(cols or numeric_columns(df))
    pairs = [(a, b) for a in cols for b in cols]
    aggs = [_pair_corr(a, b).alias(f"{a}__{b}") for a, b in pairs]
    w = df.agg(*aggs)
    long = w.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"{a}__{b}").alias("r")) for a, b in pairs
    ])).alias("s")).select("s.*")
    return long


def top_correlated_pairs(df: DataFrame, cols: Sequence[str] | None = None, n: int = 1) -> DataFrame:
    """Highest |r| off the diagonal (each unordered pair once), top-n report."""
    cm = correlation_matrix(df, cols).filter(F.col("var1") < F.col("var2"))
    return cm.orderBy(F.abs("r").desc_nulls_last(), "var1", "var2").limit(n)


def correlations_with(df: DataFrame, target: str, cols: Sequence[str] | None = None) -> DataFrame:
    """r of every numeric column with ``target``, with its absolute value."""
    cols = [c for c in (cols or numeric_columns(df)) if c != target]
    w = df.agg(*[_pair_corr(c, target).alias(c) for c in cols])
    long = w.unpivot([], cols, "variable", "r")
    return long.withColumn("abs_r", F.abs("r"))


def duplicates(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """Groups of identical records: (record hash, copies, first key).

    Records are shuffled as a SHA-256 of their columns, not their full
    contents, so long texts are not moved across the network.
    """
    h = F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols]), 256)
    return (df.groupBy(h.alias("record_hash"))
            .agg(F.count(F.lit(1)).alias("copies"), F.min(key).alias("first_key"))
            .filter(F.col("copies") > 1))


def outliers_iqr(df: DataFrame, value: str, by: Sequence[str] = (), k: float = 1.5) -> DataFrame:
    """Boxplot rule per group: q1, q3, fences, and the number of rows outside."""
    by = list(by)
    v = col(value).cast("double")
    # rows per distinct value give the quantiles and the rows outside, so no row of the table is joined or sorted
    counts = materialize(df.filter(v.isNotNull()).groupBy(*by, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    q = quantiles_of_counts(counts, [0.25, 0.75], by)
    qw = q.groupBy(*by).pivot("prob", [0.25, 0.75]).agg(F.first("quantile"))
    qw = qw.select(*by, F.col("`0.25`").alias("q1"), F.col("`0.75`").alias("q3"))
    qw = qw.withColumn("lower", F.col("q1") - k * (F.col("q3") - F.col("q1"))) \
           .withColumn("upper", F.col("q3") + k * (F.col("q3") - F.col("q1")))
    j = counts.join(qw, by) if by else counts.crossJoin(qw)
    outside = (F.col("_v") < F.col("lower")) | (F.col("_v") > F.col("upper"))
    return (j.groupBy(*by, "q1", "q3", "lower", "upper")
            .agg(F.sum(F.when(outside, F.col("_c")).otherwise(F.lit(0))).alias("n_outliers")))


def flag_outliers_z(df: DataFrame, value: str, by: Sequence[str] = (), k: float = 3.0) -> DataFrame:
    """Adds ``z`` and ``is_outlier`` (|z| > k) using group mean and sample sd."""
    by = list(by)
    st = df.groupBy(*by).agg(F.avg(col(value).cast("double")).alias("_m"), F.stddev_samp(col(value).cast("double")).alias("_s"))
    j = df.join(st, by) if by else df.crossJoin(st)
    z = safe_div(col(value).cast("double") - F.col("_m"), F.col("_s"))
    return j.withColumn("z", z).withColumn("is_outlier", F.abs(F.col("z")) > k).drop("_m", "_s")


def missingness_by(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(col(value).isNull()).alias("n_missing"),
                               F.avg(col(value).isNull().cast("double")).alias("missing_rate"))


def class_balance(df: DataFrame, y: str) -> DataFrame:
    """Counts per class plus minority share and majority-class accuracy baseline."""
    c = freq(df, [y])
    s = c.agg(F.sum("n").alias("_t"), F.min("n").alias("_min"), F.max("n").alias("_max"))
    return c.crossJoin(s).select(
        y, "n", safe_div(F.col("n"), F.col("_t")).alias("prop"),
        safe_div(F.col("_min"), F.col("_t")).alias("minority_share"),
        safe_div(F.col("_max"), F.col("_t")).alias("baseline_accuracy"))


def leakage_scan(df: DataFrame, y: str, event, cols: Sequence[str]) -> DataFrame:
    """Single-predictor AUC and |r| with the binary outcome, per column.

    Columns are melted into (variable, value) rows and scored with the
    tie-aware AUC grouped by variable -- one job for all columns.  AUC near
    0 or 1 (or |r| near 1) flags a column that leaks the outcome.
    """
    long = df.select(col(y).alias("_y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in cols])).alias("kv")
    ).select("_y", "kv.*")
    auc = M.roc_auc(long, "_y", "value", event, by=["variable"])
    yy = (F.col("_y") == F.lit(event)).cast("double")
    r = long.groupBy("variable").agg(F.try_divide(F.covar_samp("value", yy), F.stddev_samp("value") * F.stddev_samp(yy)).alias("r"))
    return auc.join(r, "variable").withColumn("abs_r", F.abs("r")).withColumn(
        "auc_distance", F.abs(F.col("roc_auc") - 0.5))
