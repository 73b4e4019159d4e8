"""Table verbs: projections, filters, joins, aggregation, reshape, windows.

Thin where Spark already has the verb (select, filter, join, unpivot),
explicit where R semantics differ (right-closed cut, keyed binds, ties in
top-n, zero-filled pivots with declared values).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faro.functions.core import col, epoch_micros, cut_by_bounds, cut_expr, numeric_columns, safe_div, stable_hash
from faro.operators.ranking import quantiles, value_rank

# ---------------------------------------------------------------- P: rows/cols


def select_by(df: DataFrame, names: Sequence[str] = (), numeric: bool = False, prefix: str | None = None,
              exclude: Sequence[str] = ()) -> DataFrame:
    """Select by name, by numeric type or by prefix; ``exclude`` drops (R ``-col``)."""
    keep = list(names)
    if numeric:
        keep += [c for c in numeric_columns(df) if c not in keep]
    if prefix:
        keep += [c for c in df.columns if c.startswith(prefix) and c not in keep]
    if not names and not numeric and not prefix:
        keep = list(df.columns)
    return df.select(*[c for c in keep if c not in exclude])


def case_when(branches: Sequence[tuple[Column, object]], default=None) -> Column:
    """First matching branch wins; ``default`` for no match (NULL if None)."""
    out = None
    for cond, val in branches:
        v = val if isinstance(val, Column) else F.lit(val)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    if default is not None:
        out = out.otherwise(default if isinstance(default, Column) else F.lit(default))
    return out


def cut(df: DataFrame, c: str, breaks: Sequence[float], labels: Sequence[str] | None = None,
        include_lowest: bool = False, out: str | None = None) -> DataFrame:
    """Right-closed binning (a, b]; values outside all bins are NULL."""
    return df.withColumn(out or f"{c}_bin", cut_expr(c, breaks, labels, include_lowest))


def cut_quantile(df: DataFrame, c: str, probs: Sequence[float], labels: Sequence[str],
                 out: str | None = None) -> DataFrame:
    """Bins at exact quantile breaks (lowest included).

    Breaks come from the distributed exact quantiles as a one-row array
    joined to every row (a broadcast of len(probs) doubles).
    """
    q = quantiles(df, c, probs)
    bounds = q.agg(F.array_sort(F.collect_list(F.struct("prob", "quantile"))).alias("_s")) \
              .select(F.transform("_s", lambda s: s["quantile"]).alias("_bounds"))
    j = df.crossJoin(F.broadcast(bounds))
    return j.withColumn(out or f"{c}_bin", cut_by_bounds(c, F.col("_bounds"), labels)).drop("_bounds")


def recode(c: str | Column, mapping: Mapping, default=None) -> Column:
    """Map values through a literal dictionary; unmapped -> default (or the value)."""
    c = col(c)
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    return out.otherwise(c if default is None else F.lit(default))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def paste(*cols: str | Column, sep: str = " ") -> Column:
    return F.concat_ws(sep, *[col(c).cast("string") for c in cols])


def paste_collapse(df: DataFrame, by: Sequence[str], value: str, order: str | None = None, sep: str = ", ",
                   out: str = "collapsed") -> DataFrame:
    """Concatenate a column within each group in a deterministic order.

    The result holds every value of the group, so use it where groups are
    bounded by construction (top-n terms, members of a summary table).
    """
    o = col(order) if order else col(value)
    return df.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(o.alias("o"), col(value).cast("string").alias("v")))),
                                                         lambda s: s["v"]), sep).alias(out))


def top_k(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """``arrange(...) |> head(n)``: TakeOrdered; pass a key as the last order column."""
    return df.orderBy(*order).limit(n)


def across(df: DataFrame, fn: Callable[[Column], Column], cols: Sequence[str] | None = None,
           suffix: str = "") -> DataFrame:
    """Apply ``fn`` to every numeric column (or the listed ones)."""
    cols = list(cols or numeric_columns(df))
    return df.withColumns({f"{c}{suffix}": fn(F.col(c)) for c in cols})


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row result (``pull``) to every row (broadcast)."""
    return df.crossJoin(F.broadcast(one_row))


# ---------------------------------------------------------------- J: joins


def left_join(left: DataFrame, right: DataFrame, by: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Equi left join; ``by`` may map differently named keys {left: right}."""
    if isinstance(by, Mapping):
        cond = [left[k] == right[v] for k, v in by.items()]
        return left.join(right, cond, "left").drop(*[right[v] for v in by.values()])
    return left.join(right, list(by), "left")


def anti_join(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    return left.join(right, list(by), "left_anti")


def semi_join(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    return left.join(right, list(by), "left_semi")


def bind_rows(*dfs: DataFrame) -> DataFrame:
    """Stack by column name; missing columns become NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def attach_predictions(data: DataFrame, preds: DataFrame, key: str) -> DataFrame:
    """R's positional ``bind_cols`` made safe: join predictions on the row key."""
    return data.join(preds, key, "inner")


def param_grid(spark, **params: Sequence) -> DataFrame:
    """Small literal grid (cartesian product of parameter lists)."""
    import itertools

    names = list(params)
    rows = list(itertools.product(*[params[n] for n in names]))
    return spark.createDataFrame(rows, names)


def with_params(df: DataFrame, grid: DataFrame) -> DataFrame:
    """Cross the data with a literal parameter grid (broadcast; replaces R loops)."""
    return df.crossJoin(F.broadcast(grid))


# ---------------------------------------------------------------- A: aggregate/reshape


def summarise(df: DataFrame, by: Sequence[str], value: str, median: bool = True) -> DataFrame:
    """n, mean, sd (n-1), sum, min, max and exact median per group."""
    v = col(value).cast("double")
    base = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"),
                               F.sum(v).alias("sum"), F.min(v).alias("min"), F.max(v).alias("max"))
    if not median:
        return base
    med = quantiles(df, value, [0.5], by).select(*by, F.col("quantile").alias("median"))
    return base.join(med, list(by), "left") if by else base.crossJoin(med)


def pivot_longer(df: DataFrame, ids: Sequence[str], cols: Sequence[str], names_to: str = "name",
                 values_to: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(cols), names_to, values_to)


def pivot_wider(df: DataFrame, ids: Sequence[str], names_from: str, values_from: str | Sequence[str],
                values: Sequence, fill=None, prefix: str = "") -> DataFrame:
    """Long -> wide with *declared* pivot values (no extra pass to discover them).

    Several value columns give ``<value>_<name>`` columns.
    """
    vals = [values_from] if isinstance(values_from, str) else list(values_from)
    aggs = [F.first(v).alias(v) for v in vals]
    w = df.groupBy(*ids).pivot(names_from, list(values)).agg(*aggs)
    ren = {}
    for lv in values:
        for v in vals:
            src = f"{lv}" if len(vals) == 1 else f"{lv}_{v}"
            dst = f"{prefix}{lv}" if len(vals) == 1 else f"{v}_{prefix}{lv}"
            ren[src] = dst
    w = w.withColumnsRenamed(ren)
    if fill is not None:
        w = w.fillna(fill, subset=list(ren.values()))
    return w


def histogram(df: DataFrame, value: str, binwidth: float, by: Sequence[str] = ()) -> DataFrame:
    """Counts per bin [k*w, (k+1)*w) -- the numbers under a histogram."""
    b = F.floor(col(value).cast("double") / binwidth)
    return (df.groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("bin_start", F.col("bin") * binwidth).withColumn("bin", F.col("bin").cast("bigint")))


def boxplot_stats(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """q1, median, q3 and whisker ends (most extreme points within 1.5 IQR)."""
    by = list(by)
    q = quantiles(df, value, [0.25, 0.5, 0.75], by)
    qw = q.groupBy(*by).pivot("prob", [0.25, 0.5, 0.75]).agg(F.first("quantile"))
    qw = qw.select(*by, F.col("`0.25`").alias("q1"), F.col("`0.5`").alias("median"), F.col("`0.75`").alias("q3"))
    j = df.join(qw, by) if by else df.crossJoin(qw)
    v = col(value).cast("double")
    iqr = F.col("q3") - F.col("q1")
    inside = (v >= F.col("q1") - 1.5 * iqr) & (v <= F.col("q3") + 1.5 * iqr)
    return j.groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))


def trend_line(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line per group (``geom_smooth(method = lm)``)."""
    yy, xx = col(y).cast("double"), col(x).cast("double")
    return df.groupBy(*by).agg(F.regr_intercept(yy, xx).alias("intercept"), F.regr_slope(yy, xx).alias("slope"),
                               F.regr_r2(yy, xx).alias("r2"), F.regr_count(yy, xx).alias("n"))


def error_bars(df: DataFrame, value: str, by: Sequence[str], z: float = 1.96) -> DataFrame:
    """Mean and mean +/- z * standard error per group."""
    v = col(value).cast("double")
    g = df.groupBy(*by).agg(F.avg(v).alias("mean"), (F.stddev_samp(v) / F.sqrt(F.count(v))).alias("se"))
    return g.withColumn("lower", F.col("mean") - z * F.col("se")).withColumn("upper", F.col("mean") + z * F.col("se"))


def group_profile_cube(df: DataFrame, dims: Sequence[str], y: str, event) -> DataFrame:
    """Counts and outcome share for every combination of ``dims`` (CUBE).

    One aggregation replaces the separate by-a, by-b, by-both tables;
    ``grouping_id`` tells the levels apart.
    """
    return df.cube(*dims).agg(F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("n"),
                              F.avg((col(y) == F.lit(event)).cast("double")).alias("share"))


# ---------------------------------------------------------------- W: windows


def share_within(df: DataFrame, value: str, by: Sequence[str], out: str = "share") -> DataFrame:
    """value / sum(value) within group (for already aggregated tables)."""
    return df.withColumn(out, safe_div(col(value), F.sum(value).over(Window.partitionBy(*by))))


def slice_max(df: DataFrame, by: Sequence[str], order: str, n: int, with_ties: bool = True,
              tiebreak: Sequence[str] = ()) -> DataFrame:
    """Top-n rows per group by ``order`` descending.

    ``with_ties`` keeps every row tied with the n-th (``rank``), else exactly
    n rows (``row_number`` with a key tie-breaker).  A ``<= n`` filter on a
    ranking window lets Spark insert a partial WindowGroupLimit before the
    shuffle, so a hot group ships only n rows per partition.
    """
    if with_ties:
        r = F.rank().over(Window.partitionBy(*by).orderBy(F.col(order).desc()))
    else:
        r = F.row_number().over(Window.partitionBy(*by).orderBy(F.col(order).desc(), *[F.col(c) for c in tiebreak]))
    return df.withColumn("_r", r).filter(F.col("_r") <= n).drop("_r")


def slice_head(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int = 1) -> DataFrame:
    """First n rows per group in key order."""
    w = Window.partitionBy(*by).orderBy(*[F.col(c) for c in order])
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def slice_sample(df: DataFrame, by: Sequence[str], key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows per group drawn by hash order (deterministic stratified sample)."""
    w = Window.partitionBy(*by).orderBy(stable_hash(seed, key), F.col(key))
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def rank_within(df: DataFrame, by: Sequence[str], order: str, descending: bool = True, tiebreak: Sequence[str] = (),
                out: str = "rank") -> DataFrame:
    """Display order per facet (``reorder_within``): row_number per group, a hot group spread over tasks."""
    return value_rank(df, order, tiebreak, descending, out, groups=by)


def rolling(df: DataFrame, key: str, ts: str, value: str, seconds: int, chunk_seconds: int | None = None) -> DataFrame:
    """Trailing-window count/sum/mean of ``value`` over (ts - seconds, ts] per key.

    Rows are cut into time chunks of ``chunk_seconds`` (>= window) per key;
    each row is also copied into the next chunk as context when it lies within
    one window of that chunk's start.  The window then runs per (key, chunk),
    so a key with a third of all rows is spread over many tasks, and the
    result is identical to one window per key.  Ties in ts are included
    together (RANGE frame).
    """
    chunk = chunk_seconds or max(seconds * 8, 86400)
    if chunk < seconds:
        raise ValueError("chunk must be at least the window length")
    t = epoch_micros(ts)
    d = df.withColumn("_t", t).withColumn("_chunk", F.floor(F.col("_t") / (chunk * 1_000_000)).cast("bigint"))
    own = d.withColumn("_ctx", F.lit(False))
    nxt = (d.filter(F.col("_t") > (F.col("_chunk") + 1) * chunk * 1_000_000 - seconds * 1_000_000)
           .withColumn("_chunk", F.col("_chunk") + 1).withColumn("_ctx", F.lit(True)))
    u = own.unionByName(nxt)
    w = Window.partitionBy(key, "_chunk").orderBy("_t").rangeBetween(-(seconds * 1_000_000) + 1, 0)
    v = col(value).cast("double")
    return (u.withColumn("roll_n", F.count(v).over(w)).withColumn("roll_sum", F.sum(v).over(w))
            .withColumn("roll_mean", F.avg(v).over(w)).filter(~F.col("_ctx")).drop("_t", "_chunk", "_ctx"))


def lag_diff(df: DataFrame, key: str, ts: str, value: str, tiebreak: str, out: str = "diff",
             chunk_seconds: int = 86400) -> DataFrame:
    """value minus the previous row's value of the same key, ordered by (ts, tiebreak).

    Rows are windowed per (key, time chunk), so a key holding a third of all
    rows is spread over its chunks.  The first row of a chunk takes its
    predecessor from the last row of the key's previous non-empty chunk: one
    aggregation per (key, chunk) and a window over that small chunk table.
    """
    t = epoch_micros(ts)
    d = df.withColumn("_chunk", F.floor(t / (chunk_seconds * 1_000_000)).cast("bigint"))
    w = Window.partitionBy(key, "_chunk").orderBy(F.col(ts), F.col(tiebreak))
    d = d.withColumn("_prev", F.lag(value).over(w)).withColumn("_rn", F.row_number().over(w))
    last = d.groupBy(key, "_chunk").agg(F.max(F.struct(F.col(ts), F.col(tiebreak), F.col(value).alias("v"))).alias("_last"))
    cw = Window.partitionBy(key).orderBy("_chunk")
    prev_chunk = last.select(key, "_chunk", F.lag("_last").over(cw).alias("_pl")).select(key, "_chunk", F.col("_pl.v").alias("_pv"))
    j = d.join(prev_chunk, [key, "_chunk"], "left")
    prev = F.when(F.col("_rn") == 1, F.col("_pv")).otherwise(F.col("_prev"))
    return j.withColumn(out, col(value) - prev).drop("_chunk", "_prev", "_rn", "_pv")
