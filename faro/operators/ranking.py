"""Global ranks and running sums without a single-partition window.

A ``Window.orderBy`` with no ``partitionBy`` sends every row to one task.  At
scale we instead:

1. derive a monotone bucket for each row (a hash prefix for random order, or
   a range bucket of the sort key),
2. count rows per (group, bucket) -- a tiny partial-aggregated table,
3. turn the counts into offsets with a window over that small table,
4. join the offsets back on (group, bucket) and rank inside each bucket.

The join and the inner window share the (group, bucket) partitioning, so the
big table is shuffled once and a hot group is spread over every bucket.
The result equals one global ``row_number`` / running sum exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# md5 hex prefix length used for random-order buckets: 3 hex digits = 4096 buckets
HASH_PREFIX_DIGITS = 3
# rows of a range bucket beyond which more buckets are cut
BUCKET_ROWS = 200_000


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint.

    Used on aggregated intermediates that feed several branches of a plan
    (bucket splits, offsets, the main join), so the raw input is scanned
    once instead of once per branch.  Files go to the shared folder named by
    ``spark.checkpoint.dir`` and survive the loss of an executor.
    """
    from faro.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    For tables of many rows that are read again: a checkpoint would store them
    uncompressed and give back all columns to every reader.
    """
    from faro.session import checkpoint_dir

    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/faro-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and checkpoints of intermediates that nothing refers to any more.

    Spark does so when the driver collects its garbage, which a driver that
    holds little hardly ever does.
    """
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def hash_rank(df: DataFrame, hash_col: str, groups: Sequence[str] = (), tiebreak: Sequence[str] = (),
              out: str = "_rank", total: str | None = "_n") -> DataFrame:
    """1-based rank of each row by ``hash_col`` (hex string) within ``groups``.

    Adds ``out`` (bigint rank) and optionally ``total`` (rows in the group).
    """
    groups = list(groups)
    b = F.conv(F.substring(F.col(hash_col), 1, HASH_PREFIX_DIGITS), 16, 10).cast("int")
    df = df.withColumn("_bkt", b)
    counts = df.groupBy(*groups, "_bkt").agg(F.count(F.lit(1)).alias("_nb"))
    wg = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    offs = counts.withColumn("_off", F.sum("_nb").over(wg.orderBy("_bkt")) - F.col("_nb"))
    if total:
        offs = offs.withColumn(total, F.sum("_nb").over(wg))
    offs = offs.drop("_nb")
    joined = df.join(offs, [*groups, "_bkt"], "inner")
    w = Window.partitionBy(*groups, "_bkt").orderBy(F.col(hash_col), *[F.col(c) for c in tiebreak])
    return joined.withColumn(out, (F.row_number().over(w) + F.col("_off")).cast("bigint")).drop("_bkt", "_off")


def with_range_bucket(df: DataFrame, order_col: str, n_buckets: int = 256, out: str = "_bkt") -> DataFrame:
    """Add a monotone bucket id for ``order_col`` cut at approximate quantile splits.

    Approximate splits only decide *where* rows are cut into buckets; any
    monotone cut gives the exact same running sums and ranks.  The split
    array has at most ``n_buckets`` values (a bounded driver-side constant);
    assignment is MLlib's ``Bucketizer`` (a JVM binary search per row).
    NULL order values land in the last bucket.
    """
    from pyspark.ml.feature import Bucketizer

    probs = [i / n_buckets for i in range(1, n_buckets)]
    row = df.agg(F.percentile_approx(F.col(order_col).cast("double"), probs, max(10000, 10 * n_buckets)).alias("q")).first()
    splits = sorted(set(float(x) for x in (row["q"] or []) if x is not None and x == x and abs(x) != float("inf")))
    if not splits:
        return df.withColumn(out, F.lit(0))
    d = df.withColumn("_ord_d", F.col(order_col).cast("double"))
    b = Bucketizer(splits=[-float("inf")] + splits + [float("inf")], inputCol="_ord_d", outputCol=out, handleInvalid="keep")
    return b.transform(d).withColumn(out, F.col(out).cast("int")).drop("_ord_d")


def running_sums(df: DataFrame, order_col: str, value_cols: Sequence[str], groups: Sequence[str] = (),
                 descending: bool = False, n_buckets: int = 256, inclusive: bool = True,
                 suffix: str = "_cum", ready: bool = False) -> DataFrame:
    """Running sums of ``value_cols`` ordered by ``order_col`` (unique within a group).

    ``inclusive`` includes the current row.  Used on already-aggregated
    tables (e.g. one row per distinct score), where keys are unique.  ``ready``
    says that ``df`` is written already.  There are at least ``n_buckets``
    buckets, and more where one would hold over ``BUCKET_ROWS`` rows.
    """
    groups = list(groups)
    df = df if ready else materialize(df)
    n_buckets = max(n_buckets, -(-df.count() // BUCKET_ROWS))
    df = with_range_bucket(df, order_col, n_buckets)
    if descending:
        df = df.withColumn("_bkt", F.lit(n_buckets + 1) - F.col("_bkt"))
    tots = df.groupBy(*groups, "_bkt").agg(*[F.sum(c).alias(f"_t_{c}") for c in value_cols])
    wg = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))).orderBy("_bkt")
    for c in value_cols:
        tots = tots.withColumn(f"_o_{c}", F.sum(f"_t_{c}").over(wg) - F.col(f"_t_{c}"))
    tots = tots.drop(*[f"_t_{c}" for c in value_cols])
    joined = df.join(tots, [*groups, "_bkt"], "inner")
    oc = F.col(order_col).desc() if descending else F.col(order_col).asc()
    frame = Window.partitionBy(*groups, "_bkt").orderBy(oc)
    frame = frame.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    for c in value_cols:
        inner = F.coalesce(F.sum(c).over(frame), F.lit(0))
        joined = joined.withColumn(f"{c}{suffix}", inner + F.col(f"_o_{c}"))
    return joined.drop("_bkt", *[f"_o_{c}" for c in value_cols])


def _join(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Equi-join on ``by``; with no keys the (small) right side is crossed in."""
    return a.join(b, list(by), "inner") if by else a.crossJoin(F.broadcast(b))


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
              out: str = "quantile") -> DataFrame:
    """Exact type-7 (linear) quantiles per group: (by..., prob, quantile).

    Same numbers as ``percentile`` / R ``quantile`` but without holding all
    distinct values of a group in one aggregation buffer:

    * count rows per distinct value (map-side partial aggregation; a value
      held by a third of all rows collapses to one row),
    * running count over distinct values with the two-level ``running_sums``,
    * for each requested rank h = (n-1)p+1, pick the value whose running
      count covers floor(h) and ceil(h) (a join against a table of
      groups x probs), and interpolate.
    """
    v = F.col(value).cast("double")
    vc = df.filter(v.isNotNull()).groupBy(*by, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    return quantiles_of_counts(materialize(vc), probs, by, out)


def quantiles_of_counts(vc: DataFrame, probs: Sequence[float], by: Sequence[str] = (), out: str = "quantile") -> DataFrame:
    """``quantiles`` of a written table of counts: (by..., _v distinct value, _c rows)."""
    by = list(by)
    spark = vc.sparkSession
    cum = running_sums(vc, "_v", ["_c"], by, ready=True)  # adds _c_cum (inclusive)
    n = vc.groupBy(*by).agg(F.sum("_c").alias("_n"))
    pr = spark.createDataFrame([(float(p),) for p in probs], "prob double")
    tgt = (n.crossJoin(F.broadcast(pr))
           .withColumn("_h", (F.col("_n") - 1) * F.col("prob") + 1)
           .withColumn("_lo", F.floor("_h").cast("bigint"))
           .withColumn("_hi", F.ceil("_h").cast("bigint")))
    below = F.col("_c_cum") - F.col("_c")
    at_lo = (below < F.col("_lo")) & (F.col("_lo") <= F.col("_c_cum"))
    at_hi = (below < F.col("_hi")) & (F.col("_hi") <= F.col("_c_cum"))
    j = (_join(cum, tgt, by).filter(at_lo | at_hi).groupBy(*by, "prob", "_h", "_lo")
         .agg(F.max(F.when(at_lo, F.col("_v"))).alias("_vlo"), F.max(F.when(at_hi, F.col("_v"))).alias("_vhi")))
    q = F.col("_vlo") + (F.col("_h") - F.col("_lo")) * (F.col("_vhi") - F.col("_vlo"))
    return j.select(*by, "prob", q.alias(out))


def quantiles_wide(df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str],
                   by: Sequence[str] = ()) -> DataFrame:
    """``quantiles`` pivoted to one column per prob (declared pivot values)."""
    q = quantiles(df, value, probs, by)
    w = q.groupBy(*by).pivot("prob", [float(p) for p in probs]).agg(F.first("quantile"))
    return w.select(*by, *[F.col(f"`{float(p)}`").alias(nm) for p, nm in zip(probs, names)])


def value_rank(df: DataFrame, order_col: str, tiebreak: Sequence[str] = (), descending: bool = True,
               out: str = "rank", groups: Sequence[str] = ()) -> DataFrame:
    """1-based row_number by ``order_col`` (then ``tiebreak``), over all rows or within ``groups``.

    Spark's distributed sort cuts the rows into ranges of (groups, value,
    tie-break), so neither a hot group nor rows that share one value end in
    one task.  Each sorted row's place in its range is kept in a written table;
    counts per (group, range) become offsets.
    """
    groups = list(groups)
    oc = F.col(order_col).desc() if descending else F.col(order_col).asc()
    place = F.monotonically_increasing_id()  # sort partition in the high bits, position in it in the low 33
    d = materialize(df.orderBy(*[F.col(c) for c in groups], oc, *[F.col(c) for c in tiebreak]).withColumn("_place", place))
    d = d.withColumn("_bkt", F.shiftright("_place", 33))
    offs = d.groupBy(*groups, "_bkt").agg(F.count(F.lit(1)).alias("_nb"), F.min("_place").alias("_first"))
    w = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))).orderBy("_bkt")
    offs = offs.select(*[F.col(c).alias(f"_g_{c}") for c in groups], F.col("_bkt").alias("_b"),
                       (F.sum("_nb").over(w) - F.col("_nb") - F.col("_first") + 1).alias("_off"))
    on = d["_bkt"] == offs["_b"]
    for c in groups:
        on = on & d[c].eqNullSafe(offs[f"_g_{c}"])
    return d.join(offs, on).withColumn(out, F.col("_place") + F.col("_off")).drop("_bkt", "_b", "_off", "_place", *[f"_g_{c}" for c in groups])
