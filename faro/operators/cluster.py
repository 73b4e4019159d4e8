"""Clustering and principal components.

No operator here materialises all row pairs.  Quantities that R computes
from a full distance matrix are rebuilt from per-cluster sufficient
statistics (counts, vector sums, sums of squared norms), which makes
squared-Euclidean silhouettes and sum-of-squares decompositions exact in
O(n * k).  Distances are taken to a bounded reference set (centres, query
rows) that is broadcast.  PCA needs only the p x p cross-product matrix (one
aggregation); the eigen-decomposition of that small matrix runs on the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faro.functions.core import col, safe_div, stable_hash
from faro.operators.ranking import value_rank

# ------------------------------------------------------------------ vector helpers


def as_vector(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Pack numeric columns into an array<double> column."""
    return df.withColumn(out, F.array(*[F.col(c).cast("double") for c in cols]))


def centroids(df: DataFrame, label: str, vec: str, out: str = "centroid") -> DataFrame:
    """Element-wise mean vector per label (long aggregation, re-packed in dimension order)."""
    long = df.select(label, F.posexplode(vec).alias("_i", "_x"))
    m = long.groupBy(label, "_i").agg(F.avg(F.col("_x").cast("double")).alias("_m"), F.count(F.lit(1)).alias("_n"))
    return m.groupBy(label).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))), lambda s: s["_m"]).alias(out),
        F.max("_n").alias("size"))


def _sqdist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))),
                       F.lit(0.0), lambda acc, v: acc + v)


def distance(a: str | Column, b: str | Column, metric: str = "euclidean", p: float = 2.0) -> Column:
    """Distance between two equal-length arrays: euclidean, manhattan, maximum, canberra, binary, minkowski."""
    a, b = col(a), col(b)
    if metric == "euclidean":
        return F.sqrt(_sqdist(a, b))
    if metric == "manhattan":
        return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y).cast("double")), F.lit(0.0), lambda s, v: s + v)
    if metric == "maximum":
        return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y).cast("double")))
    if metric == "canberra":
        terms = F.zip_with(a, b, lambda x, y: F.when((F.abs(x) + F.abs(y)) > 0, F.abs(x - y) / (F.abs(x) + F.abs(y))).otherwise(F.lit(0.0)))
        return F.aggregate(terms, F.lit(0.0), lambda s, v: s + v.cast("double"))
    if metric == "binary":
        nz = F.zip_with(a, b, lambda x, y: F.struct(((x != 0) | (y != 0)).alias("any"), ((x != 0) & (y != 0)).alias("both")))
        any_ = F.size(F.filter(nz, lambda s: s["any"]))
        both = F.size(F.filter(nz, lambda s: s["both"]))
        return safe_div(any_ - both, any_)
    if metric == "minkowski":
        s = F.aggregate(F.zip_with(a, b, lambda x, y: F.pow(F.abs(x - y).cast("double"), p)), F.lit(0.0), lambda t, v: t + v)
        return F.pow(s, 1.0 / p)
    raise ValueError(metric)


def distances_to(df: DataFrame, key: str, vec: str, refs: DataFrame, ref_key: str, ref_vec: str,
                 metric: str = "euclidean") -> DataFrame:
    """(key, ref, distance) from every row to every row of a bounded reference set (broadcast)."""
    r = refs.select(F.col(ref_key).alias("ref"), F.col(ref_vec).alias("_rv"))
    return df.select(key, vec).crossJoin(F.broadcast(r)).select(key, "ref", distance(vec, "_rv", metric).alias("distance"))


# ------------------------------------------------------------------ scaling


def scale_matrix(df: DataFrame, key: str, cols: Sequence[str], out: str | None = None) -> DataFrame:
    """z-scores (sample sd) of the listed columns, keeping the key; constant columns stay centred."""
    st = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols],
                *[F.stddev_samp(F.col(c).cast("double")).alias(f"s_{c}") for c in cols])
    j = df.select(key, *cols).crossJoin(F.broadcast(st))
    z = {c: F.when(F.col(f"s_{c}") > 0, (F.col(c) - F.col(f"m_{c}")) / F.col(f"s_{c}")).otherwise(F.col(c) - F.col(f"m_{c}"))
         for c in cols}
    res = j.select(key, *[v.alias(c) for c, v in z.items()])
    if out:
        res = res.withColumn(out, F.array(*[F.col(c) for c in cols]))
    return res


# ------------------------------------------------------------------ k-means


def _centers_literal(centers: DataFrame, center_id: str, center_vec: str) -> Column:
    """The k centres as one literal array<struct<id, v>> (k x dim values, bounded by k)."""
    rows = sorted(((r[center_id], [float(x) for x in r[center_vec]]) for r in centers.collect()), key=lambda t: t[0])
    return F.array(*[F.struct(F.lit(cid).alias("id"), F.array(*[F.lit(x) for x in v]).alias("v")) for cid, v in rows])


def assign_to_centers(df: DataFrame, vec: str, centers: DataFrame, center_id: str = "cluster",
                      center_vec: str = "center") -> DataFrame:
    """Nearest centre (squared Euclidean; ties -> smaller id) for each row.

    The k centres become a literal array in the projection, so assignment is
    a narrow map over the rows: no join, no shuffle.
    """
    lit = _centers_literal(centers, center_id, center_vec)
    best = F.array_min(F.transform(lit, lambda c: F.struct(_sqdist(F.col(vec), c["v"]).alias("d"), c["id"].alias("id"))))
    return df.withColumn("_b", best).withColumn(center_id, F.col("_b.id")) \
             .withColumn("sq_distance", F.col("_b.d")).drop("_b")


def lloyd_step(df: DataFrame, vec: str, centers: DataFrame, center_id: str = "cluster", center_vec: str = "center") -> DataFrame:
    """One Lloyd update: assign, then new centres = member means (cluster, center, size)."""
    a = assign_to_centers(df, vec, centers, center_id, center_vec)
    return centroids(a, center_id, vec, out=center_vec)


def kmeans(df: DataFrame, vec: str, k: int, nstart: int = 5, seed: int = 42, max_iter: int = 50):
    """Best of ``nstart`` MLlib k-means runs (lowest within SS).

    Returns (assignments, centers): assignments keep every input column plus
    ``cluster``; clusters are renumbered 1..k by their centres in
    lexicographic order so labels do not depend on the seed.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    spark = df.sparkSession
    if k == 1:  # a single cluster is the grand mean (MLlib requires k > 1)
        c1 = centroids(df.withColumn("_one", F.lit(1)), "_one", vec, out="center").select(F.lit(1).alias("cluster"), "center")
        return df.withColumn("cluster", F.lit(1)), c1
    data = df.withColumn("_features", array_to_vector(F.col(vec).cast("array<double>"))).persist()
    try:
        best = None
        for s in range(nstart):
            m = KMeans(k=k, seed=seed + s, maxIter=max_iter, featuresCol="_features", predictionCol="_pred").fit(data)
            cost = m.summary.trainingCost
            if best is None or cost < best[0]:
                best = (cost, m)
        model = best[1]
        centers = [list(map(float, c)) for c in model.clusterCenters()]
    finally:
        data.unpersist()
    order = sorted(range(len(centers)), key=lambda i: centers[i])
    cdf = spark.createDataFrame([(rank + 1, centers[i]) for rank, i in enumerate(order)], "cluster int, center array<double>")
    return assign_to_centers(df, vec, cdf).drop("sq_distance"), cdf


def ss_decomposition(df: DataFrame, vec: str, label: str) -> DataFrame:
    """totss, tot_withinss, betweenss (and k) from per-cluster sufficient statistics.

    withinss_c = sum ||x||^2 - n_c ||mean_c||^2; totss likewise with the grand mean.
    """
    long = df.select(label, F.posexplode(vec).alias("_i", "_x")).withColumn("_x", F.col("_x").cast("double"))
    per = long.groupBy(label, "_i").agg(F.sum("_x").alias("_s"), F.sum(F.col("_x") * F.col("_x")).alias("_q"),
                                        F.count(F.lit(1)).alias("_n"))
    w = per.groupBy(label).agg(F.sum(F.col("_q") - F.col("_s") * F.col("_s") / F.col("_n")).alias("withinss"))
    g = per.groupBy("_i").agg(F.sum("_s").alias("_S"), F.sum("_q").alias("_Q"), F.sum("_n").alias("_N"))
    tot = g.agg(F.sum(F.col("_Q") - F.col("_S") * F.col("_S") / F.col("_N")).alias("totss"))
    ws = w.agg(F.sum("withinss").alias("tot_withinss"), F.count(F.lit(1)).alias("k"))
    return tot.crossJoin(ws).withColumn("betweenss", F.col("totss") - F.col("tot_withinss"))


def withinss_by_cluster(df: DataFrame, vec: str, label: str) -> DataFrame:
    long = df.select(label, F.posexplode(vec).alias("_i", "_x")).withColumn("_x", F.col("_x").cast("double"))
    per = long.groupBy(label, "_i").agg(F.sum("_x").alias("_s"), F.sum(F.col("_x") * F.col("_x")).alias("_q"),
                                        F.count(F.lit(1)).alias("_n"))
    return per.groupBy(label).agg(F.sum(F.col("_q") - F.col("_s") * F.col("_s") / F.col("_n")).alias("withinss"),
                                  F.max("_n").alias("size"))


def elbow(df: DataFrame, vec: str, k_max: int, nstart: int = 3, seed: int = 42) -> DataFrame:
    """Total within SS for k = 1..k_max (best of ``nstart`` runs each)."""
    rows = []
    for k in range(1, k_max + 1):
        a, _ = kmeans(df, vec, k, nstart, seed)
        rows.append((k, float(ss_decomposition(a, vec, "cluster").first()["tot_withinss"])))
    return df.sparkSession.createDataFrame(rows, "k int, tot_withinss double")


# ------------------------------------------------------------------ silhouette


def silhouette(df: DataFrame, key: str, vec: str, label: str) -> DataFrame:
    """Per-row silhouette with squared Euclidean distance, exact without pairs.

    For a cluster C with n_C rows, vector sum S_C and sum of squared norms Q_C:
    sum_{y in C} ||x - y||^2 = n_C ||x||^2 - 2 x.S_C + Q_C.
    a(x) uses the own cluster with divisor n_C - 1, b(x) the smallest mean
    over the other clusters; s = (b - a) / max(a, b), 0 for singletons.
    (This is the definition Spark's ``ClusteringEvaluator`` uses.)  The k
    cluster statistics are one aggregation; scoring the rows is a projection.
    """
    sq = F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    long = df.select(label, F.posexplode(vec).alias("_i", "_x"))
    sums = long.groupBy(label, "_i").agg(F.sum(F.col("_x").cast("double")).alias("_s"))
    svec = sums.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_s"))), lambda s: s["_s"]).alias("_S"))
    cq = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"), F.sum(sq).alias("_Q"))
    rows = sorted(svec.join(cq, label).collect(), key=lambda r: r[label])  # k rows
    lit = F.array(*[F.struct(F.lit(r[label]).alias("c"), F.lit(float(r["_nc"])).alias("n"), F.lit(float(r["_Q"])).alias("q"),
                             F.array(*[F.lit(float(x)) for x in r["_S"]]).alias("s")) for r in rows])
    x = df.select(key, label, vec, sq.alias("_xx"))
    per = F.transform(lit, lambda c: F.struct(c["c"].alias("c"), c["n"].alias("n"), (
        c["n"] * F.col("_xx") - 2 * F.aggregate(F.zip_with(F.col(vec), c["s"], lambda a, b: a.cast("double") * b), F.lit(0.0),
                                                lambda acc, v: acc + v) + c["q"]).alias("sum")))
    x = x.withColumn("_per", per)
    own = F.filter("_per", lambda c: c["c"] == F.col(label))[0]
    others = F.filter("_per", lambda c: c["c"] != F.col(label))
    a = safe_div(own["sum"], own["n"] - 1)
    b = F.array_min(F.transform(others, lambda c: c["sum"] / c["n"]))
    out = x.select(key, label, a.alias("a"), b.alias("b"), own["n"].alias("_own_n"))
    s = F.when(F.col("_own_n") <= 1, F.lit(0.0)).otherwise(safe_div(F.col("b") - F.col("a"), F.greatest("a", "b")))
    return out.select(key, label, "a", "b", s.alias("silhouette"))


def silhouette_summary(sil: DataFrame, label: str) -> DataFrame:
    """Mean silhouette per cluster and overall (``__all__`` row)."""
    per = sil.groupBy(F.col(label).cast("string").alias(label)).agg(F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("mean_silhouette"))
    tot = sil.agg(F.lit("__all__").alias(label), F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("mean_silhouette"))
    return per.unionByName(tot)


#: most rows whose Euclidean silhouette is taken against all rows (they are sent to every task)
MOST_SAMPLE = 50_000


def silhouette_euclidean(df: DataFrame, key: str, vec: str, label: str, sample: int = 1000, seed: int = 42) -> DataFrame:
    """Silhouette with plain Euclidean distance of up to ``sample`` rows (smallest hashes of their key) against all rows.

    Rows (key, label, a, b, silhouette) of the sampled rows; exact for each of
    them, and for the table where ``sample`` covers it.  One scan: every task
    sums the distances of its rows to each sampled row per cluster, so a hot
    cluster is summed where it lies.  Rows without a vector or label take no
    part; 0 for the only row of a cluster, NULL where there is one cluster only.
    """
    if sample > MOST_SAMPLE:
        raise ValueError(f"at most {MOST_SAMPLE} sampled rows")
    kind = df.schema[label].dataType.simpleString()
    rows = df.filter(F.col(vec).isNotNull() & F.col(label).isNotNull()).select(key, F.col(label).alias("_c"), F.col(vec).cast("array<double>").alias("_v"))
    some = rows.orderBy(stable_hash(seed, key), key).limit(sample).collect()      # bounded by ``sample``
    if not some:
        return df.limit(0).select(key, label, F.lit(0.0).alias("a"), F.lit(0.0).alias("b"), F.lit(0.0).alias("silhouette"))
    points = np.array([r["_v"] for r in some], dtype=float)

    def sums(batches):
        import pandas as pd

        step = max(1, (1 << 22) // points.size)
        total: dict = {}
        for batch in batches:
            for c, part in batch.groupby("_c", sort=False):
                x = np.array(part["_v"].tolist(), dtype=float)
                n, s = total.get(c, (0, np.zeros(len(points))))
                for lo in range(0, len(x), step):
                    s = s + np.sqrt(((x[lo:lo + step, None, :] - points[None, :, :]) ** 2).sum(axis=2)).sum(axis=0)
                total[c] = (n + len(x), s)
        for c, (n, s) in total.items():
            yield pd.DataFrame({"_o": [c] * len(s), "_i": range(len(s)), "_n": n, "_s": s})

    per = rows.select("_c", "_v").mapInPandas(sums, f"_o {kind}, _i int, _n long, _s double").groupBy("_i", "_o").agg(F.sum("_n").alias("_n"), F.sum("_s").alias("_s"))
    own = df.sparkSession.createDataFrame([(i, r[key], r["_c"]) for i, r in enumerate(some)], f"_i int, `{key}` {df.schema[key].dataType.simpleString()}, _c {kind}")
    j = per.join(own, "_i").groupBy(key, F.col("_c").alias(label)).agg(
        F.max(F.when(F.col("_o") == F.col("_c"), F.struct("_n", "_s"))).alias("_own"),
        F.min(F.when(F.col("_o") != F.col("_c"), F.col("_s") / F.col("_n"))).alias("b"))
    out = j.withColumn("a", safe_div(F.col("_own._s"), F.col("_own._n") - 1))
    s = F.when(F.col("_own._n") <= 1, F.lit(0.0)).when(F.col("b").isNull(), F.lit(None)).otherwise(safe_div(F.col("b") - F.col("a"), F.greatest("a", "b")))
    return out.select(key, label, "a", "b", s.alias("silhouette"))


def silhouette_estimate(sil: DataFrame, n_rows: int) -> DataFrame:
    """(n, mean_silhouette, std_err, band) of the table from the silhouettes of sampled rows; no error left where all ``n_rows`` were taken."""
    left = F.sqrt(F.greatest(1 - F.col("n") / F.lit(float(max(n_rows, 1))), F.lit(0.0)))
    got = sil.agg(F.count("silhouette").alias("n"), F.avg("silhouette").alias("mean_silhouette"), F.stddev_samp("silhouette").alias("_sd"))
    return got.select("n", "mean_silhouette", (F.coalesce("_sd", F.lit(0.0)) / F.sqrt("n") * left).alias("std_err"), silhouette_band(F.col("mean_silhouette")).alias("band"))


def silhouette_band(s: Column) -> Column:
    """Kaufman-Rousseeuw reading of a mean Euclidean silhouette."""
    # fixed values: band cut points .70 / .50 / .25
    return (F.when(s > 0.70, "strong").when(s > 0.50, "reasonable").when(s > 0.25, "weak").otherwise("none"))


def silhouette_by_k(df: DataFrame, key: str, vec: str, ks: Sequence[int], nstart: int = 3, seed: int = 42, sample: int = 1000) -> DataFrame:
    """Mean Euclidean silhouette, its standard error and band per number of k-means clusters."""
    n = df.count()
    out = None
    for k in ks:
        a, _ = kmeans(df, vec, k, nstart, seed)
        row = silhouette_estimate(silhouette_euclidean(a, key, vec, "cluster", sample, seed), n).select(F.lit(int(k)).alias("k"), "mean_silhouette", "std_err", "band")
        out = row if out is None else out.unionByName(row)
    return out


# ------------------------------------------------------------------ profiles / validation


def cluster_profile(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """Size and mean of each variable per cluster."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("size"), *[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in cols])


def validate_clusters(df: DataFrame, label: str, truth: str) -> DataFrame:
    """Purity = sum over clusters of the largest truth count / N."""
    c = df.groupBy(label, truth).agg(F.count(F.lit(1)).alias("n"))
    m = c.groupBy(label).agg(F.max("n").alias("_m"), F.sum("n").alias("_t"))
    return m.agg(safe_div(F.sum("_m"), F.sum("_t")).alias("purity"), F.count(F.lit(1)).alias("k"))


# ------------------------------------------------------------------ hierarchical (two-stage)


def hierarchical(df: DataFrame, key: str, vec: str, k: int, linkage: str = "ward.D2", micro: int = 200, seed: int = 42):
    """Agglomerative clustering re-aimed as two stages.

    1. k-means on Spark to at most ``micro`` micro-clusters (sizes kept),
    2. Lance-Williams agglomeration of the micro-centroids on the driver
       (an m x m problem, m <= ``micro``), cut at k,
    3. every row inherits the cut of its micro-cluster (broadcast join).

    Returns (assignments with ``hclust``, merge heights list).
    """
    n = df.count()
    m = int(min(micro, n))
    a, centers = kmeans(df, vec, m, nstart=1, seed=seed)
    sizes = {r["cluster"]: r["n"] for r in a.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = sorted(((r["cluster"], r["center"]) for r in centers.collect()), key=lambda t: t[0])
    ids = [cid for cid, _ in rows if sizes.get(cid, 0) > 0]
    X = np.array([c for cid, c in rows if sizes.get(cid, 0) > 0], dtype=float)
    w = np.array([sizes[cid] for cid in ids], dtype=float)
    labels, heights = _lance_williams(X, w, k, linkage)
    spark = df.sparkSession
    cut = spark.createDataFrame([(int(cid), int(lab)) for cid, lab in zip(ids, labels)], "cluster int, hclust int")
    return a.join(F.broadcast(cut), "cluster").drop("cluster"), heights


def _lance_williams(X: np.ndarray, w: np.ndarray, k: int, linkage: str):
    m = len(X)
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    if linkage == "ward.D2":
        # Ward on weighted points: merge cost from squared distances
        D = np.sqrt(2 * w[:, None] * w[None, :] / (w[:, None] + w[None, :]) * D ** 2)
    size = w.copy()
    active = list(range(m))
    members = {i: [i] for i in range(m)}
    heights = []
    np.fill_diagonal(D, np.inf)
    while len(active) > 1:
        sub = D[np.ix_(active, active)]
        i, j = np.unravel_index(np.argmin(sub), sub.shape)
        a, b = active[i], active[j]
        if a > b:
            a, b = b, a
        h = D[a, b]
        heights.append(float(h))
        if len(active) <= k:
            break
        for c in active:
            if c in (a, b):
                continue
            if linkage == "single":
                d = min(D[a, c], D[b, c])
            elif linkage == "complete":
                d = max(D[a, c], D[b, c])
            elif linkage == "average":
                d = (size[a] * D[a, c] + size[b] * D[b, c]) / (size[a] + size[b])
            elif linkage == "ward.D2":
                na, nb, nc = size[a], size[b], size[c]
                d = np.sqrt(((na + nc) * D[a, c] ** 2 + (nb + nc) * D[b, c] ** 2 - nc * D[a, b] ** 2) / (na + nb + nc))
            else:
                raise ValueError(linkage)
            D[a, c] = D[c, a] = d
        size[a] += size[b]
        members[a] += members.pop(b)
        active.remove(b)
    heights = heights[:-1] if len(active) <= k and len(heights) > m - k else heights
    groups = sorted(members.values(), key=lambda g: min(g))
    lab = np.zeros(m, dtype=int)
    for gi, g in enumerate(groups, start=1):
        lab[g] = gi
    return lab.tolist(), heights


# ------------------------------------------------------------------ PCA


def pca(df: DataFrame, cols: Sequence[str], k: int | None = None, scale: bool = True):
    """Principal components from the p x p covariance (one aggregation).

    Returns (components, loadings): components = (pc, sdev, variance,
    proportion, cumulative); loadings = (variable, pc, loading).  Each
    eigenvector's sign makes its largest-|loading| entry positive.
    """
    p = len(cols)
    x = [F.col(c).cast("double") for c in cols]
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(f"m{i}") for i, v in enumerate(x)],
                 *[F.covar_samp(x[i], x[j]).alias(f"c{i}_{j}") for i in range(p) for j in range(i, p)]).first()
    C = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            C[i, j] = C[j, i] = row[f"c{i}_{j}"] or 0.0
    sd = np.sqrt(np.diag(C))
    if scale:
        d = np.where(sd > 0, sd, 1.0)
        C = C / np.outer(d, d)
    vals, vecs = np.linalg.eigh(C)
    order = np.argsort(vals)[::-1]
    vals, vecs = np.clip(vals[order], 0, None), vecs[:, order]
    for j in range(p):
        i = int(np.argmax(np.abs(vecs[:, j])))
        if vecs[i, j] < 0:
            vecs[:, j] = -vecs[:, j]
    k = k or p
    tot = vals.sum()
    spark = df.sparkSession
    comps = spark.createDataFrame(
        [(j + 1, float(np.sqrt(vals[j])), float(vals[j]), float(vals[j] / tot), float(vals[: j + 1].sum() / tot)) for j in range(k)],
        "pc int, sdev double, variance double, proportion double, cumulative double")
    loads = spark.createDataFrame([(cols[i], j + 1, float(vecs[i, j])) for j in range(k) for i in range(p)],
                                  "variable string, pc int, loading double")
    state = {"mean": [row[f"m{i}"] for i in range(p)], "sd": sd.tolist(), "scale": scale, "rotation": vecs[:, :k].tolist(), "cols": list(cols)}
    return comps, loads, state


def pca_scores(df: DataFrame, key: str, state: dict) -> DataFrame:
    """Project rows on the components: (key, PC1..PCk), a pure projection."""
    cols, R = state["cols"], np.array(state["rotation"])
    z = []
    for i, c in enumerate(cols):
        e = F.col(c).cast("double") - F.lit(state["mean"][i])
        if state["scale"] and state["sd"][i] > 0:
            e = e / F.lit(state["sd"][i])
        z.append(e)
    pcs = {}
    for j in range(R.shape[1]):
        e = F.lit(0.0)
        for i in range(len(cols)):
            e = e + z[i] * F.lit(float(R[i, j]))
        pcs[f"PC{j + 1}"] = e
    return df.select(key, *[v.alias(n) for n, v in pcs.items()])


def kaiser(components: DataFrame) -> DataFrame:
    return components.withColumn("kaiser_keep", F.col("variance") > 1.0)


def contributions(loadings: DataFrame) -> DataFrame:
    """100 * loading^2 per (variable, pc) with the uniform cutoff 100 / p."""
    p = loadings.select("variable").distinct().count()
    return loadings.withColumn("contribution", 100.0 * F.col("loading") * F.col("loading")) \
                   .withColumn("above_uniform", F.col("contribution") > 100.0 / p)


def rank_by_pc(scores: DataFrame, key: str, pc: str = "PC1") -> DataFrame:
    """Index ranking by a component score (descending, key tie-breaker)."""
    return value_rank(scores, pc, [key], descending=True)


def biplot_data(scores: DataFrame, key: str, loadings: DataFrame, components: DataFrame, scale: float = 1.0) -> DataFrame:
    """Points (row scores on PC1/PC2) and arrows (loading x sdev x scale) in one table, ``kind`` tells them apart."""
    sd = {r["pc"]: r["sdev"] for r in components.filter(F.col("pc") <= 2).collect()}
    arrows = (loadings.filter(F.col("pc") <= 2).groupBy("variable").pivot("pc", [1, 2]).agg(F.first("loading"))
              .select(F.lit("arrow").alias("kind"), F.col("variable").alias("label"),
                      (F.col("1") * sd.get(1, 1.0) * scale).alias("x"), (F.col("2") * sd.get(2, 1.0) * scale).alias("y")))
    points = scores.select(F.lit("point").alias("kind"), F.col(key).cast("string").alias("label"),
                           F.col("PC1").alias("x"), F.col("PC2").alias("y"))
    return points.unionByName(arrows)
