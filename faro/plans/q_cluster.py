"""Clustering / PCA queries (C01-C17) on embeddings and per-nation indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from faro.operators import cluster as C
from faro.operators.profile import contingency
from faro.plans.registry import query
from faro.sources.tables import Tables

IND_COLS = ["n_customers", "mean_balance", "n_orders", "mean_price_k", "urgent_share"]

NATION_SQL = """ind AS (SELECT n.n_name AS country, count(DISTINCT c.c_custkey) AS n_customers, avg(c.c_acctbal) AS mean_balance,
  count(o.o_orderkey) AS n_orders, avg(o.o_totalprice) / 1000 AS mean_price_k,
  avg(CAST(o.o_orderpriority IN ('1-URGENT', '2-HIGH') AS DOUBLE)) AS urgent_share
  FROM nation n JOIN customer c ON c.c_nationkey = n.n_nationkey JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY 1)"""


def nation_indicators(t: Tables):
    """Country-indicator stand-in: one row per nation aggregated from customers and orders."""
    n = t.nation.select("n_nationkey", F.col("n_name").alias("country"))
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    j = n.join(c, F.col("c_nationkey") == F.col("n_nationkey")).join(o, F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("country").agg(
        F.countDistinct("c_custkey").alias("n_customers"), F.avg("c_acctbal").alias("mean_balance"),
        F.count("o_orderkey").alias("n_orders"), (F.avg("o_totalprice") / 1000).alias("mean_price_k"),
        F.avg(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("double")).alias("urgent_share"))


@query("c01_scale_matrix", f"""WITH {NATION_SQL}
SELECT country, """ + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS {c}" for c in IND_COLS) + " FROM ind",
       dbl=IND_COLS)
def c01_scale_matrix(spark, d):
    return C.scale_matrix(nation_indicators(Tables(spark, d)), "country", IND_COLS)


EMB = "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
CENT = """x AS (SELECT label, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM e),
c AS (SELECT label, list(m ORDER BY i) AS cv FROM (SELECT label, i, avg(x) AS m FROM x GROUP BY ALL) GROUP BY label)"""


def _emb_cent(spark, d):
    emb = Tables(spark, d).embeddings.withColumn("embedding", F.col("embedding").cast("array<double>"))
    cent = C.centroids(emb, "label", "embedding").select(F.col("label").alias("cluster"), F.col("centroid").alias("center"))
    return emb, cent


@query("c02_distances_euclidean", f"""WITH {EMB}, {CENT}
SELECT e.vec_id, c.label AS ref, sqrt(list_sum(list_transform(range(1, 65), lambda i: (e.v[i] - c.cv[i]) * (e.v[i] - c.cv[i])))) AS distance FROM e, c""",
       dbl=["distance"])
def c02_distances_euclidean(spark, d):
    emb, cent = _emb_cent(spark, d)
    return C.distances_to(emb, "vec_id", "embedding", cent, "cluster", "center", "euclidean").withColumnRenamed("ref", "ref")


@query("c02_distances_manhattan_max_canberra", f"""WITH {EMB}, {CENT}
SELECT e.vec_id, c.label AS ref, list_sum(list_transform(range(1, 65), lambda i: abs(e.v[i] - c.cv[i]))) AS manhattan,
list_max(list_transform(range(1, 65), lambda i: abs(e.v[i] - c.cv[i]))) AS maximum,
list_sum(list_transform(range(1, 65), lambda i: CASE WHEN abs(e.v[i]) + abs(c.cv[i]) > 0 THEN abs(e.v[i] - c.cv[i]) / (abs(e.v[i]) + abs(c.cv[i])) ELSE 0.0 END)) AS canberra,
pow(list_sum(list_transform(range(1, 65), lambda i: pow(abs(e.v[i] - c.cv[i]), 3))), 1.0 / 3) AS minkowski3
FROM e, c""", dbl=["manhattan", "maximum", "canberra", "minkowski3"])
def c02_distances_manhattan_max_canberra(spark, d):
    emb, cent = _emb_cent(spark, d)
    r = cent.select(F.col("cluster").alias("ref"), F.col("center").alias("_rv"))
    j = emb.select("vec_id", "embedding").crossJoin(F.broadcast(r))
    return j.select("vec_id", "ref", C.distance("embedding", "_rv", "manhattan").alias("manhattan"),
                    C.distance("embedding", "_rv", "maximum").alias("maximum"),
                    C.distance("embedding", "_rv", "canberra").alias("canberra"),
                    C.distance("embedding", "_rv", "minkowski", 3.0).alias("minkowski3"))


@query("c04_assign_to_centers", f"""WITH {EMB}, {CENT},
d AS (SELECT e.vec_id, c.label AS cl, list_sum(list_transform(range(1, 65), lambda i: (e.v[i] - c.cv[i]) * (e.v[i] - c.cv[i]))) AS d FROM e, c)
SELECT vec_id, m.c AS cluster, m.d AS sq_distance FROM (SELECT vec_id, min({{'d': d, 'c': cl}}) AS m FROM d GROUP BY vec_id)""",
       dbl=["sq_distance"])
def c04_assign_to_centers(spark, d):
    emb, cent = _emb_cent(spark, d)
    return C.assign_to_centers(emb.select("vec_id", "embedding"), "embedding", cent).drop("embedding")


@query("c04_lloyd_step", f"""WITH {EMB}, {CENT},
d AS (SELECT e.vec_id, e.v, c.label AS cl, list_sum(list_transform(range(1, 65), lambda i: (e.v[i] - c.cv[i]) * (e.v[i] - c.cv[i]))) AS d FROM e, c),
a AS (SELECT vec_id, min({{'d': d, 'c': cl}}).c AS cluster, first(v) AS v FROM d GROUP BY vec_id),
y AS (SELECT cluster, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM a)
SELECT cluster, i AS dim, avg(x) AS center FROM y GROUP BY ALL""", dbl=["center"])
def c04_lloyd_step(spark, d):
    emb, cent = _emb_cent(spark, d)
    new = C.lloyd_step(emb.select("vec_id", "embedding"), "embedding", cent)
    return new.select("cluster", F.posexplode("center").alias("dim", "center")).withColumn("dim", (F.col("dim") + 1).cast("bigint"))


@query("c05_ss_decomposition", f"""WITH {EMB}, x AS (SELECT label, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM e),
w AS (SELECT sum(q - s * s / n) AS tot_withinss, count(DISTINCT label) AS k FROM (SELECT label, i, sum(x) AS s, sum(x * x) AS q, count(*) AS n FROM x GROUP BY ALL)),
t AS (SELECT sum(q - s * s / n) AS totss FROM (SELECT i, sum(x) AS s, sum(x * x) AS q, count(*) AS n FROM x GROUP BY ALL))
SELECT totss, tot_withinss, k, totss - tot_withinss AS betweenss FROM t, w""", dbl=["totss", "tot_withinss", "betweenss"])
def c05_ss_decomposition(spark, d):
    emb, _ = _emb_cent(spark, d)
    return C.ss_decomposition(emb, "embedding", "label")


SIL_SQL = f"""WITH {EMB},
p AS (SELECT a.vec_id, a.label, b.label AS bl, list_sum(list_transform(range(1, 65), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i]))) AS d
      FROM e a, e b WHERE a.vec_id <> b.vec_id),
m AS (SELECT vec_id, label, bl, avg(d) AS md FROM p GROUP BY ALL),
s AS (SELECT vec_id, label, max(CASE WHEN bl = label THEN md END) AS a, min(CASE WHEN bl <> label THEN md END) AS b FROM m GROUP BY ALL),
sil AS (SELECT vec_id, label, a, b, CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / GREATEST(a, b) END AS silhouette FROM s)
"""


@query("c07_silhouette", SIL_SQL + "SELECT * FROM sil", dbl=["a", "b", "silhouette"])
def c07_silhouette(spark, d):
    emb, _ = _emb_cent(spark, d)
    return C.silhouette(emb, "vec_id", "embedding", "label")


@query("c07_silhouette_summary", SIL_SQL + """SELECT CAST(label AS VARCHAR) AS label, count(*) AS n, avg(silhouette) AS mean_silhouette FROM sil GROUP BY 1
UNION ALL SELECT '__all__', count(*), avg(silhouette) FROM sil""", dbl=["mean_silhouette"])
def c07_silhouette_summary(spark, d):
    emb, _ = _emb_cent(spark, d)
    return C.silhouette_summary(C.silhouette(emb, "vec_id", "embedding", "label"), "label")


_EUCLID_SQL = f"""WITH {EMB}, p AS (SELECT a.vec_id, a.label, b.label AS other, sqrt(list_sum(list_transform(range(1, 65), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i])))) AS d FROM e a, e b),
m AS (SELECT vec_id, label, other, sum(d) AS s, count(*) AS n FROM p GROUP BY ALL),
ab AS (SELECT vec_id, label, max(CASE WHEN other = label THEN s / nullif(n - 1, 0) END) AS a, min(CASE WHEN other <> label THEN s / n END) AS b, max(CASE WHEN other = label THEN n END) AS own FROM m GROUP BY ALL),
es AS (SELECT vec_id, label, a, b, CASE WHEN own <= 1 THEN 0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM ab) """


@query("c07_silhouette_euclidean", _EUCLID_SQL + "SELECT * FROM es", dbl=["a", "b", "silhouette"])
def c07_silhouette_euclidean(spark, d):
    """Euclidean silhouette of the labels; the sample bound is above the table's rows here, so every row has its own."""
    emb, _ = _emb_cent(spark, d)
    return C.silhouette_euclidean(emb, "vec_id", "embedding", "label", sample=10_000)


@query("c08_silhouette_band", _EUCLID_SQL + """SELECT count(*) AS n, avg(silhouette) AS mean_silhouette, CAST(0 AS DOUBLE) AS std_err, CASE WHEN avg(silhouette) > 0.70 THEN 'strong'
WHEN avg(silhouette) > 0.50 THEN 'reasonable' WHEN avg(silhouette) > 0.25 THEN 'weak' ELSE 'none' END AS band FROM es""", dbl=["mean_silhouette", "std_err"])
def c08_silhouette_band(spark, d):
    emb, _ = _emb_cent(spark, d)
    return C.silhouette_estimate(C.silhouette_euclidean(emb, "vec_id", "embedding", "label", sample=10_000), emb.count())


@query("c09_cluster_profile", f"""WITH {NATION_SQL}, r AS (SELECT n_name AS country, r_name AS cluster FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT cluster, count(*) AS size, """ + ", ".join(f"avg({c}) AS mean_{c}" for c in IND_COLS) + " FROM ind JOIN r USING (country) GROUP BY 1",
       dbl=[f"mean_{c}" for c in IND_COLS])
def c09_cluster_profile(spark, d):
    t = Tables(spark, d)
    ind = nation_indicators(t)
    r = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("country"),
                                                                                     F.col("r_name").alias("cluster"))
    return C.cluster_profile(ind.join(r, "country"), "cluster", IND_COLS)


@query("c10_validate_clusters", f"""WITH {EMB}, {CENT},
d AS (SELECT e.vec_id, e.label AS truth, c.label AS cl, list_sum(list_transform(range(1, 65), lambda i: (e.v[i] - c.cv[i]) * (e.v[i] - c.cv[i]))) AS d FROM e, c),
a AS (SELECT vec_id, first(truth) AS truth, min({{'d': d, 'c': cl}}).c AS cluster FROM d GROUP BY vec_id),
n AS (SELECT cluster, truth, count(*) AS n FROM a GROUP BY ALL)
SELECT sum(m) / CAST(sum(t) AS DOUBLE) AS purity, count(*) AS k FROM (SELECT cluster, max(n) AS m, sum(n) AS t FROM n GROUP BY 1)""", dbl=["purity"])
def c10_validate_clusters(spark, d):
    emb, cent = _emb_cent(spark, d)
    a = C.assign_to_centers(emb.select("vec_id", "label", "embedding"), "embedding", cent)
    return C.validate_clusters(a, "cluster", "label")


@query("c10_contingency_clusters", f"""WITH {EMB}, {CENT},
d AS (SELECT e.vec_id, e.label AS truth, c.label AS cl, list_sum(list_transform(range(1, 65), lambda i: (e.v[i] - c.cv[i]) * (e.v[i] - c.cv[i]))) AS d FROM e, c),
a AS (SELECT vec_id, first(truth) AS label, min({{'d': d, 'c': cl}}).c AS cluster FROM d GROUP BY vec_id),
l1 AS (SELECT DISTINCT cluster FROM a), l2 AS (SELECT DISTINCT label FROM a), n AS (SELECT cluster, label, count(*) AS n FROM a GROUP BY ALL)
SELECT l1.cluster, l2.label, COALESCE(n.n, 0) AS n FROM l1 CROSS JOIN l2 LEFT JOIN n ON n.cluster = l1.cluster AND n.label = l2.label""")
def c10_contingency_clusters(spark, d):
    emb, cent = _emb_cent(spark, d)
    a = C.assign_to_centers(emb.select("vec_id", "label", "embedding"), "embedding", cent)
    return contingency(a, "cluster", "label")


# ----------------------------------------------------------------- property-checked (tests/)


def _first_dims(spark, d):
    """All embedding vectors, full dimension, as array<double>."""
    emb = Tables(spark, d).embeddings
    return emb.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))


@query("c03_kmeans")
def c03_kmeans(spark, d):
    a, _ = C.kmeans(_first_dims(spark, d), "v", k=10, nstart=3, seed=42)
    return a.select("vec_id", "label", "cluster")


@query("c06_elbow")
def c06_elbow(spark, d):
    return C.elbow(_first_dims(spark, d), "v", k_max=6, nstart=2)


@query("c08_silhouette_by_k")
def c08_silhouette_by_k(spark, d):
    return C.silhouette_by_k(_first_dims(spark, d), "vec_id", "v", [2, 3, 4, 5, 6], nstart=2)


@query("c11_hierarchical")
def c11_hierarchical(spark, d):
    a, _ = C.hierarchical(_first_dims(spark, d), "vec_id", "v", k=10, linkage="ward.D2", micro=60)
    return a.select("vec_id", "label", "hclust")


@query("c12_kmeans_vs_hierarchical")
def c12_kmeans_vs_hierarchical(spark, d):
    x = _first_dims(spark, d)
    km, _ = C.kmeans(x, "v", k=5, nstart=2)
    hc, _ = C.hierarchical(x, "vec_id", "v", k=5, linkage="average", micro=60)
    j = km.select("vec_id", F.col("cluster").alias("kmeans")).join(hc.select("vec_id", "hclust"), "vec_id")
    return contingency(j, "kmeans", "hclust")


@query("c13_pca_components")
def c13_pca_components(spark, d):
    comps, _, _ = C.pca(nation_indicators(Tables(spark, d)), IND_COLS)
    return C.kaiser(comps)


_PCA2_SQL = f"""WITH {NATION_SQL}, s AS (SELECT avg(n_orders) AS m1, avg(mean_price_k) AS m2, var_samp(n_orders) AS a, covar_samp(n_orders, mean_price_k) AS b, var_samp(mean_price_k) AS c FROM ind),
l AS (SELECT *, (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS e1, (a + c) / 2 - sqrt(pow((a - c) / 2, 2) + b * b) AS e2 FROM s),
v AS (SELECT *, b / sqrt(b * b + pow(e1 - a, 2)) AS u1, (e1 - a) / sqrt(b * b + pow(e1 - a, 2)) AS u2 FROM l)"""


@query("c14_variance_explained", _PCA2_SQL + """ SELECT CAST(1 AS INTEGER) AS pc, sqrt(e1) AS sdev, e1 AS variance, e1 / (e1 + e2) AS proportion, e1 / (e1 + e2) AS cumulative, e1 > 1 AS kaiser_keep FROM v
UNION ALL SELECT 2, sqrt(e2), e2, e2 / (e1 + e2), CAST(1 AS DOUBLE), e2 > 1 FROM v""", dbl=["sdev", "variance", "proportion", "cumulative"])
def c14_variance_explained(spark, d):
    """Components of two unscaled indicators with their shares and the eigenvalue rule."""
    comps, _, _ = C.pca(nation_indicators(Tables(spark, d)), ["n_orders", "mean_price_k"], scale=False)
    return C.kaiser(comps)


@query("c16_index_rank", _PCA2_SQL + """, sc AS (SELECT country, ((n_orders - m1) * u1 + (mean_price_k - m2) * u2) * CASE WHEN (abs(u1) >= abs(u2) AND u1 < 0) OR (abs(u2) > abs(u1) AND u2 < 0) THEN -1 ELSE 1 END AS PC1 FROM ind, v)
SELECT country, PC1, row_number() OVER (ORDER BY PC1 DESC, country) AS rank FROM sc""", dbl=["PC1"])
def c16_index_rank(spark, d):
    """Countries ranked by the first component of two indicators."""
    ind = nation_indicators(Tables(spark, d))
    _, _, st = C.pca(ind, ["n_orders", "mean_price_k"], k=1, scale=False)
    return C.rank_by_pc(C.pca_scores(ind, "country", st), "country").select("country", "PC1", F.col("rank").cast("long").alias("rank"))


@query("c15_pca_loadings_contributions")
def c15_pca_loadings_contributions(spark, d):
    _, loads, _ = C.pca(nation_indicators(Tables(spark, d)), IND_COLS)
    return C.contributions(loads)


@query("c16_pca_scores_rank")
def c16_pca_scores_rank(spark, d):
    ind = nation_indicators(Tables(spark, d))
    _, _, st = C.pca(ind, IND_COLS, k=2)
    return C.rank_by_pc(C.pca_scores(ind, "country", st), "country")


@query("c17_kmeans_on_scores")
def c17_kmeans_on_scores(spark, d):
    ind = nation_indicators(Tables(spark, d))
    _, _, st = C.pca(ind, IND_COLS, k=2)
    sc = C.pca_scores(ind, "country", st).withColumn("pcs", F.array("PC1", "PC2"))
    a, _ = C.kmeans(sc, "pcs", k=3, nstart=3)
    return a.select("country", "PC1", "PC2", "cluster")


@query("c17_biplot_data")
def c17_biplot_data(spark, d):
    ind = nation_indicators(Tables(spark, d))
    comps, loads, st = C.pca(ind, IND_COLS, k=2)
    return C.biplot_data(C.pca_scores(ind, "country", st), "country", loads, comps)
