"""Verb queries: projections/filters (P), joins (J), aggregation/reshape (A), windows (W)."""

from __future__ import annotations

from pyspark.sql import functions as F

from faro.operators import verbs as V
from faro.plans.inputs import SURVEY_SQL, survey
from faro.plans.registry import query
from faro.sources.tables import Tables

# ---------------------------------------------------------------- P


@query("p01_select_numeric", "SELECT p_size, p_retailprice FROM part", dbl=["p_retailprice"])
def p01_select_numeric(spark, d):
    return V.select_by(Tables(spark, d).part, numeric=True, exclude=["p_partkey"])


@query("p01_select_prefix", "SELECT l_orderkey, l_linenumber FROM lineitem")
def p01_select_prefix(spark, d):
    li = Tables(spark, d).lineitem
    return V.select_by(li, ["l_orderkey"], prefix="l_line", exclude=["l_linestatus"])


@query("p02_filter", """SELECT p_partkey, p_name, p_size FROM part
WHERE p_size > 20 AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AND regexp_matches(p_name, '^(red|blue) ') AND p_type IS NOT NULL""")
def p02_filter(spark, d):
    p = Tables(spark, d).part
    return (p.filter((F.col("p_size") > 20) & F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3")
                     & F.col("p_name").rlike("^(red|blue) ") & F.col("p_type").isNotNull())
            .select("p_partkey", "p_name", "p_size"))


@query("p03_mutate", """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue, ln(l_extendedprice) AS log_price,
exp(-l_discount) AS exp_disc, abs(l_discount - 0.05) AS abs_dev FROM lineitem""",
       dbl=["revenue", "log_price", "exp_disc", "abs_dev"])
def p03_mutate(spark, d):
    li = Tables(spark, d).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
                     F.ln("l_extendedprice").alias("log_price"), F.exp(-F.col("l_discount")).alias("exp_disc"),
                     F.abs(F.col("l_discount") - 0.05).alias("abs_dev"))


@query("p04_case_when", f"""WITH s AS ({SURVEY_SQL})
SELECT CASE WHEN price < 50000 THEN 'low' WHEN price < 200000 THEN 'mid' WHEN price >= 200000 THEN 'high' ELSE 'unknown' END AS band,
count(*) AS n FROM s GROUP BY 1""")
def p04_case_when(spark, d):
    s = survey(Tables(spark, d))
    band = V.case_when([(F.col("price") < 50000, "low"), (F.col("price") < 200000, "mid"), (F.col("price") >= 200000, "high")],
                       "unknown")
    return s.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("p05_cut", """SELECT CASE WHEN l_quantity > 0 AND l_quantity <= 10 THEN 'few' WHEN l_quantity > 10 AND l_quantity <= 25 THEN 'some'
WHEN l_quantity > 25 AND l_quantity <= 45 THEN 'many' END AS qty_bin, count(*) AS n FROM lineitem GROUP BY 1""")
def p05_cut(spark, d):
    li = V.cut(Tables(spark, d).lineitem, "l_quantity", [0, 10, 25, 45], ["few", "some", "many"], out="qty_bin")
    return li.groupBy("qty_bin").agg(F.count(F.lit(1)).alias("n"))


@query("p06_cut_quantile", """WITH q AS (SELECT quantile_cont(o_totalprice, [0.0, 0.25, 0.5, 0.75, 1.0]) AS b FROM orders)
SELECT CASE WHEN o_totalprice >= b[1] AND o_totalprice <= b[2] THEN 'Q1' WHEN o_totalprice > b[2] AND o_totalprice <= b[3] THEN 'Q2'
 WHEN o_totalprice > b[3] AND o_totalprice <= b[4] THEN 'Q3' WHEN o_totalprice > b[4] AND o_totalprice <= b[5] THEN 'Q4' END AS price_q,
 count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders, q GROUP BY 1""", dbl=["lo", "hi"])
def p06_cut_quantile(spark, d):
    o = V.cut_quantile(Tables(spark, d).orders, "o_totalprice", [0.0, 0.25, 0.5, 0.75, 1.0], ["Q1", "Q2", "Q3", "Q4"],
                       out="price_q")
    return o.groupBy("price_q").agg(F.count(F.lit(1)).alias("n"), F.min("o_totalprice").alias("lo"),
                                    F.max("o_totalprice").alias("hi"))


@query("p07_rename_recode", """SELECT CASE WHEN o_orderstatus = 'F' THEN 'final' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'other' END AS status,
count(*) AS n FROM orders GROUP BY 1""")
def p07_rename_recode(spark, d):
    o = V.rename(Tables(spark, d).orders, {"o_orderstatus": "status_code"})
    return o.groupBy(V.recode("status_code", {"F": "final", "O": "open"}, "other").alias("status")).agg(
        F.count(F.lit(1)).alias("n"))


@query("p08_paste", """SELECT n_nationkey, concat_ws(' / ', n_name, r_name) AS label FROM nation JOIN region ON n_regionkey = r_regionkey""")
def p08_paste(spark, d):
    t = Tables(spark, d)
    j = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.select("n_nationkey", V.paste("n_name", "r_name", sep=" / ").alias("label"))


@query("p08_paste_collapse", """SELECT r_name, string_agg(n_name, ', ' ORDER BY n_name) AS collapsed
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def p08_paste_collapse(spark, d):
    t = Tables(spark, d)
    j = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return V.paste_collapse(j, ["r_name"], "n_name", sep=", ")


@query("p09_top_k", """SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10""",
       dbl=["c_acctbal"])
def p09_top_k(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", "c_name", "c_acctbal")
    return V.top_k(c, [F.col("c_acctbal").desc(), F.col("c_custkey")], 10)


@query("p10_distinct", """SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem""")
def p10_distinct(spark, d):
    return Tables(spark, d).lineitem.select("l_returnflag", "l_linestatus").distinct()


@query("p11_across", """SELECT l_returnflag, avg(ln(l_quantity + 1)) AS l_quantity, avg(ln(l_discount + 1)) AS l_discount,
avg(ln(l_tax + 1)) AS l_tax FROM lineitem GROUP BY 1""", dbl=["l_quantity", "l_discount", "l_tax"])
def p11_across(spark, d):
    li = Tables(spark, d).lineitem.select("l_returnflag", "l_quantity", "l_discount", "l_tax")
    t = V.across(li, lambda c: F.ln(c + 1))
    return t.groupBy("l_returnflag").agg(*[F.avg(c).alias(c) for c in ("l_quantity", "l_discount", "l_tax")])


@query("p12_scalar_filter", """SELECT o_orderstatus, count(*) AS n FROM orders
WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders) GROUP BY 1""")
def p12_scalar_filter(spark, d):
    o = Tables(spark, d).orders
    avg = o.agg(F.avg("o_totalprice").alias("_avg"))
    return (V.with_scalar(o, avg).filter(F.col("o_totalprice") > F.col("_avg"))
            .groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- J


@query("j01_left_join", """SELECT n.n_name, count(c.c_custkey) AS n_customers FROM nation n LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey
GROUP BY 1""")
def j01_left_join(spark, d):
    t = Tables(spark, d)
    j = V.left_join(t.nation, t.customer, {"n_nationkey": "c_nationkey"})
    return j.groupBy("n_name").agg(F.count("c_custkey").alias("n_customers"))


@query("j02_anti_join", """SELECT lang, count(*) AS n_unlabelled FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY 1""")
def j02_anti_join(spark, d):
    t = Tables(spark, d)
    unlabelled = V.anti_join(t.documents.select("doc_id", "lang"), t.labels.select("doc_id"), ["doc_id"])
    return unlabelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n_unlabelled"))


@query("j03_semi_join", """SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)""")
def j03_semi_join(spark, d):
    t = Tables(spark, d)
    big = t.lineitem.filter(F.col("l_quantity") >= 50).select(F.col("l_partkey").alias("p_partkey"))
    return V.semi_join(t.part.select("p_partkey", "p_brand"), big, ["p_partkey"])


@query("j04_attach_predictions", """SELECT d.doc_id, d.lang, CAST(d.n_chars AS DOUBLE) / CAST(d.n_chars + 4000 AS DOUBLE) AS score
FROM documents d""", dbl=["score"])
def j04_attach_predictions(spark, d):
    docs = Tables(spark, d).documents
    preds = docs.select("doc_id", (F.col("n_chars").cast("double") / (F.col("n_chars") + 4000).cast("double")).alias("score"))
    return V.attach_predictions(docs.select("doc_id", "lang"), preds, "doc_id")


@query("j05_bind_rows", """SELECT src, count(*) AS n, count_if(acctbal IS NULL) AS n_null_bal, count_if(segment IS NULL) AS n_null_seg FROM (
SELECT 'customer' AS src, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL BY NAME SELECT 'supplier' AS src, s_name AS name, s_acctbal AS acctbal FROM supplier
UNION ALL BY NAME SELECT 'nation' AS src, n_name AS name FROM nation) GROUP BY 1""", big=["n_null_bal", "n_null_seg"])
def j05_bind_rows(spark, d):
    t = Tables(spark, d)
    a = t.customer.select(F.lit("customer").alias("src"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"),
                          F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.lit("supplier").alias("src"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    c = t.nation.select(F.lit("nation").alias("src"), F.col("n_name").alias("name"))
    u = V.bind_rows(a, b, c)
    return u.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("acctbal").isNull()).alias("n_null_bal"),
                                F.count_if(F.col("segment").isNull()).alias("n_null_seg"))


@query("j06_param_cross", """SELECT t, count_if(l_discount >= t) AS n_at_least FROM lineitem,
(SELECT CAST(t AS DOUBLE) AS t FROM (VALUES (0.02), (0.05), (0.08)) v(t)) GROUP BY t""", dbl=["t"], big=["n_at_least"])
def j06_param_cross(spark, d):
    grid = V.param_grid(spark, t=[0.02, 0.05, 0.08])
    j = V.with_params(Tables(spark, d).lineitem.select("l_discount"), grid)
    return j.groupBy("t").agg(F.count_if(F.col("l_discount") >= F.col("t")).alias("n_at_least"))


# ---------------------------------------------------------------- A


@query("a01_summarise", """SELECT l_returnflag, count(*) AS n, avg(l_quantity) AS mean, stddev_samp(l_quantity) AS sd, sum(l_quantity) AS sum,
min(l_quantity) AS min, max(l_quantity) AS max, quantile_cont(l_quantity, 0.5) AS median FROM lineitem GROUP BY 1""",
       dbl=["mean", "sd", "sum", "min", "max", "median"])
def a01_summarise(spark, d):
    return V.summarise(Tables(spark, d).lineitem, ["l_returnflag"], "l_quantity")


@query("a03_per_call_grouping", f"""WITH s AS ({SURVEY_SQL}), g AS (SELECT country, status, avg(price) AS mean_price FROM s GROUP BY ALL)
SELECT status, count(*) AS n, avg(mean_price) AS mean, stddev_samp(mean_price) AS sd, sum(mean_price) AS sum, min(mean_price) AS min, max(mean_price) AS max
FROM g GROUP BY status""", dbl=["mean", "sd", "sum", "min", "max"])
def a03_per_call_grouping(spark, d):
    """Each call names its own grouping: means by country and status, then their spread by status."""
    g = V.summarise(survey(Tables(spark, d)), ["country", "status"], "price", median=False).select("country", "status", F.col("mean").alias("mean_price"))
    return V.summarise(g, ["status"], "mean_price", median=False)


@query("a02_conditional_counts", f"""WITH s AS ({SURVEY_SQL})
SELECT segment, count_if(y = 'si') AS n_si, avg(CAST(y = 'si' AS DOUBLE)) AS share_si, count(*) AS n FROM s GROUP BY 1""",
       dbl=["share_si"], big=["n_si"])
def a02_conditional_counts(spark, d):
    s = survey(Tables(spark, d))
    return s.groupBy("segment").agg(F.count_if(F.col("y") == "si").alias("n_si"),
                                    F.avg((F.col("y") == "si").cast("double")).alias("share_si"), F.count(F.lit(1)).alias("n"))


@query("a04_pivot_longer", """SELECT l_orderkey, l_linenumber, name, value FROM lineitem
UNPIVOT (value FOR name IN (l_quantity, l_discount, l_tax))""", dbl=["value"])
def a04_pivot_longer(spark, d):
    li = Tables(spark, d).lineitem
    return V.pivot_longer(li.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"),
                          ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])


@query("a05_pivot_wider", f"""WITH s AS ({SURVEY_SQL}), c AS (SELECT segment, status, count(*) AS n FROM s GROUP BY ALL)
SELECT segment, COALESCE(max(n) FILTER (WHERE status = 'F'), 0) AS status_F, COALESCE(max(n) FILTER (WHERE status = 'O'), 0) AS status_O,
COALESCE(max(n) FILTER (WHERE status = 'P'), 0) AS status_P, COALESCE(max(n) FILTER (WHERE status = 'X'), 0) AS status_X FROM c GROUP BY 1""")
def a05_pivot_wider(spark, d):
    s = survey(Tables(spark, d))
    c = s.groupBy("segment", "status").agg(F.count(F.lit(1)).alias("n"))
    return V.pivot_wider(c, ["segment"], "status", "n", ["F", "O", "P", "X"], fill=0, prefix="status_")


@query("a05_pivot_wider_two_values", f"""WITH s AS ({SURVEY_SQL}), c AS (SELECT y, status, count(*) AS n, avg(price) / 1000 AS price FROM s GROUP BY ALL)
SELECT y, max(n) FILTER (WHERE status = 'F') AS n_F, max(price) FILTER (WHERE status = 'F') AS price_F,
max(n) FILTER (WHERE status = 'O') AS n_O, max(price) FILTER (WHERE status = 'O') AS price_O FROM c GROUP BY 1""",
       dbl=["price_F", "price_O"])
def a05_pivot_wider_two_values(spark, d):
    s = survey(Tables(spark, d))
    c = s.groupBy("y", "status").agg(F.count(F.lit(1)).alias("n"), (F.avg("price") / 1000).alias("price"))
    return V.pivot_wider(c, ["y"], "status", ["n", "price"], ["F", "O"])


@query("a06_histogram", """SELECT CAST(floor(o_totalprice / 50000.0) AS BIGINT) AS bin, count(*) AS n, floor(o_totalprice / 50000.0) * 50000.0 AS bin_start
FROM orders GROUP BY ALL""", dbl=["bin_start"])
def a06_histogram(spark, d):
    return V.histogram(Tables(spark, d).orders, "o_totalprice", 50000.0)


@query("a06_boxplot_stats", """WITH q AS (SELECT l_returnflag, quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.5) AS median,
quantile_cont(l_quantity, 0.75) AS q3 FROM lineitem GROUP BY 1)
SELECT l_returnflag, q1, median, q3,
 min(CASE WHEN l_quantity >= q1 - 1.5 * (q3 - q1) AND l_quantity <= q3 + 1.5 * (q3 - q1) THEN l_quantity END) AS whisker_low,
 max(CASE WHEN l_quantity >= q1 - 1.5 * (q3 - q1) AND l_quantity <= q3 + 1.5 * (q3 - q1) THEN l_quantity END) AS whisker_high,
 CAST(count_if(NOT (l_quantity >= q1 - 1.5 * (q3 - q1) AND l_quantity <= q3 + 1.5 * (q3 - q1))) AS BIGINT) AS n_outliers
FROM lineitem JOIN q USING (l_returnflag) GROUP BY ALL""", dbl=["q1", "median", "q3", "whisker_low", "whisker_high"])
def a06_boxplot_stats(spark, d):
    return V.boxplot_stats(Tables(spark, d).lineitem, "l_quantity", ["l_returnflag"])


@query("a06_trend_line", """SELECT l_returnflag, regr_intercept(l_extendedprice / 1000, l_quantity) AS intercept,
regr_slope(l_extendedprice / 1000, l_quantity) AS slope, regr_r2(l_extendedprice / 1000, l_quantity) AS r2,
CAST(regr_count(l_extendedprice / 1000, l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY 1""", dbl=["intercept", "slope", "r2"])
def a06_trend_line(spark, d):
    li = Tables(spark, d).lineitem.withColumn("price_k", F.col("l_extendedprice") / 1000)
    return V.trend_line(li, "price_k", "l_quantity", ["l_returnflag"])


@query("a06_error_bars", """SELECT o_orderstatus, avg(o_totalprice) / 1000 AS mean, stddev_samp(o_totalprice) / 1000 / sqrt(count(*)) AS se,
avg(o_totalprice) / 1000 - 1.96 * stddev_samp(o_totalprice) / 1000 / sqrt(count(*)) AS lower,
avg(o_totalprice) / 1000 + 1.96 * stddev_samp(o_totalprice) / 1000 / sqrt(count(*)) AS upper FROM orders GROUP BY 1""",
       dbl=["mean", "se", "lower", "upper"])
def a06_error_bars(spark, d):
    o = Tables(spark, d).orders.withColumn("price_k", F.col("o_totalprice") / 1000)
    return V.error_bars(o, "price_k", ["o_orderstatus"])


@query("a07_group_profile_cube", f"""WITH s AS ({SURVEY_SQL})
SELECT segment, status, CAST(grouping(segment, status) AS INTEGER) AS level, count(*) AS n, avg(CAST(y = 'si' AS DOUBLE)) AS share
FROM s GROUP BY CUBE (segment, status)""", dbl=["share"])
def a07_group_profile_cube(spark, d):
    return V.group_profile_cube(survey(Tables(spark, d)), ["segment", "status"], "y", "si")


# ---------------------------------------------------------------- W


@query("w01_share_within", f"""WITH s AS ({SURVEY_SQL}), c AS (SELECT segment, status, count(*) AS n FROM s GROUP BY ALL)
SELECT segment, status, n, n / CAST(sum(n) OVER (PARTITION BY segment) AS DOUBLE) AS share FROM c""", dbl=["share"])
def w01_share_within(spark, d):
    s = survey(Tables(spark, d))
    c = s.groupBy("segment", "status").agg(F.count(F.lit(1)).alias("n"))
    return V.share_within(c, "n", ["segment"])


@query("w02_slice_max_ties", """SELECT p_brand, p_partkey, p_size FROM (SELECT *, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS r FROM part)
WHERE r <= 3""")
def w02_slice_max_ties(spark, d):
    p = Tables(spark, d).part.select("p_brand", "p_partkey", "p_size")
    return V.slice_max(p, ["p_brand"], "p_size", 3, with_ties=True)


@query("w02_slice_max_no_ties", """SELECT p_brand, p_partkey, p_size FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS r FROM part)
WHERE r <= 3""")
def w02_slice_max_no_ties(spark, d):
    p = Tables(spark, d).part.select("p_brand", "p_partkey", "p_size")
    return V.slice_max(p, ["p_brand"], "p_size", 3, with_ties=False, tiebreak=["p_partkey"])


@query("w03_slice_head", """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders)
WHERE r <= 1""")
def w03_slice_head(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return V.slice_head(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], 1).select("o_custkey", "o_orderkey")


@query("w04_slice_sample", """SELECT lang, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5(concat_ws(':', '42', CAST(doc_id AS VARCHAR))), doc_id) AS r
FROM documents) WHERE r <= 5""")
def w04_slice_sample(spark, d):
    docs = Tables(spark, d).documents.select("lang", "doc_id")
    return V.slice_sample(docs, ["lang"], "doc_id", 5, seed=42)


@query("w05_rank_within", """WITH c AS (SELECT r_name, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)
SELECT r_name, n_name, n, row_number() OVER (PARTITION BY r_name ORDER BY n DESC, n_name) AS rank FROM c""")
def w05_rank_within(spark, d):
    t = Tables(spark, d)
    j = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    c = j.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("n"))
    return V.rank_within(c, ["r_name"], "n", tiebreak=["n_name"])


@query("w06_rolling", """SELECT event_id, user_id, count(value) OVER w AS roll_n, sum(value) OVER w AS roll_sum, avg(value) OVER w AS roll_mean
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW)""",
       dbl=["roll_sum", "roll_mean"])
def w06_rolling(spark, d):
    e = Tables(spark, d).events.select("event_id", "user_id", "ts", "value")
    return V.rolling(e, "user_id", "ts", "value", 86400).select("event_id", "user_id", "roll_n", "roll_sum", "roll_mean")


@query("w06_lag_diff", """SELECT event_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS diff FROM events""", dbl=["diff"])
def w06_lag_diff(spark, d):
    e = Tables(spark, d).events.select("event_id", "user_id", "ts", "value")
    return V.lag_diff(e, "user_id", "ts", "value", "event_id").select("event_id", "diff")
