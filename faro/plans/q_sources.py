"""Source / sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from faro.functions.core import as_factor, level_index
from faro.sources import io as S
from faro.plans.registry import query

NATION_SCHEMA = T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
                              T.StructField("n_regionkey", T.IntegerType())])


@query("s01_read_table_schema", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def s01_read_table_schema(spark, d):
    return S.read_table(spark, f"{d}/nation.parquet", NATION_SCHEMA, fmt="parquet")


# fixed values: declared factor levels (subset, in order) for the priority column
LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


@query("s02_as_factor", """SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN o_orderpriority END AS priority,
CAST(list_position(['1-URGENT', '2-HIGH', '3-MEDIUM'], o_orderpriority) AS INTEGER) AS level, count(*) AS n FROM orders GROUP BY ALL""")
def s02_as_factor(spark, d):
    o = S.read_table(spark, f"{d}/orders.parquet", fmt="parquet")
    return o.groupBy(as_factor("o_orderpriority", LEVELS).alias("priority"),
                     level_index("o_orderpriority", LEVELS).alias("level")).agg(F.count(F.lit(1)).alias("n"))


@query("s03_read_csv_text", """SELECT r.r_name, n.n_name, n.n_nationkey FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")
def s03_read_csv_text(spark, d):
    """Each region holds a CSV text of its nations (as a model response would); parse it back to rows."""
    n = S.read_table(spark, f"{d}/nation.parquet", fmt="parquet")
    r = S.read_table(spark, f"{d}/region.parquet", fmt="parquet")
    lines = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(
        F.concat_ws("\n", F.lit("n_name,n_nationkey"),
                    F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))),
                                             lambda s: F.concat_ws(",", s["n_name"], s["n_nationkey"].cast("string"))), "\n")).alias("csv"))
    return S.read_csv_text(lines, "csv", "n_name STRING, n_nationkey INT", keep=["r_name"])


@query("s03_read_csv_quoted", """SELECT page_id, 1 AS part, url, md5(html) AS html_md5, CAST(length(html) AS BIGINT) AS n FROM pages
UNION ALL SELECT page_id, 2, 'a "quoted" name, with a comma', md5('one' || chr(10) || chr(10) || 'two "2"'), 12 FROM pages""")
def s03_read_csv_quoted(spark, d):
    """Each page as a CSV text of two records, the fields quoted with their line breaks, commas and doubled quotes; parsed back."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    p = S.read_table(spark, f"{d}/pages.parquet", fmt="parquet")
    csv = F.concat(F.lit("part,url,html\r\n1,"), quoted(F.col("url")), F.lit(","), quoted(F.col("html")), F.lit("\r\n\n2,"), quoted(F.lit('a "quoted" name, with a comma')),
                   F.lit(","), quoted(F.lit('one\n\ntwo "2"')), F.lit("\n"))
    rows = S.read_csv_text(p.select("page_id", csv.alias("csv")), "csv", "part INT, url STRING, html STRING", keep=["page_id"])
    return rows.select("page_id", "part", "url", F.md5(F.col("html")).alias("html_md5"), F.length("html").cast("long").alias("n"))


@query("s05_run_manifest", """SELECT doc_id, 'keyword-annotator' AS run_model, '0.1' AS run_version, '2026-01-01' AS run_date,
'{"k": 3, "temperature": 0}' AS run_params FROM documents""")
def s05_run_manifest(spark, d):
    docs = S.read_table(spark, f"{d}/documents.parquet", fmt="parquet").select("doc_id")
    return S.with_manifest(docs, "keyword-annotator", "0.1", {"temperature": 0, "k": 3}, run_date="2026-01-01")


@query("s04_write_table_roundtrip")
def s04_write_table_roundtrip(spark, d):
    """Write a table to the shared checkpoint folder and read it back (row counts by partition)."""
    import uuid

    from faro.session import checkpoint_dir

    out = f"{checkpoint_dir(spark).rstrip('/')}/s04_{uuid.uuid4().hex}"
    li = S.read_table(spark, f"{d}/lineitem.parquet", fmt="parquet")
    S.write_table(li.select("l_orderkey", "l_linenumber", "l_returnflag"), out, partition_by=["l_returnflag"])
    back = spark.read.parquet(out)
    return back.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


def _scratch(spark, name):
    import uuid

    from faro.session import checkpoint_dir

    return f"{checkpoint_dir(spark).rstrip('/')}/{name}_{uuid.uuid4().hex}"


@query("s01_read_table_csv", "SELECT doc_id, NULLIF(text, '') AS text, lang, n_chars FROM documents")
def s01_read_table_csv(spark, d):
    """Whole documents (quotes, commas, line breaks, accents) written as CSV and read back with a declared schema; an empty field is NULL."""
    docs = S.read_table(spark, f"{d}/documents.parquet", fmt="parquet").select("doc_id", "text", "lang", "n_chars")
    out = _scratch(spark, "s01_csv")
    S.write_table(docs, out, fmt="csv")
    return S.read_table(spark, out, docs.schema, fmt="csv", multiLine=True)


@query("s05_run_log", """SELECT run_date, 'keyword-annotator' AS run_model, '0.1' AS run_version, '{"k": 3}' AS run_params, count(*) AS n, sum(n_chars) AS raw_chars
FROM documents, (VALUES ('2026-01-01'), ('2026-01-02')) v(run_date) GROUP BY ALL""", big=["raw_chars"])
def s05_run_log(spark, d):
    """Two runs appended with their raw responses (here the texts) to one log; a day's log is one partition."""
    docs = S.read_table(spark, f"{d}/documents.parquet", fmt="parquet").select("doc_id", F.col("text").alias("raw_response"))
    out = _scratch(spark, "s05_log")
    for day in ("2026-01-01", "2026-01-02"):
        S.append_run(docs, out, "keyword-annotator", "0.1", {"k": 3}, run_date=day)
    log = spark.read.schema("doc_id long, raw_response string, run_version string, run_params string, run_date string, run_model string").parquet(out)
    return log.groupBy("run_date", "run_model", "run_version", "run_params").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("raw_response")).cast("bigint").alias("raw_chars"))
