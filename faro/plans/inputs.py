"""Stand-in analysis tables built from the driver's tables.

Each stand-in has a Spark builder and the same definition as a SQL
fragment (usable as a CTE in oracle queries).

* ``scored``  -- predictions table: documents joined to gold labels;
  truth = quality (1 = event), score = n_chars / (n_chars + 4000), a
  deterministic strictly monotone scorer without a cap; group = language.
* ``survey``  -- respondents with a binary outcome: orders joined to
  customer and nation; y = 'si' for urgent/high priority.
* ``items``   -- numeric regression rows from lineitem.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faro.sources.tables import Tables

# fixed values: the survey outcome levels in declared order (event = "si")
Y_LEVELS = ["no", "si"]
URGENT = ["1-URGENT", "2-HIGH"]
SCORE_HALF = 4000  # length at which the score is one half


def scored(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", "lang", "n_chars")
    lab = t.labels.select("doc_id", "quality", "toxic")
    score = F.col("n_chars").cast("double") / (F.col("n_chars") + SCORE_HALF).cast("double")
    return (d.join(lab, "doc_id")
            .select("doc_id", F.col("lang").alias("grp"), F.col("quality").alias("truth"), "toxic",
                    score.alias("score"))
            .withColumn("pred", (F.col("score") >= 0.5).cast("int")))


SCORED_SQL = f"""
SELECT d.doc_id, d.lang AS grp, l.quality AS truth, l.toxic,
       CAST(d.n_chars AS DOUBLE) / CAST(d.n_chars + {SCORE_HALF} AS DOUBLE) AS score,
       CAST(CAST(d.n_chars AS DOUBLE) / CAST(d.n_chars + {SCORE_HALF} AS DOUBLE) >= 0.5 AS INTEGER) AS pred
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def survey(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = t.nation.select("n_nationkey", "n_name")
    y = F.when(F.col("o_orderpriority").isin(URGENT), "si").otherwise("no")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("o_orderkey").alias("id"), F.col("n_name").alias("country"),
                    F.col("c_mktsegment").alias("segment"), F.col("o_orderstatus").alias("status"),
                    F.col("o_totalprice").alias("price"), F.col("c_acctbal").alias("balance"),
                    F.month("o_orderdate").alias("month"), F.year("o_orderdate").alias("year"),
                    y.alias("y")))


SURVEY_SQL = """
SELECT o.o_orderkey AS id, n.n_name AS country, c.c_mktsegment AS segment, o.o_orderstatus AS status,
       o.o_totalprice AS price, c.c_acctbal AS balance,
       CAST(month(o.o_orderdate) AS INTEGER) AS month, CAST(year(o.o_orderdate) AS INTEGER) AS year,
       CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'si' ELSE 'no' END AS y
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey"""


def items(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), "l_quantity", "l_discount", "l_tax",
        "l_extendedprice", "l_returnflag", "l_linestatus")


ITEMS_SQL = """
SELECT concat_ws('-', l_orderkey, l_linenumber) AS id, l_quantity, l_discount, l_tax, l_extendedprice,
       l_returnflag, l_linestatus FROM lineitem"""
