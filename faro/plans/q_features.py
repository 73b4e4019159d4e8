"""Feature queries (E01-E05) on events, orders, documents and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from faro.operators import features as E
from faro.plans.registry import query
from faro.sources.tables import Tables

AS_OF = "2024-02-01"

# fixed values: order priorities in their declared (ordinal) order
PRIORITY_LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("e01_rfm_features", f"""SELECT user_id, CAST(date_diff('day', CAST(min(ts) AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_since_first,
CAST(date_diff('day', CAST(max(ts) AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_since_last, count(*) AS n_events,
avg(value) AS mean_amount, sum(value) AS total_amount, regr_slope(value, epoch_us(ts) / 86400000000.0) AS trend
FROM events WHERE event_type = 'purchase' GROUP BY user_id""", dbl=["mean_amount", "total_amount", "trend"])
def e01_rfm_features(spark, d):
    e = Tables(spark, d).events.filter(F.col("event_type") == "purchase")
    return E.rfm_features(e, "user_id", "ts", "value", AS_OF)


@query("e02_calendar_features", """SELECT CAST(isodow(o_orderdate) AS INTEGER) AS o_orderdate_weekday, CAST(month(o_orderdate) AS INTEGER) AS o_orderdate_month,
CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year, count(*) AS n FROM orders GROUP BY ALL""")
def e02_calendar_features(spark, d):
    o = E.calendar_features(Tables(spark, d).orders, "o_orderdate")
    return o.groupBy("o_orderdate_weekday", "o_orderdate_month", "o_orderdate_year").agg(F.count(F.lit(1)).alias("n"))


@query("e03_text_length", r"""SELECT doc_id, CAST(length(text) AS INTEGER) AS text_chars,
CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS INTEGER) AS text_words FROM documents""")
def e03_text_length(spark, d):
    return E.text_length_features(Tables(spark, d).documents, "text").select("doc_id", "text_chars", "text_words")


@query("e04_numeric_transforms", """SELECT l_returnflag, avg(ln(l_quantity + 1)) AS log_q, avg(sqrt(l_quantity)) AS sqrt_q, avg(l_quantity * l_quantity) AS sq_q,
avg(l_extendedprice / NULLIF(l_quantity, 0)) AS unit_price, avg(l_quantity * l_discount) AS qty_x_disc FROM lineitem GROUP BY 1""",
       dbl=["log_q", "sqrt_q", "sq_q", "unit_price", "qty_x_disc"])
def e04_numeric_transforms(spark, d):
    li = E.numeric_transforms(Tables(spark, d).lineitem, "l_quantity", 1.0)
    li = li.withColumn("unit_price", E.ratio("l_extendedprice", "l_quantity"))
    return li.groupBy("l_returnflag").agg(F.avg("l_quantity_log").alias("log_q"), F.avg("l_quantity_sqrt").alias("sqrt_q"),
                                          F.avg("l_quantity_sq").alias("sq_q"), F.avg("unit_price").alias("unit_price"),
                                          F.avg(F.col("l_quantity") * F.col("l_discount")).alias("qty_x_disc"))


_lv = ", ".join(f"'{x}'" for x in PRIORITY_LEVELS)


@query("e05_label_encode", f"""SELECT CAST(list_position([{_lv}], o_orderpriority) AS INTEGER) AS o_orderpriority_code, count(*) AS n
FROM orders GROUP BY 1""")
def e05_label_encode(spark, d):
    o = E.label_encode(Tables(spark, d).orders, "o_orderpriority", PRIORITY_LEVELS)
    return o.groupBy("o_orderpriority_code").agg(F.count(F.lit(1)).alias("n"))
