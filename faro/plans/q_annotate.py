"""Annotation-batch queries (N01-N16) on documents, events, conversations, nations and benchmark."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from faro.operators import annotate as N
from faro.operators import text as TX
from faro.plans.inputs import SCORED_SQL, scored
from faro.plans.q_text import CLEAN_SQL, NEG, POS, TOK_SQL, _lex, _triples
from faro.plans.registry import query
from faro.sources.tables import Tables

PERSONA = "You are an expert annotator of survey and news texts."
TASK = "Classify the main theme of the text."
FORMAT = 'JSON {"theme": "...", "confidence": 0.0-1.0}'
EXAMPLES = [("Prices keep rising every month.", "economy"), ("Robberies in my street.", "security")]


def _q(s: str) -> str:
    return s.replace("'", "''")


def _prompt_parts():
    shots = "".join(f"Example: {x}\nAnswer: {y}\n\n" for x, y in EXAMPLES)
    head = f"{PERSONA}\n\nTask: {TASK}\n\n{shots}Text: "
    tail = f"\n\nAnswer format: {FORMAT}"
    return head, tail


_head, _tail = _prompt_parts()


@query("n01_render_prompts", f"""SELECT doc_id, md5(concat('{_q(_head)}', text, '{_q(_tail)}')) AS prompt_md5,
CAST(length(concat('{_q(_head)}', text, '{_q(_tail)}')) AS INTEGER) AS prompt_chars FROM documents""")
def n01_render_prompts(spark, d):
    p = N.render_prompts(Tables(spark, d).documents, "text", PERSONA, TASK, FORMAT, EXAMPLES)
    return p.select("doc_id", F.md5("prompt").alias("prompt_md5"), F.char_length("prompt").alias("prompt_chars"))


THEMES = {"nominal": ["tion", "ción", "heit", "keit", "ung"], "adverbial": ["ment", "mente", "ly"], "verbal": ["ing", "ado", "erte"]}


@query("n02_annotate_batch")
def n02_annotate_batch(spark, d):
    """Distinct prompts annotated once by the offline keyword annotator (mapInPandas); label counts."""
    p = N.render_prompts(Tables(spark, d).documents, "text", PERSONA, TASK, FORMAT, EXAMPLES)
    out, _ = N.annotate(p, "prompt", N.keyword_annotator(THEMES))
    return out.groupBy("response").agg(F.count(F.lit(1)).alias("n"))


ALLOWED = ["view", "click", "purchase", "signup"]


@query("n03_normalize_label", """SELECT CASE WHEN lower(trim(concat('  ', upper(event_type), ' '))) IN ('view', 'click', 'purchase', 'signup')
THEN lower(trim(concat('  ', upper(event_type), ' '))) END AS label, count(*) AS n FROM events GROUP BY 1""")
def n03_normalize_label(spark, d):
    e = Tables(spark, d).events.withColumn("raw", F.concat(F.lit("  "), F.upper("event_type"), F.lit(" ")))
    return e.groupBy(N.normalize_label("raw", ALLOWED).alias("label")).agg(F.count(F.lit(1)).alias("n"))


_VARIANTS_SQL = """v AS (SELECT event_id, 'ok' AS variant, props AS s FROM events
 UNION ALL SELECT event_id, 'truncated', substr(props, 1, length(props) - 1) FROM events
 UNION ALL SELECT event_id, 'wrong_type', replace(replace(props, ': ', ': "x'), '}', '"}') FROM events)"""


@query("n04_parse_json", f"""WITH {_VARIANTS_SQL},
jt AS (SELECT *, CASE WHEN json_valid(s) THEN json_type(json_extract(s, '$.k')) END AS jt FROM v)
SELECT event_id, variant, CASE WHEN jt IN ('BIGINT', 'UBIGINT') THEN CAST(json_extract_string(s, '$.k') AS INTEGER) END AS k,
  s IS NULL OR NOT json_valid(s) OR COALESCE(jt NOT IN ('BIGINT', 'UBIGINT', 'NULL'), false) AS parse_error
FROM jt""")
def n04_parse_json(spark, d):
    e = Tables(spark, d).events.select("event_id", "props")
    v = (e.select("event_id", F.lit("ok").alias("variant"), F.col("props").alias("s"))
         .unionByName(e.select("event_id", F.lit("truncated").alias("variant"), F.expr("substr(props, 1, length(props) - 1)").alias("s")))
         .unionByName(e.select("event_id", F.lit("wrong_type").alias("variant"),
                               F.replace(F.replace("props", F.lit(": "), F.lit(': "x')), F.lit("}"), F.lit('"}')).alias("s"))))
    p = N.parse_json(v, "s", T.StructType([T.StructField("k", T.IntegerType())]))
    return p.select("event_id", "variant", F.col("parsed.k").alias("k"), "parse_error")


@query("n05_unnest_explode_entities", r"""WITH a AS (SELECT doc_id, lang, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ents FROM documents)
SELECT doc_id, lang AS resp_lang, CAST(generate_subscripts(ents, 1) AS INTEGER) AS entity_pos, unnest(ents) AS entity FROM a""")
def n05_unnest_explode_entities(spark, d):
    docs = Tables(spark, d).documents
    resp = docs.select("doc_id", F.to_json(F.struct("lang", TX.tokens("text").alias("entities"))).alias("json"))
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("entities", T.ArrayType(T.StringType()))])
    p = N.unnest_struct(N.parse_json(resp, "json", schema).select("doc_id", "parsed"), "parsed", prefix="resp_")
    return N.explode_entities(p, "resp_entities")


LEX_LABEL_SQL = f"""WITH {TOK_SQL}, lx AS (SELECT * FROM (VALUES {_lex}) v(token, valence)),
h AS (SELECT doc_id, sum(valence) AS sc FROM tk JOIN lx USING (token) GROUP BY 1),
s AS ({SCORED_SQL}),
a AS (SELECT s.*, CAST(COALESCE(h.sc, 0) > 0 AS INTEGER) AS lex_label FROM s LEFT JOIN h USING (doc_id))
"""


def _lex_labelled(spark, d):
    t = Tables(spark, d)
    lex = TX.lexicon_table(spark, POS, NEG)
    tok = TX.tokenize(t.documents, "doc_id", "text")
    s = TX.lexicon_sentiment(tok, t.documents, "doc_id", lex)
    return scored(t).join(s.select("doc_id", (F.col("score") > 0).cast("int").alias("lex_label")), "doc_id", "left")


@query("n06_evaluate_annotations", LEX_LABEL_SQL + """, c AS (SELECT grp, CAST(truth AS VARCHAR) AS t, CAST(lex_label AS VARCHAR) AS l, count(*) AS n FROM a GROUP BY ALL),
cls AS (SELECT DISTINCT grp, t AS cls FROM c UNION SELECT DISTINCT grp, l FROM c),
per AS (SELECT cls.grp, cls.cls, sum(CASE WHEN t = cls AND l = cls THEN n ELSE 0 END) AS tp, sum(CASE WHEN t <> cls AND l = cls THEN n ELSE 0 END) AS fp,
        sum(CASE WHEN t = cls AND l <> cls THEN n ELSE 0 END) AS fn FROM cls JOIN c USING (grp) GROUP BY ALL),
pr AS (SELECT grp, tp / NULLIF(CAST(tp + fp AS DOUBLE), 0) AS p, tp / NULLIF(CAST(tp + fn AS DOUBLE), 0) AS r FROM per),
m AS (SELECT grp, avg(p) AS macro_precision, avg(r) AS macro_recall, avg(2 * p * r / NULLIF(p + r, 0)) AS macro_f1 FROM pr GROUP BY 1),
acc AS (SELECT grp, avg(CAST(truth = lex_label AS DOUBLE)) AS accuracy, count(*) AS n FROM a GROUP BY 1)
SELECT * FROM acc JOIN m USING (grp)""", dbl=["accuracy", "macro_precision", "macro_recall", "macro_f1"])
def n06_evaluate_annotations(spark, d):
    return N.evaluate_annotations(_lex_labelled(spark, d), "truth", "lex_label", by=["grp"])


@query("n07_error_listing", LEX_LABEL_SQL + "SELECT doc_id, grp, truth, lex_label FROM a WHERE truth <> lex_label")
def n07_error_listing(spark, d):
    return N.error_listing(_lex_labelled(spark, d), "truth", "lex_label", ["doc_id", "grp"])


ANN_SQL = LEX_LABEL_SQL + """, w AS (SELECT doc_id, pred AS a1, lex_label AS a2, CAST(score >= 0.3 AS INTEGER) AS a3 FROM a)
"""


def _three(spark, d):
    a = _lex_labelled(spark, d)
    return a.select("doc_id", F.col("pred").alias("a1"), F.col("lex_label").alias("a2"), (F.col("score") >= 0.3).cast("int").alias("a3"))


def _kappa_sql(x, y):
    return f"""SELECT '{x}' AS annotator_a, '{y}' AS annotator_b, avg(CAST({x} = {y} AS DOUBLE)) AS agreement,
 (avg(CAST({x} = {y} AS DOUBLE)) - (avg(CAST({x} = 1 AS DOUBLE)) * avg(CAST({y} = 1 AS DOUBLE)) + avg(CAST({x} = 0 AS DOUBLE)) * avg(CAST({y} = 0 AS DOUBLE))))
 / NULLIF(1 - (avg(CAST({x} = 1 AS DOUBLE)) * avg(CAST({y} = 1 AS DOUBLE)) + avg(CAST({x} = 0 AS DOUBLE)) * avg(CAST({y} = 0 AS DOUBLE))), 0) AS kap FROM w"""


@query("n08_agreement", ANN_SQL + " UNION ALL ".join(_kappa_sql(x, y) for x, y in [("a1", "a2"), ("a1", "a3"), ("a2", "a3")]),
       dbl=["agreement", "kap"])
def n08_agreement(spark, d):
    return N.agreement(_three(spark, d), "doc_id", ["a1", "a2", "a3"])


@query("n08_majority_vote", ANN_SQL + """SELECT CASE WHEN a1 + a2 + a3 >= 2 THEN '1' ELSE '0' END AS majority, count(*) AS n FROM w GROUP BY 1""")
def n08_majority_vote(spark, d):
    v = N.majority_vote(_three(spark, d), "doc_id", ["a1", "a2", "a3"])
    return v.groupBy("majority").agg(F.count(F.lit(1)).alias("n"))


# query parameter: invented costs per item; elapsed time differs by run, so the checked query leaves it out
COST = {"length_rule": 0.0, "lexicon": 0.001}


@query("n09_method_comparison", LEX_LABEL_SQL + """SELECT 'length_rule' AS method, avg(CAST(truth = pred AS DOUBLE)) AS accuracy, count(*) AS n,
count(*) * 0.0 AS cost FROM a
UNION ALL SELECT 'lexicon', avg(CAST(truth = lex_label AS DOUBLE)), count(*), count(*) * 0.001 FROM a""",
       dbl=["accuracy", "cost"])
def n09_method_comparison(spark, d):
    a = _lex_labelled(spark, d)
    return N.method_comparison({"length_rule": a.withColumn("lab", F.col("pred")), "lexicon": a.withColumn("lab", F.col("lex_label"))},
                               "truth", "lab", COST)


@query("n10_validation_sample", """SELECT lang, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5(concat_ws(':', '7', CAST(doc_id AS VARCHAR))), doc_id) AS r
FROM documents) WHERE r <= 3""")
def n10_validation_sample(spark, d):
    return N.validation_sample(Tables(spark, d).documents.select("doc_id", "lang"), "doc_id", ["lang"], 3, seed=7)


TEMPLATES = ["Describe the economic outlook of {value}.", "Is {value} a safe country to live in?"]


@query("n11_audit_pairs", """SELECT n_name, CAST(t.template_id AS INTEGER) AS template_id, t.template,
replace(t.template, '{value}', n_name) AS prompt FROM (SELECT DISTINCT n_name FROM nation),
(VALUES (1, 'Describe the economic outlook of {value}.'), (2, 'Is {value} a safe country to live in?')) t(template_id, template)""")
def n11_audit_pairs(spark, d):
    return N.audit_pairs(Tables(spark, d).nation, "n_name", TEMPLATES)


_CONV_TONE = r"""WITH tk AS (SELECT conv_id, turn, role, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS token FROM conversations),
lx AS (SELECT * FROM (VALUES """ + _lex + r""") v(token, valence)),
sc AS (SELECT c.conv_id, c.turn, c.role, COALESCE(sum(lx.valence), 0) AS s FROM conversations c LEFT JOIN (tk JOIN lx USING (token))
       ON tk.conv_id = c.conv_id AND tk.turn = c.turn GROUP BY ALL),
t AS (SELECT role, CASE WHEN s > 0 THEN 'optimistic' WHEN s < 0 THEN 'pessimistic' ELSE 'neutral' END AS tone,
      abs(s) / CAST(abs(s) + 5 AS DOUBLE) AS confidence FROM sc)
"""


@query("n12_audit_report", _CONV_TONE + """, g AS (SELECT role, tone, count(*) AS n, avg(confidence) AS mean_confidence FROM t GROUP BY ALL),
gt AS (SELECT role, count(*) AS ng FROM t GROUP BY 1), ov AS (SELECT tone, count(*) AS nt FROM t GROUP BY 1), nn AS (SELECT count(*) AS n_all FROM t)
SELECT role, tone, n, mean_confidence, n / CAST(ng AS DOUBLE) AS share, n / CAST(ng AS DOUBLE) - nt / CAST(n_all AS DOUBLE) AS gap_to_overall
FROM g JOIN gt USING (role) JOIN ov USING (tone), nn""", dbl=["mean_confidence", "share", "gap_to_overall"])
def n12_audit_report(spark, d):
    conv = Tables(spark, d).conversations
    tok = TX.tokenize(conv, ["conv_id", "turn"], "text")
    lex = TX.lexicon_table(spark, POS, NEG)
    hits = tok.join(F.broadcast(lex), "token").groupBy("conv_id", "turn").agg(F.sum("valence").alias("s"))
    sc = conv.select("conv_id", "turn", "role").join(hits, ["conv_id", "turn"], "left").fillna(0, subset=["s"])
    t = sc.select("role", F.when(F.col("s") > 0, "optimistic").when(F.col("s") < 0, "pessimistic").otherwise("neutral").alias("tone"),
                  (F.abs("s") / (F.abs("s") + 5)).alias("confidence"))
    return N.audit_report(t, "role", "tone", "confidence")


@query("n13_compare_synthetic_shares", """WITH r AS (SELECT o_orderpriority, count(*) AS n FROM orders WHERE year(o_orderdate) < 1998 GROUP BY 1),
s AS (SELECT o_orderpriority, count(*) AS n FROM orders WHERE year(o_orderdate) >= 1998 GROUP BY 1),
j AS (SELECT COALESCE(r.o_orderpriority, s.o_orderpriority) AS o_orderpriority, COALESCE(r.n / CAST(sum(r.n) OVER () AS DOUBLE), 0.0) AS share_real,
      COALESCE(s.n / CAST(sum(s.n) OVER () AS DOUBLE), 0.0) AS share_synth FROM r FULL JOIN s USING (o_orderpriority))
SELECT *, share_synth - share_real AS diff, 0.5 * sum(abs(share_synth - share_real)) OVER () AS tvd FROM j""",
       dbl=["share_real", "share_synth", "diff", "tvd"])
def n13_compare_synthetic_shares(spark, d):
    o = Tables(spark, d).orders
    return N.compare_category_shares(o.filter(F.year("o_orderdate") < 1998), o.filter(F.year("o_orderdate") >= 1998), "o_orderpriority")


@query("n13_compare_synthetic_means", """WITH r AS (SELECT * FROM lineitem WHERE l_returnflag = 'N'), s AS (SELECT * FROM lineitem WHERE l_returnflag <> 'N'),
a AS (SELECT avg(l_quantity) AS mean_l_quantity_real, avg(l_discount) AS mean_l_discount_real,
      covar_samp(l_quantity, l_discount) / (stddev_samp(l_quantity) * stddev_samp(l_discount)) AS r_real FROM r),
b AS (SELECT avg(l_quantity) AS mean_l_quantity_synth, avg(l_discount) AS mean_l_discount_synth,
      covar_samp(l_quantity, l_discount) / (stddev_samp(l_quantity) * stddev_samp(l_discount)) AS r_synth FROM s)
SELECT *, r_synth - r_real AS r_diff FROM a, b""",
       dbl=["mean_l_quantity_real", "mean_l_discount_real", "r_real", "mean_l_quantity_synth", "mean_l_discount_synth", "r_synth", "r_diff"])
def n13_compare_synthetic_means(spark, d):
    li = Tables(spark, d).lineitem
    return N.compare_means_corr(li.filter(F.col("l_returnflag") == "N"), li.filter(F.col("l_returnflag") != "N"), "l_quantity", "l_discount")


@query("n13_compare_synthetic_bins", """WITH b AS (SELECT year(o_orderdate) < 1998 AS is_real, CASE WHEN o_totalprice > 0 AND o_totalprice <= 50000 THEN 'low'
WHEN o_totalprice > 50000 AND o_totalprice <= 150000 THEN 'mid' WHEN o_totalprice > 150000 AND o_totalprice <= 1e12 THEN 'high' END AS bin FROM orders),
r AS (SELECT bin, count(*) AS n FROM b WHERE is_real AND bin IS NOT NULL GROUP BY 1), s AS (SELECT bin, count(*) AS n FROM b WHERE NOT is_real AND bin IS NOT NULL GROUP BY 1),
j AS (SELECT COALESCE(r.bin, s.bin) AS bin, COALESCE(r.n / CAST(sum(r.n) OVER () AS DOUBLE), 0.0) AS share_real,
      COALESCE(s.n / CAST(sum(s.n) OVER () AS DOUBLE), 0.0) AS share_synth FROM r FULL JOIN s USING (bin))
SELECT *, share_synth - share_real AS diff, 0.5 * sum(abs(share_synth - share_real)) OVER () AS tvd FROM j""",
       dbl=["share_real", "share_synth", "diff", "tvd"])
def n13_compare_synthetic_bins(spark, d):
    o = Tables(spark, d).orders
    return N.compare_bin_shares(o.filter(F.year("o_orderdate") < 1998), o.filter(F.year("o_orderdate") >= 1998), "o_totalprice",
                                [0, 50000, 150000, 1e12], ["low", "mid", "high"])


@query("n14_retrieve_build_context", lambda: CLEAN_SQL() + r""", c AS (SELECT doc_id, token AS term, count(*) AS n FROM cl GROUP BY ALL),
dt AS (SELECT doc_id, sum(n) AS dt FROM c GROUP BY 1), df AS (SELECT term, count(*) AS df FROM c GROUP BY 1), nd AS (SELECT count(*) AS nd FROM dt),
w AS (SELECT doc_id, term, n / CAST(dt AS DOUBLE) * ln(nd / CAST(df AS DOUBLE)) AS w FROM c JOIN dt USING (doc_id) JOIN df USING (term), nd),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, sum(w) AS score FROM q JOIN w USING (term) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score * 1e9) DESC, doc_id) AS rank FROM s),
k AS (SELECT r.*, d.n_chars FROM r JOIN documents d USING (doc_id) WHERE rank <= 3)
SELECT item_id, doc_id, score, CAST(rank AS INTEGER) AS rank, n_chars, cum_chars, cum_chars <= 12000 AS fits FROM (
  SELECT *, sum(n_chars) OVER (PARTITION BY item_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_chars FROM k)
WHERE cum_chars <= 12000 OR rank = 1""", dbl=["score"], big=["cum_chars"])
def n14_retrieve_build_context(spark, d):
    t = Tables(spark, d)
    q = TX.tokenize(t.benchmark, "item_id", "text", out="term").select("item_id", "term").distinct().withColumn("qw", F.lit(1.0))
    w = TX.tf_idf(_triples(spark, d), "doc_id", terms=q.select("term"), partitioned=True).select("doc_id", "term", F.col("tf_idf").alias("w"))
    r = N.retrieve(q, w, "item_id", "doc_id", 3)
    r = r.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    return N.build_context(r, "item_id", "n_chars", 12000).select("item_id", "doc_id", "score", "rank", "n_chars", "cum_chars", "fits")


@query("n15_chunk_text", r"""WITH a AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS arr FROM documents),
n AS (SELECT doc_id, arr, len(arr) AS ntok FROM a WHERE len(arr) > 0)
SELECT doc_id, CAST(c AS INTEGER) AS chunk, CAST(c * 150 + 1 AS INTEGER) AS first_pos, LEAST(200, ntok - c * 150) AS n_tokens,
array_to_string(arr[c * 150 + 1:c * 150 + 200], ' ') AS chunk_text
FROM n, LATERAL (SELECT unnest(range(0, CAST(floor((ntok - 1) / 150) AS BIGINT) + 1)) AS c)""", big=["n_tokens"])
def n15_chunk_text(spark, d):
    return TX.chunk_text(Tables(spark, d).documents, "doc_id", "text", size=200, overlap=50)


# query parameter: an invented price table, USD per million tokens
PRICES = [("tier_a", 1.0), ("tier_b", 0.25), ("self_hosted", 0.0)]
_prices = ", ".join(f"('{m}', {p})" for m, p in PRICES)


@query("n16_cost_estimate", rf"""WITH w AS (SELECT lang, CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS INTEGER) AS words FROM documents),
t AS (SELECT lang, sum(words) AS words, count(*) AS n_texts FROM w GROUP BY 1),
p AS (SELECT model, CAST(usd AS DOUBLE) AS usd_per_million FROM (VALUES {_prices}) v(model, usd))
SELECT lang, CAST(words AS BIGINT) AS words, n_texts, words * CAST(1.3 AS DOUBLE) AS tokens, model, usd_per_million, words * CAST(1.3 AS DOUBLE) / 1e6 * usd_per_million AS cost_usd FROM t, p""",
       dbl=["tokens", "usd_per_million", "cost_usd"])
def n16_cost_estimate(spark, d):
    from faro.operators.features import text_length_features

    docs = text_length_features(Tables(spark, d).documents, "text")
    prices = spark.createDataFrame(PRICES, "model string, usd_per_million double")
    return N.cost_estimate(docs, "text_words", prices, 1.3, by=["lang"]).withColumn("words", F.col("words").cast("bigint"))
