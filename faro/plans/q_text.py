"""Text queries (T01-T25) on documents, conversations and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from faro.functions.text import stopword_rows
from faro.operators import text as TX
from faro.plans.registry import query
from faro.sources.tables import Tables

TOK_SQL = r"""tk AS (SELECT doc_id, lang, CAST(generate_subscripts(arr, 1) AS INTEGER) AS pos, unnest(arr) AS token
  FROM (SELECT doc_id, lang, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS arr FROM documents))"""


def _q(s: str) -> str:
    return s.replace("'", "''")


def _stop_values() -> str:
    return ", ".join(f"('{lg}', '{_q(w)}')" for lg, w in stopword_rows())


def STOP_SQL() -> str:
    return f"sw AS (SELECT * FROM (VALUES {_stop_values()}) v(lang, token))"


def CLEAN_SQL() -> str:
    return f"""WITH {TOK_SQL}, {STOP_SQL()},
cl AS (SELECT * FROM tk WHERE NOT EXISTS (SELECT 1 FROM sw WHERE sw.lang = tk.lang AND sw.token = tk.token)
       AND NOT regexp_matches(token, '^[0-9]+$') AND length(token) >= 3)
"""


def _tok(spark, d, by_document=None):
    docs = Tables(spark, d).documents
    if by_document:
        docs = docs.select("doc_id", "text", "lang").repartition(by_document, "doc_id")
    return TX.tokenize(docs, "doc_id", "text", keep=["lang"])


def _clean(spark, d, by_document=None):
    """Tokens without stopwords, numbers and short words; ``by_document``: partitions to deal the documents to by id, so that counts by document need no shuffle of tokens."""
    tok = _tok(spark, d, by_document)
    return TX.drop_numeric_short(TX.remove_stopwords(tok, TX.stopwords_table(spark)))


def _triples(spark, d):
    """Document-term counts, partitioned by document."""
    return TX.dtm_triples(_clean(spark, d, by_document=TX.text_partitions(Tables(spark, d).documents, "text")), "doc_id")


@query("t01_tokenize", f"WITH {TOK_SQL} SELECT doc_id, pos, token FROM tk")
def t01_tokenize(spark, d):
    return _tok(spark, d).select("doc_id", "pos", "token")


@query("t01_tokenize_conversations", r"""SELECT conv_id, turn, role, CAST(len(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS BIGINT) AS n_tokens
FROM conversations""")
def t01_tokenize_conversations(spark, d):
    tok = TX.tokenize(Tables(spark, d).conversations, ["conv_id", "turn"], "text", keep=["role"])
    conv = Tables(spark, d).conversations.select("conv_id", "turn", "role")
    c = tok.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n_tokens"))
    return conv.join(c, ["conv_id", "turn"], "left").fillna(0, subset=["n_tokens"])


@query("t02_bigrams", r"""WITH a AS (SELECT lang, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS arr FROM documents),
b AS (SELECT lang, unnest(list_transform(range(1, len(arr)), lambda i: array_to_string(arr[i:i + 1], ' '))) AS bigram FROM a WHERE len(arr) >= 2),
c AS (SELECT lang, bigram, count(*) AS n FROM b GROUP BY ALL)
SELECT lang, bigram, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, bigram) AS r FROM c) WHERE r <= 20""")
def t02_bigrams(spark, d):
    bi = TX.tokenize(Tables(spark, d).documents, "doc_id", "text", out="bigram", keep=["lang"], unit="ngrams", n=2)
    return TX.top_terms(bi, 20, by=["lang"], token="bigram")


@query("t03_sentences_characters", r"""SELECT doc_id,
CAST(len(list_filter(list_transform(string_split_regex(trim(text), '[.!?]+\s+'), lambda s: lower(trim(s))), lambda s: s <> '')) AS BIGINT) AS n_sentences,
CAST(len(regexp_extract_all(lower(text), '[\p{L}\p{N}]')) AS BIGINT) AS n_characters FROM documents""")
def t03_sentences_characters(spark, d):
    docs = Tables(spark, d).documents
    s = TX.tokenize(docs, "doc_id", "text", out="sentence", unit="sentences").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_sentences"))
    c = TX.tokenize(docs, "doc_id", "text", out="ch", unit="characters").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_characters"))
    return docs.select("doc_id").join(s, "doc_id", "left").join(c, "doc_id", "left").fillna(0, subset=["n_sentences", "n_characters"])


def _t04_sql():
    return f"""WITH {TOK_SQL}, {STOP_SQL()}
SELECT lang, count(*) AS n_tokens FROM tk WHERE NOT EXISTS (SELECT 1 FROM sw WHERE sw.lang = tk.lang AND sw.token = tk.token) GROUP BY lang"""


@query("t04_remove_stopwords", _t04_sql)
def t04_remove_stopwords(spark, d):
    t = TX.remove_stopwords(_tok(spark, d), TX.stopwords_table(spark))
    return t.groupBy("lang").agg(F.count(F.lit(1)).alias("n_tokens"))


@query("t05_drop_numeric_short", lambda: CLEAN_SQL() + "SELECT lang, count(*) AS n_tokens, count(DISTINCT token) AS n_types FROM cl GROUP BY lang")
def t05_drop_numeric_short(spark, d):
    return _clean(spark, d).groupBy("lang").agg(F.count(F.lit(1)).alias("n_tokens"), F.countDistinct("token").alias("n_types"))


@query("t06_cleaning_report", lambda: CLEAN_SQL() + """SELECT (SELECT count(*) FROM tk) AS n_before, (SELECT count(*) FROM cl) AS n_after,
100.0 * (1 - (SELECT count(*) FROM cl) / CAST((SELECT count(*) FROM tk) AS DOUBLE)) AS pct_removed""", dbl=["pct_removed"])
def t06_cleaning_report(spark, d):
    return TX.cleaning_report(_tok(spark, d), _clean(spark, d))


@query("t07_term_counts_top", lambda: CLEAN_SQL() + """, c AS (SELECT lang, token, count(*) AS n FROM cl GROUP BY ALL)
SELECT lang, token, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) AS r FROM c) WHERE r <= 10""")
def t07_term_counts_top(spark, d):
    return TX.top_terms(_clean(spark, d), 10, by=["lang"])


@query("t07_term_counts_corpus", lambda: CLEAN_SQL() + """SELECT token, count(*) AS n FROM cl GROUP BY token ORDER BY n DESC, token LIMIT 15""")
def t07_term_counts_corpus(spark, d):
    return TX.top_terms(_clean(spark, d), 15)


# query parameter: a small lemma lookup over function words that occur in the corpus
LEMMAS = [("are", "be"), ("is", "be"), ("was", "be"), ("les", "le"), ("la", "le"), ("des", "de"), ("du", "de"),
          ("los", "el"), ("las", "el"), ("die", "der"), ("das", "der")]
_lem = ", ".join(f"('{a}', '{b}')" for a, b in LEMMAS)


@query("t08_lemma_join", f"""WITH {TOK_SQL}, lk AS (SELECT * FROM (VALUES {_lem}) v(token, lemma))
SELECT COALESCE(lk.lemma, tk.token) AS lemma, count(*) AS n FROM tk LEFT JOIN lk USING (token) GROUP BY 1""")
def t08_lemma_join(spark, d):
    lk = spark.createDataFrame(LEMMAS, "token string, lemma string")
    t = TX.lemma_join(_tok(spark, d), lk)
    return t.groupBy("lemma").agg(F.count(F.lit(1)).alias("n"))


BOW_TERMS = ["the", "and", "le", "la", "que", "der", "und", "with"]


@query("t09_bag_of_words", f"WITH {TOK_SQL} SELECT doc_id, " + ", ".join(
    f"CAST(count_if(token = '{t}') AS BIGINT) AS {t}" for t in BOW_TERMS) + " FROM tk GROUP BY doc_id")
def t09_bag_of_words(spark, d):
    return TX.bag_of_words(_tok(spark, d), "doc_id", BOW_TERMS)


@query("t10_dtm_triples", lambda: CLEAN_SQL() + "SELECT doc_id, token AS term, count(*) AS n FROM cl GROUP BY ALL")
def t10_dtm_triples(spark, d):
    return TX.dtm_triples(_clean(spark, d), "doc_id")


@query("t10_sparsity_report", lambda: CLEAN_SQL() + """, t AS (SELECT doc_id, token, count(*) AS n FROM cl GROUP BY ALL)
SELECT count(DISTINCT doc_id) AS n_docs, count(DISTINCT token) AS n_terms, count(*) AS non_zero,
1 - count(*) / (CAST(count(DISTINCT doc_id) AS DOUBLE) * count(DISTINCT token)) AS sparsity FROM t""", dbl=["sparsity"])
def t10_sparsity_report(spark, d):
    return TX.sparsity_report(TX.dtm_triples(_clean(spark, d), "doc_id"), "doc_id")


TFIDF_SQL = """, c AS (SELECT doc_id, token AS term, count(*) AS n FROM cl GROUP BY ALL),
dt AS (SELECT doc_id, sum(n) AS dt FROM c GROUP BY 1), df AS (SELECT term, count(*) AS df FROM c GROUP BY 1),
nd AS (SELECT count(*) AS nd FROM dt)
SELECT doc_id, term, n, n / CAST(dt AS DOUBLE) AS tf, ln(nd / CAST(df AS DOUBLE)) AS idf, n / CAST(dt AS DOUBLE) * ln(nd / CAST(df AS DOUBLE)) AS tf_idf
FROM c JOIN dt USING (doc_id) JOIN df USING (term), nd"""


@query("t11_tf_idf", lambda: CLEAN_SQL() + TFIDF_SQL, dbl=["tf", "idf", "tf_idf"])
def t11_tf_idf(spark, d):
    return TX.tf_idf(_triples(spark, d), "doc_id", partitioned=True)


@query("t12_distinctive_terms", lambda: CLEAN_SQL() + """, c AS (SELECT lang, token AS term, count(*) AS n FROM cl GROUP BY ALL),
dt AS (SELECT lang, sum(n) AS dt FROM c GROUP BY 1), df AS (SELECT term, count(*) AS df FROM c GROUP BY 1), nd AS (SELECT count(*) AS nd FROM dt),
t AS (SELECT lang, term, n, n / CAST(dt AS DOUBLE) AS tf, ln(nd / CAST(df AS DOUBLE)) AS idf, n / CAST(dt AS DOUBLE) * ln(nd / CAST(df AS DOUBLE)) AS tf_idf
FROM c JOIN dt USING (lang) JOIN df USING (term), nd)
SELECT lang, term, n, tf, idf, tf_idf FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY tf_idf DESC, term) AS r FROM t) WHERE r <= 5""",
       dbl=["tf", "idf", "tf_idf"])
def t12_distinctive_terms(spark, d):
    return TX.distinctive_terms(_clean(spark, d), "lang", 5)


# fixed values: the reference's Spanish sentiment lexicon
POSITIVE_ES = ["crecimiento", "inversión", "calidad", "gratuita", "protegió", "atención", "estabilizar"]
NEGATIVE_ES = ["inflación", "estancado", "deuda", "desempleo", "problema", "dificultades", "deserción", "violencia", "crimen",
               "narcotráfico", "delincuencia", "inseguridad", "pobres", "robos", "grave", "amenaza"]
# query parameter: corpus-specific entries so the synthetic multilingual text has hits
POSITIVE_CORPUS = ["tion", "ment", "ción", "heit"]
NEGATIVE_CORPUS = ["ing", "ble", "ung", "eau", "mente"]
POS = POSITIVE_ES + POSITIVE_CORPUS
NEG = NEGATIVE_ES + NEGATIVE_CORPUS
_lex = ", ".join([f"('{w}', 1)" for w in POS] + [f"('{w}', -1)" for w in NEG])


@query("t13_lexicon_sentiment", f"""WITH {TOK_SQL}, lx AS (SELECT * FROM (VALUES {_lex}) v(token, valence)),
h AS (SELECT doc_id, count_if(valence > 0) AS n_pos, count_if(valence < 0) AS n_neg FROM tk JOIN lx USING (token) GROUP BY 1)
SELECT d.doc_id, d.lang, CAST(COALESCE(n_pos, 0) AS BIGINT) AS n_pos, CAST(COALESCE(n_neg, 0) AS BIGINT) AS n_neg,
CAST(COALESCE(n_pos, 0) - COALESCE(n_neg, 0) AS BIGINT) AS score FROM documents d LEFT JOIN h USING (doc_id)""")
def t13_lexicon_sentiment(spark, d):
    lex = TX.lexicon_table(spark, POS, NEG)
    return TX.lexicon_sentiment(_tok(spark, d), Tables(spark, d).documents, "doc_id", lex, keep=["lang"])


@query("t13_sentiment_by_group", f"""WITH {TOK_SQL}, lx AS (SELECT * FROM (VALUES {_lex}) v(token, valence)),
h AS (SELECT doc_id, sum(valence) AS s FROM tk JOIN lx USING (token) GROUP BY 1)
SELECT d.lang, avg(COALESCE(s, 0)) AS mean_score, count(*) AS n FROM documents d LEFT JOIN h USING (doc_id) GROUP BY 1""", dbl=["mean_score"])
def t13_sentiment_by_group(spark, d):
    lex = TX.lexicon_table(spark, POS, NEG)
    s = TX.lexicon_sentiment(_tok(spark, d), Tables(spark, d).documents, "doc_id", lex, keep=["lang"])
    return s.groupBy("lang").agg(F.avg("score").alias("mean_score"), F.count(F.lit(1)).alias("n"))


# fixed values: the reference's keyword -> theme dictionary (Spanish survey answers)
THEMES_ES = {
    "economía": ["economía", "inflación", "precios", "trabajo", "empleo"],
    "seguridad": ["inseguridad", "violencia", "robos", "delincuencia"],
    "corrupción": ["corruptos", "políticos", "gobierno"],
    "servicios": ["educación", "salud", "escuelas", "hospitales", "médicos", "docentes"],
}
# fixed values: the reference's short negative-word list for tone
NEG_TONE_ES = ["mal", "inflación", "corruptos", "inseguridad", "robos", "violencia", "delincuencia", "grave", "deficiente",
               "abandonadas", "faltan", "arruinan"]
# query parameter: corpus-specific keywords for the synthetic text
THEMES_CORPUS = {"nominal": ["tion", "ción", "heit", "keit", "ung"], "adverbial": ["ment", "mente", "ly"],
                 "verbal": ["ing", "ado", "erte"]}
THEMES = {k: v for k, v in list(THEMES_ES.items()) + list(THEMES_CORPUS.items())}
NEG_TONE = NEG_TONE_ES + ["ble", "eau", "sch"]
_th = ", ".join(f"('{w}', '{k}')" for k, ws in THEMES.items() for w in ws)
_neg = ", ".join(f"'{w}'" for w in NEG_TONE)


def _themes(spark):
    return spark.createDataFrame([(w, k) for k, ws in THEMES.items() for w in ws], "token string, theme string")


@query("t14_keyword_classify", f"""WITH {TOK_SQL}, th AS (SELECT * FROM (VALUES {_th}) v(token, theme)),
c AS (SELECT doc_id, theme, count(*) AS n FROM tk JOIN th USING (token) GROUP BY ALL)
SELECT doc_id, theme, n FROM (SELECT *, rank() OVER (PARTITION BY doc_id ORDER BY n DESC) AS r FROM c) WHERE r = 1""")
def t14_keyword_classify(spark, d):
    return TX.keyword_classify(_tok(spark, d), "doc_id", _themes(spark))


@query("t15_theme_tone_summary", f"""WITH {TOK_SQL}, th AS (SELECT * FROM (VALUES {_th}) v(token, theme)),
c AS (SELECT doc_id, theme, count(*) AS n FROM tk JOIN th USING (token) GROUP BY ALL),
cl AS (SELECT doc_id, theme FROM (SELECT *, rank() OVER (PARTITION BY doc_id ORDER BY n DESC) AS r FROM c) WHERE r = 1),
ng AS (SELECT doc_id, count_if(token IN ({_neg})) AS n_neg FROM tk GROUP BY 1)
SELECT theme, count(*) AS documents, avg(COALESCE(n_neg, 0)) AS negative FROM cl LEFT JOIN ng USING (doc_id) GROUP BY 1""", dbl=["negative"])
def t15_theme_tone_summary(spark, d):
    tok = _tok(spark, d)
    cl = TX.keyword_classify(tok, "doc_id", _themes(spark))
    return TX.theme_tone_summary(cl, tok, "doc_id", NEG_TONE)


@query("t22_cosine_topk", """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT label, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM e),
c AS (SELECT label, list(m ORDER BY i) AS cv FROM (SELECT label, i, avg(x) AS m FROM x GROUP BY ALL) GROUP BY label),
s AS (SELECT c.label, e.vec_id AS neighbor, list_dot_product(c.cv, e.v) / (sqrt(list_dot_product(c.cv, c.cv)) * sqrt(list_dot_product(e.v, e.v))) AS similarity
      FROM c, e)
SELECT label, neighbor, similarity, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY similarity DESC, neighbor) AS r FROM s)
WHERE r <= 5""", dbl=["similarity"])
def t22_cosine_topk(spark, d):
    from faro.operators.cluster import centroids

    emb = Tables(spark, d).embeddings
    cent = centroids(emb, "label", "embedding")
    return TX.cosine_topk(cent, emb, "label", "vec_id", "centroid", "embedding", 5)


@query("t23_doc_vectors", lambda: CLEAN_SQL() + """, v AS (SELECT doc_id, list_transform(range(0, 8), lambda i: CAST(('0x' || substr(md5(token), 2 * i + 1, 2)) AS INTEGER) / 255.0 - 0.5) AS vec FROM cl),
x AS (SELECT doc_id, generate_subscripts(vec, 1) AS dim, unnest(vec) AS x FROM v)
SELECT doc_id, CAST(dim AS INTEGER) AS dim, avg(x) AS value FROM x GROUP BY ALL""", dbl=["value"])
def t23_doc_vectors(spark, d):
    return TX.doc_vectors(_clean(spark, d), "doc_id")


@query("t25_analogy", """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
a AS (SELECT v FROM e WHERE vec_id = 0), b AS (SELECT v FROM e WHERE vec_id = 1), c AS (SELECT v FROM e WHERE vec_id = 2),
q AS (SELECT list_transform(range(1, 65), lambda i: b.v[i] - a.v[i] + c.v[i]) AS qv FROM a, b, c),
s AS (SELECT vec_id AS neighbor, list_dot_product(qv, v) / (sqrt(list_dot_product(qv, qv)) * sqrt(list_dot_product(v, v))) AS similarity
      FROM e, q WHERE vec_id NOT IN (0, 1, 2))
SELECT 'b-a+c' AS query, neighbor, similarity, CAST(row_number() OVER (ORDER BY similarity DESC, neighbor) AS INTEGER) AS rank FROM s
QUALIFY rank <= 5""", dbl=["similarity"])
def t25_analogy(spark, d):
    emb = Tables(spark, d).embeddings
    a = emb.filter(F.col("vec_id") == 0).select(F.col("embedding").alias("a"))
    b = emb.filter(F.col("vec_id") == 1).select(F.col("embedding").alias("b"))
    c = emb.filter(F.col("vec_id") == 2).select(F.col("embedding").alias("c"))
    q = a.crossJoin(b).crossJoin(c).select(F.lit("b-a+c").alias("query"), TX.vector_sum("a", "b", "c").alias("qv"))
    corpus = emb.filter(~F.col("vec_id").isin(0, 1, 2))
    return TX.cosine_topk(q, corpus, "query", "vec_id", "qv", "embedding", 5)


@query("t25_association_gap", """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT label, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM e WHERE label IN (0, 1)),
c AS (SELECT label, list(m ORDER BY i) AS cv FROM (SELECT label, i, avg(x) AS m FROM x GROUP BY ALL) GROUP BY label),
pa AS (SELECT cv AS a FROM c WHERE label = 0), pb AS (SELECT cv AS b FROM c WHERE label = 1)
SELECT vec_id, list_dot_product(v, a) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(a, a))) AS cos_a,
list_dot_product(v, b) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(b, b))) AS cos_b,
list_dot_product(v, a) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(a, a))) - list_dot_product(v, b) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(b, b))) AS gap
FROM e, pa, pb""", dbl=["cos_a", "cos_b", "gap"])
def t25_association_gap(spark, d):
    from faro.operators.cluster import centroids

    emb = Tables(spark, d).embeddings
    cent = centroids(emb.filter(F.col("label").isin(0, 1)), "label", "embedding")
    pa = cent.filter(F.col("label") == 0).select(F.col("centroid").alias("embedding"))
    pb = cent.filter(F.col("label") == 1).select(F.col("centroid").alias("embedding"))
    return TX.association_gap(emb, "vec_id", "embedding", pa, pb)
