"""Text analysis (T01-T25) as DataFrame operators.

Texts are processed whole: tokenisation is a JVM regex over the full
string, exploded into a long (doc, pos, token) table.  Counting is a
shuffle on (doc, term) with map-side partial counts, so frequent tokens
(stopwords holding a large share of all rows) are combined before the
shuffle.  Word lists and lexicons are small literal tables (broadcast, size
bounded by the list); vocabularies and document frequencies are tables
joined on the term, never collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faro.functions.core import cosine, safe_div
from faro.functions.text import char_array, hashed_values, ngram_array, sentence_array, stopword_rows, tokens
from faro.operators.verbs import slice_max


#: text of one partition
PARTITION_BYTES = 16_000_000


def text_partitions(df: DataFrame, text: str) -> int:
    """Partitions that the texts fill: tasks that count words hold bounded tables, whatever the number of documents."""
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-size // PARTITION_BYTES))


def tokenize(df: DataFrame, id_cols: Sequence[str] | str, text: str, out: str = "token", keep: Sequence[str] = (),
             unit: str = "words", n: int = 2) -> DataFrame:
    """One row per token with its 1-based position: (ids..., keep..., pos, token).

    ``unit``: words (default), ngrams (n consecutive words), sentences, characters.
    """
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    if unit == "words":
        arr = tokens(text)
    elif unit == "ngrams":
        # materialise the token array once; the n-gram lambda then slices the column, not the regex
        df = df.select(*ids, *keep, tokens(text).alias("_tok"))
        arr = ngram_array(F.col("_tok"), n)
    elif unit == "sentences":
        arr = sentence_array(text)
    elif unit == "characters":
        arr = char_array(text)
    else:
        raise ValueError(unit)
    return (df.select(*ids, *keep, F.posexplode(arr).alias("pos", out))
            .withColumn("pos", (F.col("pos") + 1).cast("int")))


def stopwords_table(spark, langs=("en", "es", "fr", "de"), extra: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(lang, token) rows: Spark's default lists plus domain extras."""
    rows = stopword_rows(langs)
    for lg, ws in (extra or {}).items():
        rows += [(lg, w) for w in ws]
    return spark.createDataFrame(sorted(set(rows)), "lang string, token string")


def remove_stopwords(tok: DataFrame, stop: DataFrame, token: str = "token", lang: str | None = "lang") -> DataFrame:
    """Anti join against a stopword table (by language when ``lang`` is given)."""
    on = [lang, token] if lang else [token]
    s = stop.select(*on) if lang else stop.select(token).distinct()
    return tok.join(F.broadcast(s), on, "left_anti")


def drop_numeric_short(tok: DataFrame, token: str = "token", min_chars: int = 3) -> DataFrame:
    """Drop all-digit tokens and tokens shorter than ``min_chars`` characters."""
    return tok.filter(~F.col(token).rlike("^[0-9]+$") & (F.char_length(token) >= min_chars))


def cleaning_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Token counts before/after cleaning and the percentage removed."""
    b = before.agg(F.count(F.lit(1)).alias("n_before"))
    a = after.agg(F.count(F.lit(1)).alias("n_after"))
    return b.crossJoin(a).withColumn("pct_removed", 100.0 * (1 - safe_div(F.col("n_after"), F.col("n_before"))))


def term_counts(tok: DataFrame, by: Sequence[str] = (), token: str = "token") -> DataFrame:
    return tok.groupBy(*by, token).agg(F.count(F.lit(1)).alias("n"))


def top_terms(tok: DataFrame, n: int, by: Sequence[str] = (), token: str = "token", with_ties: bool = False) -> DataFrame:
    """Most frequent terms (per group); ties broken by term unless ``with_ties``."""
    c = term_counts(tok, by, token)
    if by:
        return slice_max(c, by, "n", n, with_ties=with_ties, tiebreak=[token])
    return c.orderBy(F.desc("n"), token).limit(n)


def lemma_join(tok: DataFrame, lookup: DataFrame, token: str = "token", out: str = "lemma") -> DataFrame:
    """Map tokens through a (token, lemma) lookup; unmatched tokens keep their form."""
    lk = lookup.select(F.col("token").alias(token), F.col("lemma").alias("_lemma"))
    return tok.join(F.broadcast(lk), token, "left").withColumn(out, F.coalesce("_lemma", token)).drop("_lemma")


def bag_of_words(tok: DataFrame, doc: str, terms: Sequence[str], token: str = "token") -> DataFrame:
    """Document x term counts for a *declared* term list, zero-filled.

    An open vocabulary is never pivoted (see ``dtm_triples``)."""
    sub = tok.filter(F.col(token).isin(list(terms)))
    docs = tok.select(doc).distinct()
    w = sub.groupBy(doc).pivot(token, list(terms)).agg(F.count(F.lit(1)))
    return docs.join(w, doc, "left").fillna(0, subset=list(terms))


def dtm_triples(tok: DataFrame, doc: str, token: str = "token") -> DataFrame:
    """Sparse document-term matrix as (doc, term, n) triples."""
    return tok.groupBy(doc, F.col(token).alias("term")).agg(F.count(F.lit(1)).alias("n"))


def sparsity_report(triples: DataFrame, doc: str) -> DataFrame:
    """Documents, terms, non-zero cells and sparsity of a triple matrix."""
    return triples.agg(F.countDistinct(doc).alias("n_docs"), F.countDistinct("term").alias("n_terms"),
                       F.count(F.lit(1)).alias("non_zero")) \
                  .withColumn("sparsity", 1 - F.col("non_zero") / (F.col("n_docs").cast("double") * F.col("n_terms")))


def tf_idf(counts: DataFrame, doc: str, term: str = "term", n: str = "n", materialize: bool = True,
           terms: DataFrame | None = None, partitioned: bool = False) -> DataFrame:
    """tf = n / terms in doc; idf = ln(N_docs / docs containing term); tf_idf = tf * idf.

    Document totals and document frequencies are aggregations joined back
    (a hot term has one row in the df table, so the join stays cheap; AQE
    splits a skewed partition on the big side).  The (doc, term, n) triples
    feed three branches, so by default they are computed once and
    written: the texts are tokenised a single time.  ``terms`` (one
    column) keeps the weights of these terms only; lengths and the number of
    documents still count every term.  ``partitioned`` says that the counts
    come partitioned by document: their totals are then added where they are,
    the counts alone go to their terms, and the rows come out by term.
    """
    if partitioned:
        counts = counts.withColumn("_dt", F.sum(n).over(Window.partitionBy(doc)))
    if materialize:
        from faro.operators.ranking import stage

        counts = stage(counts)
    tot = counts.groupBy(doc).agg(F.sum(n).alias("_dt"))
    nd = tot.agg(F.count(F.lit(1)).alias("_N"))
    if terms is not None:
        counts = counts.join(terms.select(F.col(terms.columns[0]).alias(term)), term, "left_semi")
    if partitioned:
        found = counts.filter(F.col(term).isNotNull()).withColumn("_df", F.count(F.lit(1)).over(Window.partitionBy(term))).filter(F.col(doc).isNotNull())
    else:
        found = counts.join(tot, doc).join(counts.groupBy(term).agg(F.count(F.lit(1)).alias("_df")), term)
    j = found.crossJoin(F.broadcast(nd))
    tf = F.col(n).cast("double") / F.col("_dt")
    idf = F.ln(F.col("_N").cast("double") / F.col("_df"))
    return j.select(doc, term, n, tf.alias("tf"), idf.alias("idf"), (tf * idf).alias("tf_idf"))


def distinctive_terms(tok: DataFrame, group: str, n: int, token: str = "token") -> DataFrame:
    """Top-n tf-idf terms per group, treating each group as one document (no ties)."""
    c = tok.groupBy(group, F.col(token).alias("term")).agg(F.count(F.lit(1)).alias("n"))
    t = tf_idf(c, group)
    return slice_max(t, [group], "tf_idf", n, with_ties=False, tiebreak=["term"])


def lexicon_table(spark, positive: Sequence[str], negative: Sequence[str]) -> DataFrame:
    rows = [(w, 1) for w in positive] + [(w, -1) for w in negative if w not in set(positive)]
    return spark.createDataFrame(rows, "token string, valence int")


def lexicon_sentiment(tok: DataFrame, docs: DataFrame, doc: str, lexicon: DataFrame, token: str = "token",
                      keep: Sequence[str] = ()) -> DataFrame:
    """Per document: n_pos, n_neg and score = n_pos - n_neg; documents without hits score 0."""
    hits = tok.join(F.broadcast(lexicon.select(F.col("token").alias(token), "valence")), token, "inner")
    per = hits.groupBy(doc).agg(F.count_if(F.col("valence") > 0).alias("n_pos"),
                                F.count_if(F.col("valence") < 0).alias("n_neg"))
    out = docs.select(doc, *keep).join(per, doc, "left").fillna(0, subset=["n_pos", "n_neg"])
    return out.withColumn("score", (F.col("n_pos") - F.col("n_neg")).cast("bigint"))


def keyword_classify(tok: DataFrame, doc: str, themes: DataFrame, token: str = "token",
                     with_ties: bool = True) -> DataFrame:
    """Theme per document = the theme with the most keyword hits (ties kept by default)."""
    hits = tok.join(F.broadcast(themes.select(F.col("token").alias(token), "theme")), token, "inner")
    c = hits.groupBy(doc, "theme").agg(F.count(F.lit(1)).alias("n"))
    return slice_max(c, [doc], "n", 1, with_ties=with_ties, tiebreak=["theme"])


def theme_tone_summary(classified: DataFrame, tok: DataFrame, doc: str, negative: Sequence[str],
                       token: str = "token") -> DataFrame:
    """Documents per theme and mean number of negative words per document."""
    neg = tok.groupBy(doc).agg(F.count_if(F.col(token).isin(list(negative))).alias("n_neg"))
    j = classified.join(neg, doc, "left").fillna(0, subset=["n_neg"])
    return j.groupBy("theme").agg(F.count(F.lit(1)).alias("documents"), F.avg("n_neg").alias("negative"))


def doc_vectors(tok: DataFrame, doc: str, vectors: DataFrame | None = None, token: str = "token", dim: int = 8,
                weight: str | None = None) -> DataFrame:
    """Document embedding = (weighted) element-wise mean of its word vectors, long form (doc, dim, value).

    ``vectors``: (token, vector array) table; default is the hashed stand-in.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    if vectors is None:
        # the length is known: one row per token and one sum per dimension
        sums = tok.select(doc, w.alias("_w"), *[x.alias(f"_x{i}") for i, x in enumerate(hashed_values(token, dim))])
        means = sums.groupBy(doc).agg(*[(F.sum(F.col("_w") * F.col(f"_x{i}")) / F.sum("_w")).alias(f"_x{i}") for i in range(dim)])
        return means.select(doc, F.posexplode(F.array(*[f"_x{i}" for i in range(dim)])).alias("dim", "value")).withColumn("dim", F.col("dim") + 1)
    v = tok.join(vectors.select(F.col("token").alias(token), F.col("vector").alias("_vec")), token, "inner")
    long = v.select(doc, w.alias("_w"), F.posexplode("_vec").alias("dim", "_x"))
    return long.groupBy(doc, (F.col("dim") + 1).alias("dim")).agg(
        (F.sum(F.col("_w") * F.col("_x")) / F.sum("_w")).alias("value"))


#: most query vectors that are broadcast; a larger set is searched through an index
MOST_BROADCAST = 20_000


def cosine_topk(queries: DataFrame, corpus: DataFrame, qid: str, cid: str, qvec: str, cvec: str, k: int,
                exclude_self: bool = False) -> DataFrame:
    """Exact top-k cosine neighbours of each query among all corpus vectors (ties by id).

    The queries are counted first.  Up to ``MOST_BROADCAST`` of them are
    broadcast: the corpus is scanned once, and the ``<= k`` row_number filter
    keeps k candidates per query and partition before the shuffle.  More are
    searched by ``neighbours`` on vectors of length one, where the nearest are
    those of largest cosine: nothing is broadcast.  Zero vectors come last,
    or not at all with the index.
    """
    q = queries.select(F.col(qid).alias("_qid"), F.col(qvec).alias("_qv"))
    if q.limit(MOST_BROADCAST + 1).count() > MOST_BROADCAST:
        return _cosine_by_index(q, corpus, qid, cid, cvec, k, exclude_self)
    j = corpus.crossJoin(F.broadcast(q))
    if exclude_self:
        j = j.filter(F.col(cid) != F.col("_qid"))
    s = j.select(F.col("_qid").alias(qid), F.col(cid).alias("neighbor"), cosine("_qv", cvec).alias("similarity"))
    w = Window.partitionBy(qid).orderBy(F.desc("similarity"), "neighbor")
    return s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _unit(vec: str):
    v = F.transform(F.col(vec), lambda x: x.cast("double"))
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(v, lambda x: F.try_divide(x, length))


def _cosine_by_index(q: DataFrame, corpus: DataFrame, qid: str, cid: str, cvec: str, k: int, exclude_self: bool) -> DataFrame:
    from faro.operators.neighbours import nearest

    train = corpus.select(F.col(cid).alias("_n"), _unit(cvec).alias("_nv"), F.lit(0).alias("_t"))
    got = nearest(q.select(F.col("_qid").alias("_q"), _unit("_qv").alias("_qv")), train, k + int(exclude_self))
    if exclude_self:
        got = got.filter(F.col("_n") != F.col("_q"))
    w = Window.partitionBy("_q").orderBy("_d", "_n")
    got = got.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return got.select(F.col("_q").alias(qid), F.col("_n").alias("neighbor"), (1 - F.col("_d") * F.col("_d") / 2).alias("similarity"), "rank")


def association_gap(vectors: DataFrame, key: str, vec: str, pole_a: DataFrame, pole_b: DataFrame) -> DataFrame:
    """cos(x, a) - cos(x, b) for every vector (embedding bias toward one pole)."""
    pa = pole_a.select(F.col(vec).alias("_a"))
    pb = pole_b.select(F.col(vec).alias("_b"))
    j = vectors.crossJoin(F.broadcast(pa)).crossJoin(F.broadcast(pb))
    return j.select(key, cosine(vec, "_a").alias("cos_a"), cosine(vec, "_b").alias("cos_b")) \
            .withColumn("gap", F.col("cos_a") - F.col("cos_b"))


def vector_sum(a: str, b: str, c: str):
    """b - a + c element-wise (analogy arithmetic)."""
    return F.zip_with(F.zip_with(F.col(b), F.col(a), lambda x, y: x.cast("double") - y.cast("double")), F.col(c),
                      lambda x, y: x + y.cast("double"))


def chunk_text(df: DataFrame, doc: str, text: str, size: int, overlap: int = 0) -> DataFrame:
    """The token windows of ``chunk_tokens`` with their text: (doc, chunk, first_pos, n_tokens, chunk_text).

    Windows are cut from the row's token array, so nothing is shuffled;
    documents without tokens have no window.
    """
    step = size - overlap
    if step <= 0:
        raise ValueError("overlap must be smaller than size")
    tok, n = F.col("_tok"), F.size("_tok")
    starts = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / step).cast("int")))
    windows = F.transform(starts, lambda c: F.struct(
        c.alias("chunk"), (c * step + 1).alias("first_pos"), F.least(F.lit(size), n - c * step).cast("bigint").alias("n_tokens"),
        F.array_join(F.slice(tok, c * step + 1, F.lit(size)), " ").alias("chunk_text")))
    return df.select(doc, tokens(text).alias("_tok")).select(doc, F.inline(windows))


def chunk_tokens(tok: DataFrame, doc: str, size: int, overlap: int = 0) -> DataFrame:
    """Windows of ``size`` tokens advancing by size - overlap: (doc, chunk, first_pos, n_tokens).

    Membership is arithmetic on the token position, so no text is gathered.
    """
    step = size - overlap
    if step <= 0:
        raise ValueError("overlap must be smaller than size")
    # chunk c covers positions [c*step + 1, c*step + size]; a token belongs to every chunk covering it
    first = F.greatest(F.lit(0), F.ceil((F.col("pos") - size) / step)).cast("int")
    last = F.floor((F.col("pos") - 1) / step).cast("int")
    ex = tok.select(doc, "pos", F.explode(F.sequence(first, last)).alias("chunk"))
    return ex.groupBy(doc, "chunk").agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("n_tokens"))

