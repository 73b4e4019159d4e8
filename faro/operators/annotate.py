"""Annotation batches (N01-N16): everything around a labelling model is table work.

The model call itself is a pluggable *annotator*: a Python function from a
pandas Series of prompts to a pandas Series of raw responses, run with
``mapInPandas`` over Arrow batches on the executors.  Prompts are
de-duplicated (by hash) and looked up in a response cache table first, so
each distinct prompt is annotated once, and re-runs only annotate what is
missing.  The default annotator is an offline keyword classifier.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faro.functions.core import col, cut_expr, safe_div, stable_hash
from faro.operators.ranking import materialize

# ------------------------------------------------------------------ prompts


def render_prompts(df: DataFrame, text: str, persona: str, task: str, output_format: str,
                   examples: Sequence[tuple[str, str]] = (), reasoning: bool = False, out: str = "prompt") -> DataFrame:
    """Four-part prompt: persona, task, context (the whole text), output format;
    optional few-shot examples and a step-by-step instruction."""
    shots = "".join(f"Example: {x}\nAnswer: {y}\n\n" for x, y in examples)
    cot = "Think step by step before answering.\n" if reasoning else ""
    head = f"{persona}\n\nTask: {task}\n{cot}\n{shots}"
    return df.withColumn(out, F.concat(F.lit(head + "Text: "), col(text), F.lit(f"\n\nAnswer format: {output_format}")))


def audit_pairs(values: DataFrame, value_col: str, templates: Sequence[str], placeholder: str = "{value}") -> DataFrame:
    """Counterfactual prompts: every value inserted into every template (templates are a small literal)."""
    spark = values.sparkSession
    t = spark.createDataFrame([(i + 1, s) for i, s in enumerate(templates)], "template_id int, template string")
    j = values.select(value_col).distinct().crossJoin(F.broadcast(t))
    return j.withColumn("prompt", F.replace("template", F.lit(placeholder), F.col(value_col).cast("string")))


# ------------------------------------------------------------------ annotators


def keyword_annotator(themes: Mapping[str, Sequence[str]], default: str = "other") -> Callable[[pd.Series], pd.Series]:
    """Offline annotator: the theme whose keywords occur most often (ties -> first theme listed)."""
    import re

    pat = re.compile(r"[^\W_]+", re.UNICODE)
    lookup = {w: t for t, ws in themes.items() for w in ws}
    order = list(themes)

    def run(prompts: pd.Series) -> pd.Series:
        out = []
        for p in prompts:
            counts = {}
            for tok in pat.findall((p or "").lower()):
                th = lookup.get(tok)
                if th:
                    counts[th] = counts.get(th, 0) + 1
            out.append(max(order, key=lambda t: (counts.get(t, 0), -order.index(t))) if counts else default)
        return pd.Series(out, dtype="string")

    return run


def annotate(df: DataFrame, prompt: str, annotator: Callable[[pd.Series], pd.Series], cache: DataFrame | None = None,
             out: str = "response") -> tuple[DataFrame, DataFrame]:
    """Annotate each distinct prompt once; returns (rows with ``response``, new cache rows).

    ``cache``: (prompt_hash, response) from earlier runs; only prompts
    missing from it are sent to the annotator (left anti join).  The new
    responses are written to the checkpoint folder before anything reads
    them: both results hold the same answers, and no later action or lost
    executor calls the annotator again.
    """
    keyed = df.withColumn("prompt_hash", F.sha2(col(prompt), 256))
    todo = keyed.select("prompt_hash", prompt).dropDuplicates(["prompt_hash"])
    if cache is not None:
        todo = todo.join(cache.select("prompt_hash"), "prompt_hash", "left_anti")

    def run(batches):
        for b in batches:
            yield pd.DataFrame({"prompt_hash": b["prompt_hash"], out: annotator(b[prompt]).astype(object)})

    fresh = materialize(todo.mapInPandas(run, f"prompt_hash string, {out} string"))
    allc = fresh if cache is None else cache.select("prompt_hash", F.col("response").alias(out)).unionByName(fresh)
    return keyed.join(allc, "prompt_hash", "left"), fresh.withColumnRenamed(out, "response")


# ------------------------------------------------------------------ parsing


def normalize_label(c: str, allowed: Sequence[str]):
    """trim + lower; values outside the codebook become NULL."""
    x = F.lower(F.trim(col(c)))
    return F.when(x.isin(list(allowed)), x)


def parse_json(df: DataFrame, c: str, schema: T.StructType, out: str = "parsed") -> DataFrame:
    """Struct from a JSON string, PERMISSIVE: malformed text gives NULL fields and ``parse_error`` true;
    a field of the wrong type is NULL while the others are kept (also flagged)."""
    full = T.StructType(list(schema.fields) + [T.StructField("_corrupt", T.StringType())])
    p = F.from_json(col(c), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    d = df.withColumn("_p", p)
    err = col(c).isNull() | F.col("_p._corrupt").isNotNull()
    return d.withColumn(out, F.struct(*[F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields])) \
            .withColumn("parse_error", err).drop("_p")


def unnest_struct(df: DataFrame, c: str, prefix: str = "") -> DataFrame:
    st = df.schema[c].dataType
    return df.select(*[x for x in df.columns if x != c], *[F.col(f"{c}.{f.name}").alias(f"{prefix}{f.name}") for f in st.fields])


def explode_entities(df: DataFrame, c: str, out: str = "entity") -> DataFrame:
    return df.select(*[x for x in df.columns if x != c], F.posexplode(c).alias("entity_pos", out)) \
             .withColumn("entity_pos", (F.col("entity_pos") + 1).cast("int"))


# ------------------------------------------------------------------ evaluation


def evaluate_annotations(df: DataFrame, truth: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and macro precision / recall / F1 over classes (per group).

    Per-class counts come from one aggregation over (group, truth, label):
    a cell counts once for its true class and once for its labelled class.
    Classes absent from both truth and labels do not enter the macro mean.
    """
    c = df.groupBy(*by, col(truth).cast("string").alias("_t"), col(label).cast("string").alias("_l")).agg(F.count(F.lit(1)).alias("_n"))
    n, none, hit = F.col("_n"), F.lit(0).cast("long"), F.col("_t") == F.col("_l")
    sides = F.array(
        F.struct(F.col("_t").alias("cls"), F.when(hit, n).otherwise(none).alias("tp"), none.alias("fp"), F.when(hit, none).otherwise(n).alias("fn")),
        F.struct(F.col("_l").alias("cls"), none.alias("tp"), F.when(~hit, n).otherwise(none).alias("fp"), none.alias("fn")))
    per = c.select(*by, F.explode(sides).alias("_s")).select(*by, "_s.*").filter(F.col("cls").isNotNull())
    per = per.groupBy(*by, "cls").agg(*[F.sum(x).alias(x) for x in ("tp", "fp", "fn")])
    pr = safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    rc = safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    per = per.withColumn("precision", pr).withColumn("recall", rc) \
             .withColumn("f1", safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    macro = per.groupBy(*by).agg(F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
                                 F.avg("f1").alias("macro_f1"))
    acc = df.groupBy(*by).agg(F.avg((col(truth).cast("string") == col(label).cast("string")).cast("double")).alias("accuracy"),
                              F.count(F.lit(1)).alias("n"))
    return acc.join(macro, list(by)) if by else acc.crossJoin(macro)


def error_listing(df: DataFrame, truth: str, label: str, cols: Sequence[str]) -> DataFrame:
    """Rows where the annotation disagrees with the gold label (NULL labels count as errors)."""
    wrong = col(label).isNull() | (col(truth).cast("string") != col(label).cast("string"))
    return df.filter(wrong).select(*cols, truth, label)


def agreement(df: DataFrame, item: str, annotators: Sequence[str]) -> DataFrame:
    """Pairwise percent agreement and Cohen's kappa for every annotator pair (wide input)."""
    from faro.operators.metrics import kappa

    parts = []
    for i, a in enumerate(annotators):
        for b in annotators[i + 1:]:
            k = kappa(df, a, b).select("kap")
            ag = df.agg(F.avg((col(a) == col(b)).cast("double")).alias("agreement"))
            parts.append(ag.crossJoin(k).select(F.lit(a).alias("annotator_a"), F.lit(b).alias("annotator_b"), "agreement", "kap"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def majority_vote(df: DataFrame, item: str, annotators: Sequence[str], out: str = "majority") -> DataFrame:
    """Most frequent label across annotators per item (ties -> smallest label)."""
    arr = F.array(*[col(a).cast("string") for a in annotators])
    counts = F.transform(F.array_distinct(arr), lambda v: F.struct(F.size(F.filter(arr, lambda x: x == v)).alias("n"), v.alias("v")))
    mx = F.array_max(F.transform(counts, lambda s: s["n"]))
    winner = F.array_min(F.transform(F.filter(counts, lambda s: s["n"] == mx), lambda s: s["v"]))
    return df.withColumn(out, winner)


def method_comparison(results: Mapping[str, DataFrame], truth: str, label: str, cost_per_item: Mapping[str, float],
                      seconds: Mapping[str, float] | None = None) -> DataFrame:
    """Accuracy and cost per method (one row per method), and the elapsed time where it was measured (see ``timed``)."""
    parts = []
    for m, d in results.items():
        a = d.agg(F.avg((col(truth).cast("string") == col(label).cast("string")).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).alias("n"))
        took = [] if seconds is None else [F.lit(seconds.get(m)).cast("double").alias("seconds")]
        parts.append(a.select(F.lit(m).alias("method"), "accuracy", "n", *took,
                              (F.col("n") * float(cost_per_item.get(m, 0.0))).alias("cost")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def timed(build: Callable[[], DataFrame]) -> tuple[DataFrame, float]:
    """A method's result, computed once into the checkpoint folder, and the seconds that took."""
    start = time.perf_counter()
    return materialize(build()), time.perf_counter() - start


def validation_sample(df: DataFrame, key: str, by: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """n rows per stratum for human review, drawn by hash order (reproducible)."""
    w = Window.partitionBy(*by).orderBy(stable_hash(seed, key), F.col(key))
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def audit_report(df: DataFrame, group: str, tone: str, confidence: str) -> DataFrame:
    """Share of each tone and mean confidence per group, with the gap to the overall share."""
    g = df.groupBy(group, tone).agg(F.count(F.lit(1)).alias("n"), F.avg(col(confidence).cast("double")).alias("mean_confidence"))
    gt = df.groupBy(group).agg(F.count(F.lit(1)).alias("_ng"))
    ov = df.groupBy(tone).agg(F.count(F.lit(1)).alias("_nt")).crossJoin(df.agg(F.count(F.lit(1)).alias("_n")))
    return (g.join(gt, group).join(ov, tone)
            .select(group, tone, "n", "mean_confidence", (F.col("n") / F.col("_ng")).alias("share"),
                    (F.col("n") / F.col("_ng") - F.col("_nt") / F.col("_n")).alias("gap_to_overall")))


def compare_category_shares(real: DataFrame, synth: DataFrame, c: str) -> DataFrame:
    """Category shares in both tables, their difference and the total-variation distance."""
    def shares(d, name):
        x = d.groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        return x.crossJoin(x.agg(F.sum("_n").alias("_t"))).select(c, (F.col("_n") / F.col("_t")).alias(name))

    j = shares(real, "share_real").join(shares(synth, "share_synth"), c, "full").fillna(0.0, subset=["share_real", "share_synth"])
    j = j.withColumn("diff", F.col("share_synth") - F.col("share_real"))
    tvd = j.agg((0.5 * F.sum(F.abs("diff"))).alias("tvd"))
    return j.crossJoin(tvd)


def compare_bin_shares(real: DataFrame, synth: DataFrame, value: str, breaks: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Shares of right-closed bins of a numeric column in both tables (values outside the breaks, and NULLs, are in no bin)."""
    binned = [d.select(cut_expr(value, breaks, labels).alias("bin")).filter("bin is not null") for d in (real, synth)]
    return compare_category_shares(*binned, "bin")


def compare_means_corr(real: DataFrame, synth: DataFrame, a: str, b: str) -> DataFrame:
    def st(d, name):
        return d.agg(F.avg(col(a).cast("double")).alias(f"mean_{a}_{name}"), F.avg(col(b).cast("double")).alias(f"mean_{b}_{name}"),
                     F.try_divide(F.covar_samp(col(a).cast("double"), col(b).cast("double")),
                                  F.stddev_samp(col(a).cast("double")) * F.stddev_samp(col(b).cast("double"))).alias(f"r_{name}"))
    j = st(real, "real").crossJoin(st(synth, "synth"))
    return j.withColumn("r_diff", F.col("r_synth") - F.col("r_real"))


def retrieve(query_terms: DataFrame, doc_weights: DataFrame, qid: str, doc: str, k: int) -> DataFrame:
    """Top-k documents per query by the dot product of term weights (inverted-index join on term).

    query_terms: (qid, term, qw); doc_weights: (doc, term, w).  The join
    emits one row per (query, doc, shared term), linear in the postings of
    the query terms; ``<= k`` keeps k candidates per query per partition.
    """
    s = query_terms.join(doc_weights, "term").groupBy(qid, doc).agg(F.sum(F.col("qw") * F.col("w")).alias("score"))
    # rank on the score rounded to 1e-9: a floating sum's last bits depend on summation order, and
    # identical documents must tie (then the key decides) on every run
    key = F.round(F.col("score") * 1e9)
    w = Window.partitionBy(qid).orderBy(key.desc(), doc)
    return s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def build_context(ranked: DataFrame, qid: str, length: str, max_chars: int) -> DataFrame:
    """Keep retrieved documents in rank order while the running length stays within ``max_chars``
    (a window over at most k rows per query).

    The first document always stays, so that no context is empty; ``fits`` is
    false where it alone is longer.
    """
    w = Window.partitionBy(qid).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    return ranked.withColumn("cum_chars", F.sum(length).over(w)).withColumn("fits", F.col("cum_chars") <= max_chars) \
                 .filter(F.col("fits") | (F.col("rank") == 1))


def cost_estimate(texts: DataFrame, words: str, prices: DataFrame, tokens_per_word: float = 1.3,
                  by: Sequence[str] = ()) -> DataFrame:
    """Estimated tokens (words x ratio) and cost per model (USD per million tokens), per batch/group."""
    t = texts.groupBy(*by).agg(F.sum(col(words)).alias("words"), F.count(F.lit(1)).alias("n_texts"))
    t = t.withColumn("tokens", F.col("words") * tokens_per_word)
    j = t.crossJoin(F.broadcast(prices))
    return j.withColumn("cost_usd", F.col("tokens") / 1e6 * F.col("usd_per_million"))
