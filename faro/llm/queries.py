"""Registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faro.llm import (bestfit_packing, decontaminate, e8_neardup, langid, period_runs, pii_crf, quality, rule_ledger, simhash, suffix_dedup,
                      toxicity, url_reputation, whitening)
from faro.llm.common import id_crc, read


def op1_e8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e8_neardup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op2_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = url_reputation.outcomes_from_labels(read(spark, sf_dir, "labels"))
    return url_reputation.judge(read(spark, sf_dir, "pages"), outcomes).select("page_id", "host", "path", "rule", "verdict")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(read(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii_crf.find(docs, pii_crf.fit(docs))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = id_crc("doc_id") % 3 == 1
    model = langid.fit(docs.filter(~held))
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op7_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit_packing.pack(read(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(read(spark, sf_dir, "documents"), keep_text=False).drop("kept")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Learned from the labels of the documents table, without the held-out fifth."""
    labels = read(spark, sf_dir, "labels").filter(id_crc("doc_id") % 5 != 0).select("doc_id", "toxic")
    return toxicity.fit(read(spark, sf_dir, "documents"), labels)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = toxicity.score(read(spark, sf_dir, "documents").select("doc_id", "text"), toxicity_model(spark, sf_dir))
    return docs.select("doc_id", (id_crc("doc_id") % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op12_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = rule_ledger.apply(rule_ledger.ledger(read(spark, sf_dir, "documents")))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's text: where crc32(doc_id) is a multiple of ten, words from a place on repeat with a period, both read off the id."""
    h = id_crc("doc_id")
    g = F.floor(h / 10)
    planted = docs.select("doc_id", "text", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))).alias("w"))
    n = F.size("w")
    placed = planted.withColumn("a", F.when(n > 0, g % n).cast("int"))
    placed = placed.withColumn("p", (F.floor((n - F.col("a")) / (3 + g % 8)) + 1).cast("int"))
    tail = n - F.col("a")
    cycle = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(tail / F.col("p")).cast("int")))
    words = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(cycle, F.lit(1), tail))
    return placed.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(words, " ")).alias("text"))


def op13_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = period_runs.collapse(with_planted_runs(read(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    out = docs.select("doc_id", "collapsed", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                      F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("").alias("lines"))
    return out.select("doc_id", "n_runs", (-F.col("best.before")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.shorter")).alias("period"),
                      F.expr("1000 * best.length div -best.shorter").alias("exponent_milli"),
                      F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_e8_neardup, op2_url_reputation, op3_simhash, op4_decontaminate, op5_pii_crf, op6_langid,
                            op7_bestfit_packing, op8_suffix_dedup, op9_toxicity, op10_quality, op11_whitening, op12_rule_ledger, op13_period_runs, pipeline)}

ORACLE_SQL: dict[str, str] = {"op2_url_reputation": url_reputation.oracle(), "op4_decontaminate": decontaminate.oracle(),
                              "op12_rule_ledger": rule_ledger.oracle()}
