"""Training-corpus pipeline: every stage applies one operator to all that the stage before it kept.

Every stage takes null and empty texts, null ids, repeated rows, empty tables
and further columns of any name.  A text without words is no evidence of
anything: toxicity, decontamination and PII keep it, packing makes one piece of
its end token, and among the near copies all such texts are one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faro.llm import bestfit_packing, decontaminate, pii_crf, simhash, toxicity
from faro.llm.common import read, stage
from faro.llm.queries import toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counterfactual-regularised classifier does not call toxic (score below 0.5)."""
    return toxicity.remove_toxic(docs, toxicity_model(spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each SimHash group (3-word shingles, at most 2 differing bits)."""
    return simhash.deduplicate(docs, shingle=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no 10-word window of a benchmark item."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"), n=10, remove="documents")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    out = pii_crf.redact(docs, pii_crf.fit(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences of at most 1024 tokens."""
    return bestfit_packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: learned models, fingerprints and tokenisation are beyond SQL; tests/llm holds brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{k}")
    return docs
