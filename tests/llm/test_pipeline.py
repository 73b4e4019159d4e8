"""The pipeline's stages against brute force, and the registered queries that have SQL."""

import os
import sys

import duckdb
import pytest

from tests.llm import brute

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
SMOKE = "/root/testdata/sf0.001"


def test_stages_follow_their_contracts(spark):
    import corpus_pipeline
    from faro.llm import pii_crf

    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    (_, toxic), (_, near), (_, leak), (_, pii), (_, pack) = corpus_pipeline.STAGES
    a = toxic(spark, docs, SMOKE).cache()
    before = {r["doc_id"]: r["text"] for r in a.collect()}
    assert a.columns == docs.columns and set(before) <= {r["doc_id"] for r in docs.collect()}
    b = near(spark, a, SMOKE).cache()
    want = {c for i, _, c in brute.simhash(list(before.items()))}
    assert {r["doc_id"] for r in b.collect()} == want and b.columns == docs.columns
    c = leak(spark, b, SMOKE).cache()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()]
    dirty = {r[0] for r in brute.contamination([(i, before[i]) for i in want], items) if r[5]}
    assert {r["doc_id"] for r in c.collect()} == want - dirty
    d = pii(spark, c, SMOKE).cache()
    assert d.columns == docs.columns and d.count() == c.count()
    for r in d.collect():
        assert not pii_crf.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
    e = pack(spark, d, SMOKE)
    assert {r["doc_id"] for r in e.collect()} == want - dirty


def test_stages_take_empty_tables_nulls_repeats_and_clashing_names(spark):
    import corpus_pipeline
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    odd = docs.limit(20).withColumns({"text": F.when(F.col("doc_id") % 5 != 0, F.col("text")), "doc_id": F.when(F.col("doc_id") % 7 != 0, F.col("doc_id")),
                                      "score": F.lit(3), "found": F.lit("x"), "fp": F.lit(1), "piece": F.lit("p")})
    odd = odd.unionByName(odd.limit(3)).cache()
    for name, step in corpus_pipeline.STAGES:
        none = step(spark, docs.limit(0), SMOKE)
        assert none.count() == 0
        got = step(spark, odd, SMOKE)
        if name == "packing":
            assert got.columns == none.columns and got.select("doc_id", "sequence_id", "offset").distinct().count() == got.count()
            continue
        assert got.columns == odd.columns and got.filter("score <> 3 or found <> 'x' or fp <> 1 or piece <> 'p'").count() == 0
        nulls = got.filter("text is null").count()
        assert nulls == (1 if name.startswith("simhash") else odd.filter("text is null").count())


@pytest.mark.parametrize("name,key", [("op2_url_reputation", "page_id"), ("op4_decontaminate", "doc_id")])
def test_queries_equal_their_sql(spark, name, key):
    from faro.llm.queries import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    df = QUERIES[name](spark, SMOKE)
    got = sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])
    want = sorted(con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE_SQL[name]})").fetchall(), key=lambda r: r[0])
    assert got == want
