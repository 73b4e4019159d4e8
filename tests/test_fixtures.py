"""Hand-built fixtures with known answers (FIXTURES.md section C)."""

import json
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faro.operators import annotate as N
from faro.operators import metrics as M
from faro.operators import models as K
from faro.operators import text as TX
from faro.operators import tuning as V
from faro.operators import verbs as VB
from faro.operators.recipe import Recipe


def test_tiny_pred_confusion_auc_ties_and_nulls(spark):
    # 12 rows, tied scores; group 'c' has no positives so its recall/AUC are NULL (0/0)
    rows = [(1, 1, 0.9, "a"), (2, 1, 0.8, "a"), (3, 0, 0.8, "a"), (4, 0, 0.3, "a"), (5, 1, 0.5, "a"), (6, 0, 0.5, "a"),
            (7, 1, 0.7, "b"), (8, 0, 0.2, "b"), (9, 1, 0.2, "b"), (10, 0, 0.6, "c"), (11, 0, 0.4, "c"), (12, 0, 0.1, "c")]
    df = spark.createDataFrame(rows, "id int, truth int, score double, grp string").withColumn(
        "pred", (F.col("score") >= 0.5).cast("int"))
    cm = {(r.truth, r.prediction): r.n for r in M.conf_mat(df, "truth", "pred", [0, 1]).collect()}
    assert cm == {(1, 1): 4, (1, 0): 1, (0, 1): 3, (0, 0): 4}
    auc = {r.grp: r.roc_auc for r in M.roc_auc(df, "truth", "score", 1, by=["grp"]).collect()}
    # group a: pos {.9,.8,.5}, neg {.8,.3,.5}: pairs won = 3 + (0.5+1+... ) computed by hand = 7/9
    assert auc["a"] == pytest.approx(7 / 9)
    assert auc["b"] == pytest.approx(0.75)  # pos {.7,.2} vs neg {.2}: 1 + 0.5
    assert auc["c"] is None
    cls = {r.grp: r for r in M.class_metrics(df, "truth", "pred", 1, by=["grp"]).collect()}
    assert cls["c"].recall is None and cls["c"].sens is None


def test_tiny_cut_right_closed(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate([0.0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0, -1.0, None])], "id int, x double")
    out = {r.id: r.x_bin for r in VB.cut(df, "x", [0, 1, 2, 3], ["lo", "mid", "hi"]).collect()}
    assert out == {0: None, 1: "lo", 2: "lo", 3: "mid", 4: "mid", 5: "hi", 6: "hi", 7: None, 8: None}
    low = {r.id: r.x_bin for r in VB.cut(df, "x", [0, 1, 2, 3], ["lo", "mid", "hi"], include_lowest=True).collect()}
    assert low[0] == "lo"


def test_tiny_factor_novel_other_dummy(spark):
    train = spark.createDataFrame([(i, v) for i, v in enumerate(["a"] * 6 + ["b"] * 3 + ["c"])], "id int, level string")
    test = spark.createDataFrame([(1, "a"), (2, "c"), (3, "z"), (4, None)], "id int, level string")
    nov = {r.id: r.level for r in Recipe(None, ids=["id"]).step_novel().prep(train).bake(test).collect()}
    assert nov == {1: "a", 2: "c", 3: "new", 4: None}
    oth = {r.id: r.level for r in Recipe(None, ids=["id"]).step_other(threshold=0.2).prep(train).bake(test).collect()}
    assert oth == {1: "a", 2: "other", 3: "other", 4: None}
    d = Recipe(None, ids=["id"]).step_dummy().prep(train).bake(test)
    assert d.columns == ["id", "level_b", "level_c"]  # first level dropped
    got = {r.id: (r.level_b, r.level_c) for r in d.collect()}
    assert got[2] == (0.0, 1.0) and got[3] == (0.0, 0.0)


def test_tiny_constant_zv_and_normalise(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 3.0, 5.0)], "id int, a double, b double")
    out = Recipe(None, ids=["id"]).step_normalize().step_zv().prep(df).bake(df)
    assert out.columns == ["id", "a"]
    assert [r.a for r in out.orderBy("id").collect()] == pytest.approx([-1.0, 0.0, 1.0])
    # normalise alone keeps b centred (0), never divides by zero
    assert {r.b for r in Recipe(None, ids=["id"]).step_normalize().prep(df).bake(df).collect()} == {0.0}


def test_tiny_tokens_bigrams_tfidf(spark):
    rows = [(1, "Él dijo: ¡Hola, mundo 2024!"), (2, "hola mundo hola"), (3, ""), (4, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    tok = TX.tokenize(df, "doc_id", "text")
    got = [(r.doc_id, r.pos, r.token) for r in tok.orderBy("doc_id", "pos").collect()]
    assert got[:5] == [(1, 1, "él"), (1, 2, "dijo"), (1, 3, "hola"), (1, 4, "mundo"), (1, 5, "2024")]
    assert {d for d, _, _ in got} == {1, 2}  # empty and NULL texts produce no tokens
    bi = [r.bigram for r in TX.tokenize(df, "doc_id", "text", out="bigram", unit="ngrams").filter("doc_id = 2").orderBy("pos").collect()]
    assert bi == ["hola mundo", "mundo hola"]
    tf = {(r.doc_id, r.term): r for r in TX.tf_idf(TX.dtm_triples(tok, "doc_id"), "doc_id").collect()}
    # 'hola' is in both documents -> idf ln(2/2) = 0; 'dijo' only in doc 1 -> tf 1/5, idf ln 2
    assert tf[(1, "hola")].tf_idf == pytest.approx(0.0)
    assert tf[(1, "dijo")].tf_idf == pytest.approx(0.2 * math.log(2))
    assert tf[(2, "hola")].tf == pytest.approx(2 / 3)
    docs = df.select("doc_id")
    lex = TX.lexicon_table(spark, ["hola"], ["mundo"])
    s = {r.doc_id: r.score for r in TX.lexicon_sentiment(tok, docs, "doc_id", lex).collect()}
    assert s == {1: 0, 2: 1, 3: 0, 4: 0}  # documents without hits keep 0


def test_planted_clusters_purity(spark):
    from faro.functions.core import hash_unit
    from faro.operators import cluster as C

    base = spark.range(0, 90).withColumn("truth", (F.col("id") / 30).cast("int"))
    noise = [hash_unit(7, "id", F.lit(j)) - 0.5 for j in range(5)]
    df = base.withColumn("v", F.array(*[F.col("truth") * 10.0 + n for n in noise]))
    a, _ = C.kmeans(df, "v", 3, nstart=3)
    pur = C.validate_clusters(a, "cluster", "truth").first()["purity"]
    assert pur >= 0.9


def test_planted_linear_recovery(spark):
    from faro.functions.core import hash_unit

    df = spark.range(0, 400).select(
        (hash_unit(1, "id") * 10).alias("a"), (hash_unit(2, "id") * 10).alias("b"), (hash_unit(3, "id") * 10).alias("c"),
        ((hash_unit(4, "id") - 0.5) * 0.01).alias("e"))
    df = df.withColumn("y", 3 + 2 * F.col("a") - F.col("b") + 0 * F.col("c") + F.col("e"))
    coef = {r.term: r.estimate for r in K.ols(df, "y", ["a", "b", "c"]).collect()}
    assert coef["(Intercept)"] == pytest.approx(3, abs=0.01)
    assert coef["a"] == pytest.approx(2, abs=0.01) and coef["b"] == pytest.approx(-1, abs=0.01)
    assert coef["c"] == pytest.approx(0, abs=0.01)
    lasso = K.fit(K.linear_reg(penalty=0.05, mixture=1.0), df, "y", ["a", "b", "c"])
    assert abs(list(lasso.model.coefficients)[2]) < 1e-6


def test_ols_p_values_follow_student_t(spark):
    # exact laws: t(1) is Cauchy, t(2) has P(|T| >= t) = 1 - t / sqrt(2 + t^2); large dof approach the normal
    for t in (0.0, 0.3, 1.0, 5.2, 40.0):
        assert K.t_two_sided(t, 1) == pytest.approx(1 - 2 / math.pi * math.atan(t), abs=1e-12)
        assert K.t_two_sided(-t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), abs=1e-12)
    assert K.t_two_sided(1.96, 10 ** 9) == pytest.approx(math.erfc(1.96 / math.sqrt(2)), rel=1e-4)
    df = spark.createDataFrame([(1.0, 1.1), (2.0, 1.9), (3.0, 3.2), (4.0, 3.9), (5.0, 4.2)], "x double, y double")
    mine = {r.term: r for r in K.ols(df, "y", ["x"]).collect()}
    for r in K.tidy(K.fit(K.linear_reg(), df, "y", ["x"])).collect():  # MLlib's own inference
        assert mine[r.term].p_value == pytest.approx(r.p_value, rel=1e-6)
    assert K.tidy(K.fit(K.linear_reg(0.1), df, "y", ["x"])).first().p_value is None


def test_knn_labels_of_any_type_means_and_blocks(spark, monkeypatch):
    rows = [(1, [0.0], "no", 1.0), (2, [1.0], "si", 3.0), (3, [1.0], "no", 5.0), (4, [9.0], "si", 7.0), (5, [0.1], None, None)]
    train = spark.createDataFrame(rows, "id int, v array<double>, lab string, num double")
    q = spark.createDataFrame([(10, [0.2]), (11, [8.0]), (12, [1.0])], "q int, v array<double>")
    got = {r.q: r for r in K.knn_predict(q, train, "q", "v", "lab", 2, key="id").collect()}
    assert (got[10].pred_label, got[10].votes, got[10].prob) == ("no", 1, 0.5)  # 1 'no' : 1 'si', smallest label
    assert got[12].pred_label == "no" and got[11].pred_label == "si"  # distance ties go to the smallest key
    mean = {r.q: r.pred for r in K.knn_predict(q, train, "q", "v", "num", 2, key="id", mode="regression").collect()}
    assert mean == {10: 2.0, 11: 5.0, 12: 4.0}
    monkeypatch.setattr("faro.operators.neighbours.ROWS", 1)  # blocks of k rows, several levels of boxes: same answers
    monkeypatch.setattr("faro.operators.neighbours.FAN", 2)
    assert {r.q: r for r in K.knn_predict(q, train, "q", "v", "lab", 2, key="id").collect()} == got


def test_annotator_runs_once_per_distinct_prompt(spark, tmp_path):
    log = str(tmp_path / "calls")

    def annotator(prompts):
        with open(log, "a") as f:
            f.writelines(f"{p}\n" for p in prompts)
        return prompts.str.upper()

    df = spark.createDataFrame([(i, f"p{i % 5}") for i in range(20)], "id int, prompt string")
    rows, fresh = N.annotate(df, "prompt", annotator)
    assert {r.response for r in rows.collect()} == {f"P{i}" for i in range(5)}
    assert fresh.count() == 5
    again, none = N.annotate(df, "prompt", annotator, cache=fresh)
    assert again.filter("response is null").count() == 0 and none.count() == 0
    assert sorted(open(log).read().split()) == [f"p{i}" for i in range(5)]


def test_annotation_scores_with_missing_labels(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("b", None), (None, "c")]
    r = N.evaluate_annotations(spark.createDataFrame(rows, "t string, l string"), "t", "l").first()
    # a: tp 1 fp 0 fn 1; b: tp 1 fp 1 fn 1; c is labelled only where the truth is missing
    assert r.macro_precision == pytest.approx(0.75) and r.macro_recall == pytest.approx(0.5)


def test_text_windows(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (2, ""), (3, None)], "doc_id int, text string")
    got = [tuple(r) for r in TX.chunk_text(df, "doc_id", "text", 3, 1).orderBy("chunk").collect()]
    assert got == [(1, 0, 1, 3, "a b c"), (1, 1, 3, 3, "c d e"), (1, 2, 5, 1, "e")]


def test_missing_data_queries_meet_missing_data(spark):
    from faro.plans.registry import all_queries
    from tests.conftest import SMOKE

    qs = all_queries()
    assert {r.column_name: r.n_null for r in qs["q03_null_counts"].spark(spark, SMOKE).collect()}["quality"] > 0
    assert qs["q11_missingness_by"].spark(spark, SMOKE).filter("n_missing > 0").count() > 0
    assert qs["j02_anti_join"].spark(spark, SMOKE).filter("n_unlabelled > 0").count() > 0
    assert qs["f09_missing_indicator"].spark(spark, SMOKE).filter("na_ind_price = 1").count() > 0


def test_fold_scores_selection(spark):
    rows = [(p, f, "rmse", est) for p, ests in [(0.001, [1.0, 1.2, 1.1]), (0.01, [1.05, 1.15, 1.1]), (0.1, [1.3, 1.4, 1.35])]
            for f, est in enumerate(ests, start=1)]
    fs = spark.createDataFrame(rows, "penalty double, fold int, metric string, estimate double")
    s = {r.penalty: r for r in V.collect_metrics(fs, ["penalty"]).collect()}
    assert s[0.001].mean == pytest.approx(1.1) and s[0.001].n == 3
    assert s[0.001].std_err == pytest.approx(V.std_err([1.0, 1.2, 1.1]))
    best = V.show_best(V.collect_metrics(fs, ["penalty"]), "rmse", 1, ["penalty"]).first()
    assert best.penalty == 0.001
    one = V.select_by_one_std_err(V.collect_metrics(fs, ["penalty"]), "rmse", [F.desc("penalty")], ["penalty"]).first()
    assert one.penalty == 0.01  # simplest (largest penalty) within one SE of the best


def test_bad_json(spark):
    rows = [(1, json.dumps({"tone": "optimista", "confianza": 0.8})), (2, '{"tone": "pesimista", "confianza": 0.'),
            (3, '{"tone": "neutro", "confianza": "alta"}'), (4, None), (5, "not json")]
    df = spark.createDataFrame(rows, "id int, s string")
    schema = T.StructType([T.StructField("tone", T.StringType()), T.StructField("confianza", T.DoubleType())])
    out = {r.id: r for r in N.parse_json(df, "s", schema).collect()}
    assert out[1].parsed.tone == "optimista" and not out[1].parse_error
    assert out[2].parse_error and out[2].parsed.tone is None
    assert out[3].parse_error and out[3].parsed.confianza is None
    assert out[4].parse_error and out[5].parse_error


def test_csv_round_trip_of_awkward_texts(spark, tmp_path):
    from faro.sources import io as S

    rows = [(1, 'say "hi", twice'), (2, "two\nlines"), (3, None), (4, ""), (5, "  kept spaces "), (6, "back\\slash"), (7, "ñandú, größe"), (8, '"')]
    df = spark.createDataFrame(rows, "id int, text string")
    S.write_table(df, str(tmp_path / "t"), fmt="csv")
    back = S.read_table(spark, str(tmp_path / "t"), df.schema, fmt="csv", multiLine=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    assert sorted((r.id, r.text) for r in back.collect()) == [(i, t or None) for i, t in rows]


def test_multinomial_log_loss(spark):
    df = spark.createDataFrame([("a", 0.5, 0.3, 0.2), ("c", 0.1, 0.1, 0.8), (None, 1.0, 0.0, 0.0), ("b", 0.2, 0.0, 0.8)], "y string, pa double, pb double, pc double")
    got = M.multinomial_log_loss(df, "y", {"a": "pa", "b": "pb", "c": "pc"}).first()[0]
    assert got == pytest.approx(-(math.log(0.5) + math.log(0.8) + math.log(2.0 ** -52)) / 3, rel=1e-6)


def test_context_keeps_a_first_document_that_is_too_long(spark):
    df = spark.createDataFrame([(1, 1, 500), (1, 2, 10), (2, 1, 40), (2, 2, 50), (2, 3, 60)], "q int, rank int, n int")
    got = sorted((r.q, r["rank"], r.fits) for r in N.build_context(df, "q", "n", 100).collect())
    assert got == [(1, 1, False), (2, 1, True), (2, 2, True)]


def test_too_many_levels_are_an_error(spark, monkeypatch):
    from faro.operators import recipe

    monkeypatch.setattr(recipe, "MAX_LEVELS", 2)
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, g string")
    assert recipe._levels(df, "g") == ["a", "b"]
    with pytest.raises(ValueError, match="more than 2 levels"):
        recipe._levels(df.unionByName(spark.createDataFrame([(4, "c")], "id int, g string")), "g")


def test_totals_by_window_equal_totals_by_join(spark):
    """Counts partitioned by document: no shuffle by document, the same weights; a missing document counts but has no row."""
    rows = [(1, "a", 2), (1, "b", 1), (2, "a", 5), (None, "a", 1), (None, "c", 3)]
    c = spark.createDataFrame(rows, "doc int, term string, n long").repartition(4, "doc")
    kept = spark.createDataFrame([("a",)], "term string")
    for terms in (None, kept):
        want, got = (sorted(map(tuple, TX.tf_idf(c, "doc", terms=terms, partitioned=p).collect())) for p in (False, True))
        assert got == want and len(got) == (2 if terms is not None else 3)


def test_hashed_vectors_bigrams_and_document_means(spark):
    """Bytes read eight at a time, n-grams by place, means without a row per dimension: as by the plain definition."""
    import hashlib

    from faro.functions.text import hashed_vector, ngram_array

    toks = [(1, "uno"), (1, "dos"), (1, "uno"), (2, "ñandú"), (None, "x")]
    df = spark.createDataFrame(toks, "doc int, token string")
    vec = lambda t, dim: [b / 255 - 0.5 for b in hashlib.md5(t.encode()).digest()[:dim]]
    for dim in (3, 8, 16):
        assert all(r["v"] == pytest.approx(vec(r["token"], dim), abs=1e-15) for r in df.select("token", hashed_vector("token", dim).alias("v")).collect())
    got = {(r["doc"], r["dim"]): r["value"] for r in TX.doc_vectors(df, "doc", dim=5).collect()}
    for doc in (1, 2, None):
        vs = [vec(t, 5) for d, t in toks if d == doc]
        assert [got[doc, i + 1] for i in range(5)] == pytest.approx([sum(v[i] for v in vs) / len(vs) for i in range(5)], abs=1e-12)
    assert len(got) == 15 and "Generate" not in TX.doc_vectors(df, "doc")._jdf.queryExecution().optimizedPlan().toString().split("Aggregate", 1)[1]
    arr = spark.createDataFrame([(["a", "b", "c", "d"],), (["a"],), ([],)], "t array<string>")
    assert [r[0] for r in arr.select(ngram_array(F.col("t"), 3)).collect()] == [["a b c", "b c d"], [], []]
    assert "get" in str(ngram_array(F.col("t"), 2))


def test_word_vectors_are_trained_in_several_tasks(spark, monkeypatch):
    from faro.operators import topics as TP

    docs = spark.createDataFrame([([f"w{(i + j) % 9}" for j in range(30)],) for i in range(20)], "tokens array<string>")
    monkeypatch.setattr(TP, "TASK_TOKENS", 100)
    m = TP.word2vec(docs, size=4)
    assert m.getNumPartitions() == 6 and m.getVectors().count() == 9
