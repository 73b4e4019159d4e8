"""Whitening, rule ledger and periodic runs against brute force, on edge cases and on the smoke tables."""

import hashlib
import random
import zlib
from itertools import pairwise

import numpy as np
import pytest

from faro.llm import period_runs, rule_ledger, whitening
from faro.llm.queries import op11_whitening, op12_rule_ledger, op13_period_runs
from tests.llm.brute import period_runs as brute_runs
from tests.llm.brute import planted_words, rule_counts
from tests.llm.test_operators import EDGE, LONG, docs_of

SMOKE = "/root/testdata/sf0.001"

# ---------------------------------------------------------------- 11


def residual(a, values, vectors):
    """Largest entry of A V - V L and of V'V - I, in extended precision, relative to A."""
    a, v = a.astype(np.longdouble), vectors.astype(np.longdouble)
    return (float(np.abs(a @ v - v * values.astype(np.longdouble)).max() / np.abs(a).max()), float(np.abs(v.T @ v - np.eye(len(a))).max()))


@pytest.mark.parametrize("spectrum", [
    np.linspace(1, 9, 24), np.r_[5 + np.arange(8) * 1e-9, np.linspace(1, 2, 16)], np.r_[np.full(6, 3.0), np.full(10, 1.0), np.linspace(0.1, 0.2, 8)],
    np.r_[1e6, 1e6 * (1 - 1e-12), 1.0, np.full(21, 1e-6)], np.geomspace(1e-8, 1e4, 24)])
def test_refined_eigenvectors_are_right_to_double_precision(spectrum):
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    a = (q * spectrum) @ q.T
    a = (a + a.T) / 2
    values, vectors = whitening.eigen(a)
    away, skew = residual(a, values, vectors)
    start = np.linalg.eigh(a.astype(np.float32))[1]
    assert away < 2e-15 and skew < 2e-15
    assert np.abs(np.sort(values)[::-1] - values).max() == 0
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-14 * spectrum.max() * 24
    assert residual(a, np.diag(start.T @ a @ start), start)[1] > 1e-8            # the start alone is not enough


def test_sub_solve_separates_a_cluster_that_the_step_cannot():
    rng = np.random.default_rng(6)
    q = np.linalg.qr(rng.normal(size=(12, 12)))[0]
    a = (q * np.r_[1, 1 + 1e-10, 1 + 2e-10, np.arange(2, 11)]) @ q.T
    a = (a + a.T) / 2
    values, vectors = whitening.eigen(a)
    off = vectors.T.astype(np.longdouble) @ (a @ vectors.astype(np.longdouble))
    assert np.abs(off - np.diag(np.diag(off))).max() < 1e-15 * 20


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 3, "x") for i, v in rows], "vec_id long, embedding array<double>, n int, component string")


def brute_whitened(rows):
    """Definition: integers, exact deviations, covariance of centred rows, double eigenvectors."""
    good = [(i, np.floor(1024 * np.array(v, dtype=float)).astype(int) + 100_000) for i, v in rows]
    n, d = len(good), len(good[0][1])
    s = [sum(int(x[k]) for _, x in good) for k in range(d)]
    dev = {i: sum((n * int(x[k]) - s[k]) ** 2 for k in range(d)) for i, x in good}
    c = np.array([[(n * int(x[k]) - s[k]) / n for k in range(d)] for _, x in good])
    v = c.T @ c / n
    e, w = np.linalg.eigh(v)
    e, w = e[::-1], w[:, ::-1]
    return n, dev, {i: c[k] @ w / np.sqrt(np.maximum(e, 1e-300)) for k, (i, _) in enumerate(good)}, e / np.trace(v)


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=10) * np.arange(1, 11) * 0.1 + 0.3) for i in range(120)]
    rows += [(500 + i, rows[0][1]) for i in range(60)]                           # a hot vector
    odd = [(900, None), (901, []), (902, [1.0] * 9 + [None]), (903, [float("nan")] * 10), (904, [float("inf")] + [0.0] * 9), (905, [1.0, 2.0])]
    got = whitening.whiten(vectors_of(spark, rows + odd).repartition(40), components=8).collect()
    n, dev, white, share = brute_whitened(rows)
    assert len(got) == n * 8 and {r["vec_id"] for r in got} == {i for i, _ in rows}
    sign = {}
    for r in got:
        want = white[r["vec_id"]][r["component"] - 1]
        sign.setdefault(r["component"], np.sign(want) * np.sign(r["whitened"]))
        assert r["n"] == n and int(r["deviation"]) == dev[r["vec_id"]]
        assert abs(r["whitened"] - sign[r["component"]] * want) < 1e-10
        assert abs(r["explained"] - share[r["component"] - 1]) < 1e-12 and r["identity_error"] < 1e-9


def test_whitening_edge_cases(spark):
    assert whitening.whiten(vectors_of(spark, [(1, [1.0, 2.0])]).limit(0)).count() == 0
    assert whitening.whiten(vectors_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)])).count() == 0        # no variance
    flat = whitening.whiten(vectors_of(spark, [(None, [1.0, 2.0, 0.0]), (2, [2.0, 2.0, 0.0]), (2, [2.0, 2.0, 0.0]), (4, [3.5, 2.0, 0.0])])).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in flat) == [(0, 1), (2, 1), (2, 1), (4, 1)]
    assert all(abs(r["explained"] - 1) < 1e-12 for r in flat)
    big = np.array([[3 << 40, -(5 << 40)], [1, 2]], dtype=np.int64)
    assert [int(x) for x in whitening.squared_lengths(big).to_pylist()] == [(3 << 40) ** 2 + (5 << 40) ** 2, 5]
    assert [int(x) for x in whitening.squared_lengths(big.astype(object) * 3).to_pylist()] == [9 * ((3 << 40) ** 2 + (5 << 40) ** 2), 45]


def test_whitening_moments_do_not_depend_on_the_partitions(spark):
    df = spark.read.parquet(f"{SMOKE}/embeddings.parquet")
    a, b = (whitening.moments(df.repartition(k), "embedding", 1024, 100_000) for k in (1, 37))
    assert a.n == b.n and (a.sums == b.sums).all() and np.abs(a.scatter - b.scatter).max() < 1e-12 * np.abs(a.scatter).max()


def test_whitening_query(spark):
    got = op11_whitening(spark, SMOKE).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMOKE}/embeddings.parquet").collect()]
    n, dev, white, share = brute_whitened(rows)
    assert len(got) == 8 * n and all(r["deviation"] == dev[r["vec_id"]] and r["n"] == n for r in got)
    assert all(abs(abs(r["whitened"]) - abs(white[r["vec_id"]][r["component"] - 1])) < 1e-8 for r in got)
    assert all(abs(r["explained"] / share[r["component"] - 1] - 1) < 1e-9 and r["identity_error"] < 1e-9 for r in got)


# ---------------------------------------------------------------- 12

LINES = [(20, "a b\n\na b\n \na b \nc"), (21, "x y z x y z x y z"), (22, "\x0bone\x0ctwo three four\r\n"), (23, "## $$ <a> | & 9! ÄB?"), (24, "a b c d a b c"),
         (25, "aa aa aa"), (26, "aa aa aa aa"), (27, " ".join(["w%d" % k for k in range(50)])), (28, " ".join(["w%d" % k for k in range(49)]))]


def test_ledger_measures_equal_brute_force(spark):
    docs = EDGE + LINES
    got = sorted((tuple(r[c] for c in ("doc_id", *rule_ledger.MEASURES[:5])) for r in rule_ledger.ledger(docs_of(spark, docs)).collect()), key=str)
    assert got == sorted(((i, *rule_counts(t)) for i, t in docs), key=str)
    assert rule_ledger.repeated_words(np.arange(3_000_000) % 2_999_998) == 0     # two words repeat, no window of three
    assert rule_ledger.repeated_words(np.arange(3_000_000) % 2_200_000) == 800_000 * 2


def test_ledger_bits_and_policies(spark):
    book = rule_ledger.ledger(docs_of(spark, EDGE + LINES))
    got = {(r["doc_id"], r["n_words"]): r for r in rule_ledger.apply(book).collect()}
    assert got[(27, 50)]["base_failed"] is False and got[(28, 49)]["base_failed"] and not got[(27, 50)]["fail_bits"] & rule_ledger.BIT["few_words"]
    assert not got[(12, 1)]["kept"] and got[(12, 1)]["fail_bits"] & rule_ledger.BIT["long_words"]
    assert got[(1, 0)]["fail_bits"] == rule_ledger.BIT["few_words"]               # nothing else can be judged without words
    two = rule_ledger.Policy("t", 1, (), ("few_words", "long_words", "symbols"), 1)
    kept = {r["doc_id"]: r["k"] for r in book.withColumn("k", ~two.rejects(book.fail_bits)).collect()}
    assert kept[1] and not kept[12] and not kept[23]
    docs = docs_of(spark, EDGE + LINES)
    left = rule_ledger.filter_documents(docs.withColumnRenamed("rid", "ledger_row"))
    assert left.columns == [c if c != "rid" else "ledger_row" for c in docs.columns]
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(i) for (i, _), r in got.items() for _ in [0] if r["kept"] for _ in range(sum(j == i for j, _ in EDGE + LINES)))
    assert rule_ledger.ledger(docs.limit(0)).count() == 0


def test_ablation_from_bitmasks(spark):
    rnd = random.Random(3)
    masks = [sum(1 << b for b in range(len(rule_ledger.RULES)) if rnd.random() < 0.2) for _ in range(400)]
    book = spark.createDataFrame([(k, m) for k, m in enumerate(masks)], "doc_id long, fail_bits long")
    policy = rule_ledger.LATEST

    def rejects(m, without=0):
        m &= ~without
        return bool(m & policy.mask(policy.reject)) or bin(m & policy.mask(policy.soft)).count("1") > policy.allowed

    for r in rule_ledger.ablate(book, policy, most=2).collect():
        w = r["dropped_bits"]
        saved = [m for m in masks if rejects(m) and not rejects(m, w)]
        assert (r["failed"], r["failed_all"]) == (sum(bool(m & w) for m in masks), sum(m & w == w for m in masks))
        assert (r["rejected"], r["kept_without"]) == (sum(map(rejects, masks)), len(saved))
        assert r["reasons"] == int(np.bitwise_or.reduce(saved or [0]))
    n = len(set(policy.reject) | set(policy.soft))
    assert rule_ledger.ablate(book, policy, most=2).count() == n + n * (n - 1) // 2
    assert {r["failed"] for r in rule_ledger.ablate(book.limit(0), policy).collect()} == {0}
    moved = {(r["kept_old"], r["kept_new"]): r for r in rule_ledger.compare(book, rule_ledger.BASE, policy).collect()}
    assert sum(r["n"] for r in moved.values()) == 400 and (False, True) not in moved
    assert moved[(True, False)]["any_bits"] & policy.mask(rule_ledger.BASE.reject) == 0
    assert rule_ledger.with_bits(rule_ledger.ledger(docs_of(spark, LINES)).drop("fail_bits")).count() == len(LINES)


def test_ledger_query_and_sql(spark):
    from faro.plans.oracle import duck

    got = op12_rule_ledger(spark, SMOKE)
    cur = duck(SMOKE).execute(rule_ledger.oracle())
    at = [[d[0] for d in cur.description].index(c) for c in got.columns]
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r[k] for k in at) for r in cur.fetchall())
    gold = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMOKE}/labels.parquet").collect()}
    kept = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in got.collect()}
    assert all(kept[i][1] == (q == 1) for i, q in gold.items() if not kept[i][0])


# ---------------------------------------------------------------- 13


def run_texts():
    rnd = random.Random(8)
    for n in list(range(0, 14)) * 6:
        yield [rnd.choice("ab") for _ in range(n)]
    for _ in range(150):                                       # blocks of periodic words, some adjacent, some broken
        out = []
        for _ in range(rnd.randint(1, 5)):
            unit = [rnd.choice("abc") for _ in range(rnd.randint(1, 6))]
            out += (unit * 12)[:rnd.randint(1, 40)] + [rnd.choice("abx") for _ in range(rnd.randint(0, 2))]
        yield out
    yield ["a"] * 300
    yield ["a", "b"] * 120 + ["a"] * 90 + ["b", "a"] * 60
    yield (["a"] * 7 + ["x"]) * 30                              # runs inside the period of a longer run
    yield [w for k in range(60) for w in [f"x{k}"] + ["a"] * 8]  # one interval, many words to the left


@pytest.mark.parametrize("shortest,exponent", [(6, 4), (3, 3), (12, 3), (1, 5)])
def test_runs_equal_brute_force(shortest, exponent):
    for words in run_texts():
        code = np.unique(np.array(words, dtype=str), return_inverse=True)[1].astype(np.int64) if words else np.empty(0, dtype=np.int64)
        runs = period_runs.find_runs(code, shortest, exponent)
        assert runs == brute_runs(words, shortest, exponent), words
        inside = {k for s, n, q in runs for k in range(s + q, s + n)}
        assert period_runs.kept_words(len(words), runs).tolist() == [k not in inside for k in range(len(words))]
    with pytest.raises(ValueError):
        period_runs.find_runs(np.zeros(9, dtype=np.int64), 6, 2)


def test_suffix_ranks_and_prefixes():
    rng = np.random.default_rng(4)
    for k in (1, 2, 5):
        code = np.unique(rng.integers(0, k, 200), return_inverse=True)[1]
        rank = period_runs.suffix_ranks(code)
        order = sorted(range(200), key=lambda i: code[i:].tolist())
        assert np.argsort(rank).tolist() == order
        _, lcp = period_runs.common_prefixes(code, rank, np.ones(200, dtype=bool))
        share = [next((h for h, (x, y) in enumerate(zip(code[i:], code[j:])) if x != y), 200 - max(i, j)) for i, j in pairwise(order)]
        assert lcp[1:].tolist() == share


def test_long_periodic_texts_are_not_quadratic():
    n = 60_000
    assert period_runs.find_runs(np.zeros(n, dtype=np.int64)) == [(0, n, 1)]
    many = np.array([w for k in range(6000) for w in [k + 1] + [0] * 9], dtype=np.int64)
    assert period_runs.find_runs(many) == [(10 * k + 1, 9, 1) for k in range(6000)]


def test_collapse_edge_cases(spark):
    docs = EDGE + [(30, "go on " * 50 + "end"), (31, "la " * 9), (31, "la " * 9)]
    df = docs_of(spark, docs).withColumnRenamed("rid", "runs").withColumnRenamed("fp", "collapsed")
    got = period_runs.collapse(df)
    assert got.columns == [*df.columns, "runs_", "collapsed_"] and got.count() == len(docs)
    by_text = {}
    for r in got.collect():
        words = (r["text"] or "").encode().split()
        runs = [tuple(x) for x in r["runs_"]]
        by_text[r["text"]] = (runs, r["collapsed_"])
        if r["text"] is None or len(words) < 1000:
            assert runs == brute_runs(words)
        assert r["runs"] == 1 and r["collapsed"] == 7
    assert by_text["go on " * 50 + "end"] == ([(0, 100, 2)], "go on end") and by_text[None] == ([], "") and by_text["la " * 9][1] == "la"
    assert by_text[LONG][1] == " ".join(LONG.split())
    assert period_runs.collapse(df.limit(0)).count() == 0


def test_runs_query(spark):
    got = {r["doc_id"]: r for r in op13_period_runs(spark, SMOKE).collect()}
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").collect()
    assert len(got) == len(docs)
    planted = 0
    for r in docs:
        words = planted_words(r["doc_id"], r["text"])
        runs = brute_runs(words)
        planted += zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 and bool(runs)
        drop = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        row = got[r["doc_id"]]
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in drop)).hexdigest()
    assert planted > 5
