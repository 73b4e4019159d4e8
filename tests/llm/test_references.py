"""Learned operators against plain versions: dictionary back-off, a slow optimiser, loops for EM, exact marginals."""

import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np

from faro.llm import langid, pii_crf, quality, toxicity
from tests.llm.test_operators import LONG, docs_of, prose

SMOKE = "/root/testdata/sf0.001"
LETTERS = re.compile(r"[^\W\d_]+")

# ---------------------------------------------------------------- op6


class DictionaryBackOff:
    """Words by log frequency per language, unseen words by their longest known n-grams."""

    def __init__(self, rows):
        self.langs = sorted({lang for _, lang in rows if lang is not None})
        words, grams = defaultdict(Counter), defaultdict(Counter)
        for text, lang in rows:
            if lang is None or text is None:
                continue
            for w in LETTERS.findall(text.lower()):
                words[w][lang] += 1
                marked = f"<{w}>"
                for g in range(1, 6):
                    for i in range(max(len(marked) - g + 1, 1)):
                        grams[marked[i:i + g]][lang] += 1
        self.words, self.grams = self.logs(words), self.logs(grams)

    def logs(self, table):
        total = {lg: sum(c[lg] for c in table.values()) for lg in self.langs}
        return {k: [math.log(c[lg] + 0.5) - math.log(total[lg] + 0.5 * (len(table) + 1)) for lg in self.langs] for k, c in table.items()}

    def word(self, w):
        if w in self.words:
            return self.words[w]
        marked = f"<{w}>"
        for g in range(min(5, len(marked)), 0, -1):
            at = [self.grams[marked[i:i + g]] for i in range(len(marked) - g + 1) if marked[i:i + g] in self.grams and (g > 1 or marked[i] not in "<>")]
            if at:
                return [sum(c) / len(at) for c in zip(*at)]
        return [0.0] * len(self.langs)

    def __call__(self, text):
        ws = LETTERS.findall((text or "").lower())
        if not ws:
            return "und", 0.0
        total = [sum(c) for c in zip(*map(self.word, ws))]
        e = [math.exp((t - max(total)) / math.sqrt(len(ws))) for t in total]
        return self.langs[total.index(max(total))], max(e) / sum(e)


def test_langid_equals_dictionary_back_off(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text", "lang").collect()
    rare = [(10_001, "zyxo quavl zyxo", "xx"), (10_002, "zyxo brimf", "xx"), (10_003, None, "xx"), (10_004, "no language", None)]     # a small language
    train = [(r["doc_id"], r["text"], r["lang"]) for r in docs if r["doc_id"] % 3] + rare
    df = spark.createDataFrame(train + train[:5], "doc_id long, text string, lang string")                # repeated rows count again
    model = langid.fit(df)
    plain = DictionaryBackOff([(t, lg) for _, t, lg in train + train[:5]])
    assert model.langs == plain.langs and set(model.words) == set(plain.words) and set(model.grams) == set(plain.grams)
    tests = [(r["doc_id"], r["text"]) for r in docs] + [(1, "zyxo"), (2, "quavlzyxo brimf"), (3, None), (4, ""), (5, "123 -- _"), (6, "漢字"), (7, "ΣΊΣΥΦΟΣ ſtraße İ"), (8, LONG), (8, LONG)]
    got = langid.predict(spark.createDataFrame(tests, "k long, text string"), model).collect()
    assert len(got) == len(tests)
    for r in got:
        lang, score = plain(r["text"])
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-4, r["text"]


def test_langid_keeps_the_words_of_a_small_language(spark):
    big = [(k, prose(k, 300), "aa") for k in range(200)]
    df = spark.createDataFrame([*big, (999, "skolvet nimbra", "bb")], "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert {"skolvet", "nimbra"} <= set(model.words)


# ---------------------------------------------------------------- op9


def objective(w, b, rows, y, twins, lasso, fairness):
    z = np.array([b + sum(w[c] for c in r) for r in rows])
    d = np.array([sum(np.sign(s) * w[abs(s) - 1] for s in t) for t in twins]) if twins else np.zeros(0)
    return (np.logaddexp(0, z) - y * z).mean() + fairness * (d * d).sum() / len(rows) + lasso * np.abs(w).sum()


def test_toxicity_weights_reach_the_optimum_of_a_plain_method():
    rng = np.random.default_rng(0)
    n, m = 120, 9
    rows = [sorted(rng.choice(m, rng.integers(1, 5), replace=False).tolist()) for _ in range(n)]
    y = np.array([float(0 in r or (3 in r and rng.random() < 0.7)) for r in rows])
    twins = [[1 + 4, -(1 + 5)] for r in rows if 4 in r] + [[1 + 5, -(1 + 4)] for r in rows if 5 in r]
    w, b = toxicity.fit_weights(rows, y, twins, m, lasso=1e-3, fairness=1.0, steps=4000)
    x = np.zeros((n, m))
    for i, r in enumerate(rows):
        x[i, r] = 1
    t = np.zeros((len(twins), m))
    for i, s in enumerate(twins):
        for c in s:
            t[i, abs(c) - 1] += np.sign(c)
    v, c = np.zeros(m), 0.0
    step = 1 / (0.25 * np.linalg.norm(np.column_stack([x, np.ones(n)]), 2) ** 2 / n + 2 * np.linalg.norm(t, 2) ** 2 / n)
    for _ in range(40_000):                                            # plain proximal gradient
        r = (1 / (1 + np.exp(-(x @ v + c))) - y) / n
        v = v - step * (x.T @ r + 2 / n * t.T @ (t @ v))
        v = np.sign(v) * np.maximum(np.abs(v) - step * 1e-3, 0)
        c -= step * r.sum()
    assert objective(w, b, rows, y, twins, 1e-3, 1.0) <= objective(v, c, rows, y, twins, 1e-3, 1.0) + 1e-5
    assert abs(w[4] - w[5]) < 0.05


def test_toxicity_scores_are_the_sum_of_the_weights(spark):
    model = toxicity.Model({"bad": 2.0, "^awfu": 1.5, "^awful": 0.25, "kind": -1.0}, -0.5)
    rows = [(1, "Bad bad"), (2, "awfully kind"), (3, "awfu"), (4, None), (5, ""), (6, LONG + " bad"), (None, "kind"), (7, "AWFULNESS bad")]
    want = {1: 1.5, 2: 0.25, 3: -0.5, 4: -0.5, 5: -0.5, 6: 1.5, None: -1.5, 7: 3.25}
    got = {r["doc_id"]: r["s"] for r in toxicity.score(docs_of(spark, rows), model, out="s").collect()}
    assert all(abs(got[k] - 1 / (1 + math.exp(-z))) < 1e-12 for k, z in want.items())
    assert toxicity.score(docs_of(spark, rows).limit(0), model, out="s").count() == 0


# ---------------------------------------------------------------- op10


def test_quality_posteriors_equal_em_by_loops():
    rng = np.random.default_rng(3)
    votes = [tuple(int(v) for v in rng.choice([1, 0, -1], 4, p=[0.2, 0.3, 0.5])) for _ in range(300)]
    patterns = sorted(set(votes))
    counts = np.array([votes.count(p) for p in patterns], dtype=float)
    share, table, post = quality.estimate(np.array(patterns), counts, rounds=7)
    prior, prob = 0.15, [[{0: 0.5, 1: 0.02, -1: 0.48}, {0: 0.3, 1: 0.3, -1: 0.4}] for _ in range(4)]
    for _ in range(7):
        weight = {}
        for p in patterns:
            like = [(1 - prior if c == 0 else prior) * math.prod(prob[j][c][v] for j, v in enumerate(p)) for c in (0, 1)]
            weight[p] = like[1] / sum(like)
        for j in range(4):
            for c in (0, 1):
                mass = {v: 1 + sum(n * (weight[p] if c else 1 - weight[p]) for p, n in zip(patterns, counts) if p[j] == v) for v in (0, 1, -1)}
                prob[j][c] = {v: x / sum(mass.values()) for v, x in mass.items()}
        prior = min(max(sum(n * weight[p] for p, n in zip(patterns, counts)) / counts.sum(), 1e-4), 0.5)
    assert abs(share - prior) < 1e-12 and np.abs(post - [weight[p] for p in patterns]).max() < 1e-12
    assert all(abs(table[j, c, {0: 0, 1: 1, -1: 2}[v]] - prob[j][c][v]) < 1e-12 for j in range(4) for c in (0, 1) for v in (0, 1, -1))


def test_quality_reads_closing_words_and_whole_tokens():
    fresh = [f"w{k}" for k in range(100)]
    variety = quality.LABELLERS.index("variety")
    assert quality.votes(" ".join(fresh + ["same"] * 49))[variety] != quality.votes(" ".join(fresh))[variety] or \
        quality.votes(" ".join(["same"] * 100 + [f"v{k}" for k in range(49)])) != quality.votes(" ".join(["same"] * 100))
    f = quality.Features()
    a, b = f("x" * 70 + "A9"), f("x" * 70 + "!!")
    assert set(a[0].tolist()) != set(b[0].tolist()) and len(set(a[0].tolist()) & set(b[0].tolist())) == 0      # shapes differ beyond 64 characters


def test_quality_scorer_is_at_the_minimum(spark):
    docs = docs_of(spark, [(k, prose(k, 60) + ".") for k in range(60)] + [(100 + k, "QX| " * 40) for k in range(20)])
    got = quality.classify(docs).collect()
    f, rows = quality.Features(), []
    for r in docs.collect():
        at, val = f(r["text"])
        rows.append((r["doc_id"], at, val.astype(np.float32).astype(float)))
    weak = {r["doc_id"]: r["weak_bad"] for r in got}
    z = {r["doc_id"]: math.log(r["score"] / (1 - r["score"])) for r in got}
    size = (1 << quality.BITS) + 1
    # the weights are X' residual / (n ridge) at the minimum of the ridge-penalised loss: the logits follow from the scores alone
    res = {i: (1 / (1 + math.exp(-z[i])) - (1 - weak[i])) / len(rows) for i, _, _ in rows}
    w = np.zeros(size - 1)
    for i, at, val in rows:
        np.add.at(w, at, -res[i] * val / 1e-4)
    back = {i: float(w[at] @ val) for i, at, val in rows}
    bias = np.median([z[i] - back[i] for i, _, _ in rows])
    assert np.corrcoef([back[i] + bias for i, _, _ in rows], [z[i] for i, _, _ in rows])[0, 1] > 0.9
    assert abs(sum(res.values())) < 1e-2                               # the bias has no gradient


# ---------------------------------------------------------------- op5


def exact_labels(nodes, model):
    """Argmax of the exact marginals by enumeration over the labels of all nodes."""
    k = len(pii_crf.LABELS)
    free = []
    for x in nodes:
        u = pii_crf._unary(x.surface, model)
        u = np.clip(u - u.max(), -pii_crf.SHAPE, 0)
        if x.kind:
            u = np.full(k, -60.0)
            u[pii_crf.LABELS.index(x.kind)] = 0
        else:
            u[[pii_crf.LABELS.index(y) for y in pii_crf.impossible(x.surface)]] = -60
        free.append(u)
    ties = []
    for i in range(len(nodes) - 1):
        if 0 <= nodes[i + 1].start - nodes[i].end <= pii_crf.NEAR:
            ties.append((i, i + 1, np.array(model.chain)))
    first = {}
    for i, x in enumerate(nodes):
        if x.kind:
            first.setdefault(x.exact, i)
            first.setdefault(x.like, i)
    last = {}
    for i, x in enumerate(nodes):
        for key, w in dict([(x.like, pii_crf.LIKE), (x.exact, pii_crf.SAME)]).items():
            j = first.get(key, last.get(key, i))
            if j != i and (key == x.exact or nodes[j].exact != x.exact):
                ties.append((j, i, w * np.eye(k)))
            last[key] = i
    mass = np.zeros((len(nodes), k))
    for ys in itertools.product(range(k), repeat=len(nodes)):
        e = sum(u[y] for u, y in zip(free, ys)) + sum(p[ys[a], ys[b]] for a, b, p in ties)
        p = math.exp(e)
        for i, y in enumerate(ys):
            mass[i, y] += p
    return mass


def test_crf_labels_equal_exact_marginals_on_small_documents(spark):
    model = pii_crf.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    texts = ["call +44 20 7946 0958 or 2079460958 today", "ip 10.20.30.40 then 10 20 30 40", "4111 1111 1111 1111 and 4111111111111111 end 77",
             "in 1999 we had 12 of 300 and 4567", "mail anna.k9@mail.org or anna.k9 there", "+1 555 010 9999, again 5550109999, room 9999",
             "2079460958 is like 442079460958 and 2079460958", "order 4111111111111111 ref 4111111111111111", "a 5 b 6 c 7"]
    compared = 0
    for text in texts:
        nodes = pii_crf.nodes_of(text, pii_crf.base_spans(text))
        if not 0 < len(nodes) <= 6:
            continue
        mass = exact_labels(nodes, model)
        got = pii_crf.infer(nodes, model)
        best = np.sort(mass, axis=1)[:, ::-1]
        for i, y in enumerate(got):
            if best[i, 1] < 0.8 * best[i, 0]:                          # not a near tie, where loops may tip it
                assert mass[i, y] == best[i, 0], (text, i)
                compared += 1
    assert compared >= 12


def test_crf_finds_planted_repeats_and_leaves_other_numbers(spark):
    model = pii_crf.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rng = np.random.default_rng(1)
    forms = {"same digits": ("+44 {a} {b} {c}", "44{a}{b}{c}"), "local form": ("+1 {a}{b} {c}", "({a}{b}) {c}"), "spaced ip": ("10.20.30.40", "10 20 30 40"),
             "address name": ("anna.k{a}@mail.org", "anna.k{a}"), "shared tail only": ("+44 {a} {b} {c}", "{a}{b}{c}")}
    found, wrong = Counter(), 0
    for name, (full, again) in forms.items():
        for _ in range(30):
            d = "".join(map(str, rng.integers(1, 9, 12)))
            part = {"a": d[:3], "b": d[3:5], "c": d[5:9]}
            rep = again.format(**part)
            text = (f"{prose(int(rng.integers(1e6)), 20)} {full.format(**part)} {prose(int(rng.integers(1e6)), 20)} call {rep} back in "
                    f"{rng.integers(1900, 2020)} with {rng.integers(10, 99)} of {rng.integers(100, 999)}")
            base, every = pii_crf.tag(text, model)
            at = text.rindex(rep)
            hits = [s < at + len(rep) and e > at for _, s, e in every if (_, s, e) not in base]
            found[name] += any(hits)
            wrong += sum(not h for h in hits)
    assert wrong == 0                                                  # years and counts stay
    assert all(found[n] == 30 for n in ("same digits", "local form", "spaced ip", "address name"))
    assert found["shared tail only"] == 0                              # a bare run's shape outvotes seven equal digits
