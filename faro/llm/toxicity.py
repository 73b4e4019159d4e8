"""Toxicity by a counterfactual-regularised linear classifier.

Presence of words and of word beginnings (4 to 6 letters, so that inflected
forms count together) is scored by logistic regression.  Every labelled text that
names a group (an identity term) has a counterfactual twin with the term
swapped for another of its kind; the squared difference of the two scores
(over all words and beginnings that the swap takes away or brings in) is a
penalty, so that the classifier learns the insult and not the group.  The
lasso keeps words out that carry no evidence, so long clean texts do not add
up to a toxic one.

Feature counts cover all labelled rows: labels are broadcast in blocks, texts
are counted where they lie, and only counts a feature are shuffled; at most
``vocabulary`` features leave the executors.  The weights are fitted on a
bounded sample, stratified by label (``max_rows``), of which only these
features leave the executors.  Scoring is one scan without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faro.llm.common import cut, fresh, hash_sample, sample_rate, spans_of, stage

# fixed values: identity terms by kind; within a kind each may stand for another
IDENTITY = (
    ("men", "women"), ("man", "woman"), ("boys", "girls"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "natives"), ("old", "young"), ("blind", "deaf", "disabled"),
)
WORD = re.compile(r"[^\W\d_]+")
BEGIN = (4, 5, 6)      # letters of a word beginning; written ^...
BLOCK = 1_000_000      # labels broadcast at once
HELD = 500_000         # feature counts that a task holds before it hands them on


@dataclass
class Model:
    weights: dict[str, float]
    bias: float


def words_of(text: str | None) -> set[str]:
    out: set[str] = set()
    for part in spans_of(text or ""):
        out.update(WORD.findall(part.lower()))
    return out


def features_of(ws: set[str]) -> set[str]:
    """Features of a text with these words: the words, and the beginnings of those that are longer."""
    return ws | {"^" + w[:k] for k in BEGIN for w in ws if len(w) > k}


def twins_of(ws: set[str], at: dict[str, int], swap: dict[str, str]) -> list[list[int]]:
    """Per identity term of a text: 1 + number of each known feature that its swap takes away, and minus that of each it brings in."""
    old = features_of(ws)
    out = []
    for w in sorted(ws & swap.keys()):
        new = features_of((ws - {w}) | {swap[w]})
        out.append(sorted([at[f] + 1 for f in old - new if f in at] + [-at[f] - 1 for f in new - old if f in at]))
    return [t for t in out if t]


def labelled_blocks(docs: DataFrame, lab: DataFrame, n: int) -> list[DataFrame]:
    """Rows (y, t) of all labelled documents, no text shuffled: ``n`` labels in blocks of about ``BLOCK``, each broadcast into one scan."""
    k = -(-n // BLOCK) or 1
    parts = [lab] if k == 1 else [lab.filter(F.pmod(F.xxhash64(F.lit(78), F.col("id").cast("string")), F.lit(k)) == j) for j in range(k)]
    return [docs.join(F.broadcast(part), "id").filter("t is not null").select("y", "t") for part in parts]


def presence_counts(rows: DataFrame) -> DataFrame:
    """Of rows (y, t): per feature w the texts that have it (c) and the toxic ones among them (k); the empty w counts all texts."""

    def run(batches):
        total: Counter = Counter()
        toxic: Counter = Counter()

        def flush():
            out = pd.DataFrame({"w": list(total), "c": list(total.values()), "k": [toxic[w] for w in total]})
            total.clear()
            toxic.clear()
            return out

        for b in batches:
            for y, t in zip(b["y"], b["t"]):
                fs = features_of(words_of(t))
                fs.add("")
                total.update(fs)
                if y:
                    toxic.update(fs)
                if len(total) > HELD:
                    yield flush()
        if total:
            yield flush()

    return rows.mapInPandas(run, "w string, c long, k long").groupBy("w").agg(F.sum("c").alias("c"), F.sum("k").alias("k"))


def _swaps(groups) -> dict[str, str]:
    return {w: g[(k + 1) % len(g)] for g in groups for k, w in enumerate(g)}


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_weights(rows: list[list[int]], y: np.ndarray, twins: list[list[int]], n_words: int,
                weight: np.ndarray | None = None, twin_weight: np.ndarray | None = None, lasso: float = 2e-4, fairness: float = 1.0, steps: int = 400) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient on mean log loss + fairness * mean squared twin difference + lasso.

    ``rows`` are the word numbers present in each text; a twin is one swap as
    in ``twins_of``, its score difference the signed sum of those weights.
    A text and its twins count ``weight`` and ``twin_weight`` times.
    """
    weight = np.ones(len(rows)) if weight is None else weight
    twin_weight = np.ones(len(twins)) if twin_weight is None else twin_weight
    n = max(weight.sum(), 1)
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.array([c for r in rows for c in r], dtype=np.int64)
    t_at = np.repeat(np.arange(len(twins)), [len(t) for t in twins])
    signed = np.array([c for t in twins for c in t], dtype=np.int64)
    t_col, sign = np.abs(signed) - 1, np.sign(signed).astype(float)
    pos = max((weight * y).sum() / n if len(y) else 0.5, 1e-6)
    bias0 = float(np.log(pos / max(1 - pos, 1e-6)))
    longest = max((len(r) for r in rows), default=1)
    per_word = np.bincount(col, weight[at], minlength=n_words).max(initial=1) if len(col) else 1
    twin_load = np.bincount(t_col, twin_weight[t_at], minlength=max(n_words, 1)).max(initial=0) * max((len(t) for t in twins), default=0)
    step = 1.0 / (0.25 * (min(longest, 64) * per_word / n + 1) + 2 * fairness * twin_load / n)
    w, b, w_old, b_old = np.zeros(n_words), bias0, np.zeros(n_words), bias0

    def loss(w, b):
        z = np.bincount(at, w[col], minlength=len(rows)) + b
        d = np.bincount(t_at, sign * w[t_col], minlength=len(twins))
        return (weight * (np.logaddexp(0, z) - y * z)).sum() / n + fairness * (twin_weight * d * d).sum() / n + lasso * np.abs(w).sum(), z, d

    now, _, _ = loss(w, b)
    k = 0
    for _ in range(steps):
        mom = k / (k + 3)
        vw, vb = w + mom * (w - w_old), b + mom * (b - b_old)
        _, z, d = loss(vw, vb)
        r = weight * (_sigmoid(z) - y) / n
        grad = np.bincount(col, r[at], minlength=n_words) if len(col) else np.zeros(n_words)
        if len(signed):
            grad += 2 * fairness / n * np.bincount(t_col, sign * (twin_weight * d)[t_at], minlength=n_words)
        nw = vw - step * grad
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * lasso, 0)
        nb = vb - step * r.sum()
        new, _, _ = loss(nw, nb)
        if new > now + 1e-12:
            if k == 0:
                step /= 2
            k, w_old, b_old = 0, w, b
            continue
        w_old, b_old, w, b, k = w, b, nw, nb, k + 1
        if now - new < 1e-9:
            break
        now = new
    return w, b


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", groups=IDENTITY,
        vocabulary: int = 4096, max_rows: int = 20_000, min_texts: int = 5, min_z: float = 6.0, lasso: float = 1e-4, fairness: float = 1.0) -> Model:
    """Learn from documents whose label is 0 or 1 (others, and null texts, are no evidence).

    Kept are the features of at least ``min_texts`` of all labelled texts whose
    presence goes with the label beyond ``min_z`` standard errors.  Their
    weights are fitted on about ``max_rows`` labels, chosen by the hash of
    their id; the rarer label gives up to half of them, and each counts by the
    inverse of its label's rate.
    """
    lab = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("y in (0, 1) and id is not null")
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    per = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    stat = cut(reduce(DataFrame.unionByName, (presence_counts(b) for b in labelled_blocks(src, lab, sum(per.values())))).groupBy("w").agg(F.sum("c").alias("c"), F.sum("k").alias("k")).filter((F.col("c") >= min_texts) | (F.col("w") == "")))
    sizes = stat.filter("w = ''").first()
    n, p = (sizes["c"], sizes["k"]) if sizes else (0, 0)
    if not n or not p or p == n:
        rate = 0.0 if not n else p / n
        return Model({}, float(np.log((rate * n + 0.5) / (n - rate * n + 0.5))) if n else -3.0)
    # association of a feature's presence with the label over all labelled rows: score-test z
    q = p / n
    z = (F.col("k") - F.col("c") * q) / F.sqrt(F.col("c") * q * (1 - q) * F.greatest(1 - F.col("c") / F.lit(float(n)), F.lit(1e-3)))
    best = stat.filter("w <> ''").withColumn("z", F.abs(z)).filter(F.col("z") > min_z).orderBy(F.desc("z"), "w").limit(vocabulary).select("w").collect()
    rarer, other = sorted(per, key=lambda y: (per[y], y))
    rate = {rarer: sample_rate(per[rarer], max(max_rows // 2, max_rows - per[other]))}
    rate[other] = sample_rate(per[other], max_rows - min(per[rarer], max_rows // 2))
    some = lab.filter(hash_sample(F.col("id").cast("string"), F.when(F.col("y") == 1, rate[1]).otherwise(rate[0])))
    rows = stage(src.join(F.broadcast(some), "id").filter("t is not null").select("y", "t"), "toxic-labelled")
    terms = sorted({w for g in groups for w in g})
    words = list(dict.fromkeys([r["w"] for r in best] + terms))  # bounded by the vocabulary
    at = {w: k for k, w in enumerate(words)}
    swap = _swaps(groups)

    def numbered(batches):
        for b in batches:
            ws = [words_of(t) for t in b["t"]]
            yield pd.DataFrame({"y": b["y"], "f": [sorted(at[f] for f in features_of(w) if f in at) for w in ws], "twins": [twins_of(w, at, swap) for w in ws]})

    got = rows.select("y", "t").mapInPandas(numbered, "y int, f array<int>, twins array<array<int>>").groupBy("y", "f", "twins").count().collect()
    feats, y, twins, weight, twin_weight = [], [], [], [], []
    for r in sorted(got, key=lambda r: (r["y"], r["f"], r["twins"])):
        feats += [r["f"]] * r["count"]
        y += [r["y"]] * r["count"]
        twins += r["twins"] * r["count"]
        weight += [1 / rate[r["y"]]] * r["count"]
        twin_weight += [1 / rate[r["y"]]] * len(r["twins"]) * r["count"]
    w, b = fit_weights(feats, np.array(y, dtype=float), twins, len(words), np.array(weight), np.array(twin_weight), lasso, fairness)
    return Model({words[k]: float(w[k]) for k in np.flatnonzero(w)}, float(b))


def score_text(text: str | None, weights: dict[str, float], bias: float, begins: dict[int, set[str]] | None = None) -> float:
    known: set[str] = set()
    begins = beginnings(weights) if begins is None else begins
    for part in spans_of(text or ""):
        ws = set(WORD.findall(part.lower()))
        known |= weights.keys() & ws
        for k, some in begins.items():
            known.update("^" + b for b in some & {w[:k] for w in ws if len(w) > k})
    return float(_sigmoid(bias + sum(weights[w] for w in sorted(known))))


def beginnings(weights: dict[str, float]) -> dict[int, set[str]]:
    """The weighted word beginnings by their length, without the mark."""
    out: dict[int, set[str]] = {}
    for w in weights:
        if w[0] == "^":
            out.setdefault(len(w) - 1, set()).add(w[1:])
    return out


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability (0 to 1) that a text is toxic.

    Null, empty and wordless texts get the base rate's score; every row keeps
    its place and columns (one already named ``out`` is replaced); texts are read
    whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        m = shared.value
        begins = beginnings(m.weights)
        return pd.Series([score_text(t, m.weights, m.bias, begins) for t in texts], dtype="float64")

    return docs.withColumn(out, run(F.col(text_col)))


def remove_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, columns unchanged.

    Null and empty texts have the base rate's score and are kept wherever that
    is below the threshold; repeated rows and null ids are judged by their text;
    an empty table stays empty.
    """
    tmp = fresh(docs, "toxic_score")
    return score(docs, model, text_col, tmp).filter(F.col(tmp) < threshold).drop(tmp)
