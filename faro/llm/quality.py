"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document.
Expectation-maximisation over all documents' votes estimates each labeller's
accuracy and the share of bad documents, without any gold label; the
posterior of a document's votes then trains a hashed linear scorer, which
also judges documents on which every labeller abstains.

Scale: votes are folded to one count per vote pattern (at most 3 to the
number of labellers rows), so the estimation sees all documents and is of
fixed size.  One scan of the texts stages votes and hashed features; the scorer
is fitted on those of all documents, by passes in which every task returns the
sum of its gradients (at most ``TASKS`` of fixed size), and scores them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faro.llm.common import spans_of, stage

LABELLERS = ("symbols", "capitals", "menu", "exclaims", "repeats", "variety", "sentences", "word_length", "word_count", "letters")
WINDOW = 100         # words over which variety is measured
# per byte: 1 upper-case letter, 2 lower-case letter or part of a longer character, 3 digit, 4 symbol, 5 sentence end, 6 space, 0 other
KIND = np.zeros(256, dtype=np.uint8)
KIND[65:91], KIND[97:123], KIND[128:], KIND[48:58] = 1, 2, 2, 3
KIND[[ord(c) for c in "#$%&*+/<=>@\\^_`{|}~"]] = 4
KIND[[ord(c) for c in ".!?"]] = 5
KIND[[9, 10, 11, 12, 13, 32]] = 6
BITS = 16            # hashed features: 2 ** BITS
TASKS = 256          # most tasks of a fitting pass, each of which returns 2 ** BITS sums
PASSES = 25          # fitting passes over all features
SLICE = 1 << 20      # features worked on at once
UP, LOW, DIGIT = re.compile(r"[A-Z]+"), re.compile(r"[^\W\dA-Z_]+"), re.compile(r"\d+")


def votes(text: str | None) -> list[int]:
    """Votes of the labellers in order: 1 bad, 0 good, -1 abstain."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    kinds = np.zeros(7, dtype=np.int64)
    for lo in range(0, len(raw), 1 << 20):
        kinds += np.bincount(KIND[raw[lo:lo + (1 << 20)]], minlength=7)
    words = text.split()
    solid = max(len(raw) - kinds[6], 1)
    letters = max(kinds[1] + kinds[2], 1)
    symbol, upper = kinds[4] / solid, kinds[1] / letters
    pipes, exclaims = text.count("|") / max(len(words), 1), text.count("!") / max(len(words), 1)
    lines = [s for s in re.split(r"[\n.]+", text) if s.strip()]
    repeated = 1 - len(set(lines)) / len(lines) if lines else 0.0
    ends = kinds[5] / max(len(words), 1)
    mean = len("".join(words)) / len(words) if words else 0.0
    alpha = (kinds[1] + kinds[2]) / solid

    starts = list(range(0, max(len(words) - WINDOW // 2, 1), WINDOW))
    parts = [words[a:b] for a, b in zip(starts, [*starts[1:], len(words)])] if words else []      # a short rest belongs to the last window
    distinct = [len(set(p)) / len(p) for p in parts] or [1.0]
    variety = sum(distinct) / len(distinct)
    never = (2.0, -1.0)   # an empty range: the labeller does not vote good

    def vote(x: float, good: tuple[float, float], bad: tuple[float, float]) -> int:
        return 0 if good[0] <= x <= good[1] else 1 if x < bad[0] or x > bad[1] else -1

    return [
        vote(symbol, never, (0, 0.05)), vote(upper, never, (0, 0.4)), vote(pipes, never, (0, 0.1)),
        vote(exclaims, never, (0, 0.3)), vote(repeated, never, (0, 0.35)), vote(variety, (0.55, 0.999), (0.35, 1)),
        vote(ends, (0.02, 0.3), (0.004, 0.7)), vote(mean, never, (2.5, 12)), vote(float(len(words)), (50, 1e12), (10, 1e12)),
        vote(alpha, (0.85, 1), (0.7, 1)),
    ]


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, prior: float = 0.15) -> tuple[float, np.ndarray, np.ndarray]:
    """EM over vote patterns (rows of 1, 0, -1): share of bad, per-labeller vote table (labeller, class, vote), posteriors of bad.

    Votes of a class are multinomial (good, bad, abstain).  The start (a bad
    vote is rare on good documents, and good votes are commoner on them) fixes
    which class is the bad one; one pseudo-count a cell keeps the estimates
    inside (0, 1).
    """
    k = patterns.shape[1]
    table = np.empty((k, 2, 3))
    for c in (0, 1):
        table[:, c, :] = [[0.5, 0.02, 0.48], [0.3, 0.3, 0.4]][c]
    at = np.where(patterns < 0, 2, patterns)
    post = np.zeros(len(patterns))
    for _ in range(rounds):
        like = [np.log([1 - prior, prior][c]) + np.log(table[np.arange(k), c, at]).sum(axis=1) for c in (0, 1)]
        new = 1 / (1 + np.exp(np.clip(like[0] - like[1], -50, 50)))
        moved, post = np.abs(new - post).max(initial=0), new
        for c, weight in ((0, counts * (1 - post)), (1, counts * post)):
            for v in range(3):
                table[:, c, v] = ((at == v) * weight[:, None]).sum(axis=0) + 1
            table[:, c, :] /= table[:, c, :].sum(axis=1, keepdims=True)
        prior = float(np.clip((counts * post).sum() / max(counts.sum(), 1), 1e-4, 0.5))
        if moved < 1e-6:
            break
    return prior, table, post


class Features:
    """Hashed features of a text: each token's shape and its lower-cased letters, as shares of the tokens."""

    def __init__(self):
        self.seen: dict[str, tuple[int, int]] = {}

    def _of(self, token: str) -> tuple[int, int]:
        shape = DIGIT.sub("9", LOW.sub("a", UP.sub("A", token)))
        got = (zlib.crc32(b"s" + shape.encode()) & ((1 << BITS) - 1), zlib.crc32(b"w" + token.lower().encode()) & ((1 << BITS) - 1))
        if len(self.seen) > 300_000:
            self.seen.clear()
        self.seen[token] = got
        return got

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        count: Counter = Counter()
        for part in spans_of(text or ""):
            count.update(part.split())
        n = sum(count.values())
        if not n:
            return np.empty(0, dtype=np.int64), np.empty(0)
        at = np.array([self.seen.get(t) or self._of(t) for t in count], dtype=np.int64).ravel()
        share = np.repeat(np.fromiter(count.values(), dtype=np.float64, count=len(count)) / n, 2)
        at, back = np.unique(at, return_inverse=True)
        return at, np.bincount(back, np.sqrt(share))


def slices(at: pd.Series, val: pd.Series):
    """(first row, rows, row of each feature, feature, value) of packed rows, about ``SLICE`` features at once."""
    size = np.array([len(a) // 2 for a in at], dtype=np.int64)
    ends, lo = np.cumsum(size), 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE, side="right")))
        yield (lo, hi - lo, np.repeat(np.arange(hi - lo), size[lo:hi]), np.frombuffer(b"".join(at[lo:hi]), dtype="<u2").astype(np.int64),
               np.frombuffer(b"".join(val[lo:hi]), dtype="<f4"))
        lo = hi


def logits(at: pd.Series, val: pd.Series, w: np.ndarray) -> np.ndarray:
    """Scorer's logit per packed row; the last of the weights is the bias."""
    return np.concatenate([np.bincount(row, w[col] * x, minlength=n) + w[-1] for _, n, row, col, x in slices(at, val)] or [np.empty(0)])


def fit_scorer(rows: DataFrame, weak: dict[tuple, float], n: int, passes: int = PASSES, ridge: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels over all ``rows`` (votes, at, val) by L-BFGS: the weights, then the bias.

    A pass returns mean loss and gradient; ``n`` is the number of rows.
    """
    size = (1 << BITS) + 1
    rows = rows.select("votes", "at", "val")
    rows = rows.coalesce(TASKS) if rows.rdd.getNumPartitions() > TASKS else rows

    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches):
            loss, grad = 0.0, np.zeros(size)
            for b in batches:
                target = np.array([1 - weak.get(tuple(v), 0.5) for v in b["votes"]])
                for lo, m, row, col, x in slices(b["at"], b["val"]):
                    z = np.bincount(row, w[col] * x, minlength=m) + w[-1]
                    y = target[lo:lo + m]
                    loss += float((np.logaddexp(0, z) - y * z).sum())
                    r = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - y
                    grad += np.bincount(col, r[row] * x, minlength=size)
                    grad[-1] += r.sum()
            yield pd.DataFrame({"loss": [loss], "grad": [grad.astype("<f8").tobytes()]})

        got = sorted(rows.mapInPandas(run, "loss double, grad binary").collect(), key=lambda r: (r["loss"], bytes(r["grad"])))  # at most TASKS rows
        grad = np.sum([np.frombuffer(r["grad"], dtype="<f8") for r in got], axis=0) / n
        grad[:-1] += ridge * w[:-1]
        return sum(r["loss"] for r in got) / n + 0.5 * ridge * float(w[:-1] @ w[:-1]), grad

    w = np.zeros(size)
    f, g = value(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    step, left = 1.0, passes - 1
    while left and np.abs(g).max() > 1e-7:
        q, alphas = g.copy(), []
        for ds, dg in reversed(past):
            alphas.append((ds @ q) / (ds @ dg))
            q -= alphas[-1] * dg
        # without a past, the inverse of the curvature's bound: the values of one text have squared length at most 2 and a few repeats
        q *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / 0.75
        for (ds, dg), al in zip(past, reversed(alphas)):
            q += (al - (dg @ q) / (ds @ dg)) * ds
        step = 1.0
        while left:
            left -= 1
            new_f, new_g = value(w - step * q)
            if new_f <= f - 1e-4 * step * float(g @ q):
                break
            step /= 4
        else:
            break
        ds, dg = -step * q, new_g - g
        w, f, g = w + ds, new_f, new_g
        if ds @ dg > 1e-12:
            past = [*past[-7:], (ds, dg)]
    return w


def label(docs: DataFrame, text_col: str = "text", out: str = "votes") -> DataFrame:
    """``docs`` with the labellers' votes (array<int>: 1 bad, 0 good, -1 abstain); a column already named ``out`` is replaced."""

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([votes(t) for t in texts])

    return docs.withColumn(out, run(F.col(text_col)))


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per document: (doc_id, score, keep, votes, weak_bad).

    ``score`` (0 to 1) is the scorer's probability that the text is of good
    quality, ``keep`` whether it reaches the threshold, ``weak_bad`` the
    posterior of bad by the votes alone.  Estimation and the scorer's fit use
    all documents.

    Null and empty texts have no tokens and are scored by the bias; repeated
    rows are judged each (and alike).  Other columns are not read; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    @F.pandas_udf("votes array<int>, at binary, val binary")
    def read(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        feats = Features()
        for texts in it:
            got = [feats(t) for t in texts]
            yield pd.DataFrame({"votes": [votes(t) for t in texts], "at": [a.astype("<u2").tobytes() for a, _ in got], "val": [v.astype("<f4").tobytes() for _, v in got]})

    voted = stage(src.select("doc_id", read("text").alias("r")).select("doc_id", "r.*"), "quality-features")
    rows = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3 ** len(LABELLERS) patterns
    if not rows:
        return src.select("doc_id", F.lit(0.0).alias("score"), F.lit(True).alias("keep"), F.array().cast("array<int>").alias("votes"), F.lit(0.0).alias("weak_bad"))
    rows = sorted(rows, key=lambda r: r["votes"])
    patterns, counts = np.array([r["votes"] for r in rows]), np.array([r["n"] for r in rows], dtype=float)
    _, _, post = estimate(patterns, counts)
    weak = {tuple(p): float(q) for p, q in zip(patterns.tolist(), post)}
    n = int(counts.sum())
    shared = spark.sparkContext.broadcast((fit_scorer(voted, weak, n), weak))  # fixed size

    @F.pandas_udf("score double, weak_bad double")
    def judge(vs: pd.Series, at: pd.Series, val: pd.Series) -> pd.DataFrame:
        w, weak = shared.value
        return pd.DataFrame({"score": 1 / (1 + np.exp(-np.clip(logits(at, val, w), -35, 35))), "weak_bad": [weak.get(tuple(v), 0.5) for v in vs]})

    out = voted.select("doc_id", "votes", judge("votes", "at", "val").alias("j"))
    return out.select("doc_id", F.col("j.score").alias("score"), (F.col("j.score") >= threshold).alias("keep"), "votes", F.col("j.weak_bad").alias("weak_bad"))
