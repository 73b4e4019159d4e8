"""Language identification: words first, then ever shorter character n-grams.

A known word scores its smoothed log frequency in each language.  An unseen
word falls back to its character n-grams, from the longest to single
characters: the first length at which any of its n-grams is known decides,
by the mean of their log frequencies.  The prediction is the language with
the highest total.

Fitting counts every word and n-gram of a bounded sample of the labelled rows
(``max_rows`` per language, the only bound), so a small language's words are
known as surely as a large one's, and the tables may be broadcast.  Words are
cut by the same expression when learning and when scoring.  Scoring is one scan
without a shuffle, in Arrow batches.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faro.llm.common import cut, fresh, hash_sample, sample_rate, spans_of

WORD = re.compile(r"[^\W\d_]+")
LONGEST = 5          # characters of the longest n-gram
ALPHA = 0.5          # additive smoothing
CACHE = 300_000      # unseen words whose scores a worker remembers


@dataclass
class Model:
    langs: list[str]
    words: dict[str, int]
    word_rows: np.ndarray           # words x langs, log frequency
    grams: dict[str, int]
    gram_rows: np.ndarray


def _log_rows(counts: DataFrame, langs: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Rows (lang, k, n) to an index of k and log((n + a) / (N + a V)) per language."""
    wide = counts.groupBy("k").agg(*[F.sum(F.when(F.col("lang") == lg, F.col("n")).otherwise(0)).alias(f"c{i}") for i, lg in enumerate(langs)])
    got = wide.toArrow().sort_by("k")  # bounded by the words of the sample
    n = np.column_stack([got.column(f"c{i}").to_numpy() for i in range(len(langs))]).astype(np.float64) if got.num_rows else np.zeros((0, len(langs)))
    rows = np.log(n + ALPHA) - np.log(n.sum(axis=0) + ALPHA * (len(n) + 1))
    return {k: r for r, k in enumerate(got.column("k").to_pylist())}, rows.astype(np.float32)


def _grams(marked: Column, g: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(marked) - g + 1, F.lit(1))), lambda i: F.substring(marked, i, F.lit(g)))


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Word counts per language of a batch of (lang, t)."""
    for b in batches:
        count: Counter = Counter()
        for lang, t in zip(b["lang"], b["t"]):
            for part in spans_of(t):
                count.update((lang, w) for w in WORD.findall(part.lower()))
        yield pd.DataFrame([(lang, w, n) for (lang, w), n in count.items()], columns=["lang", "k", "n"])


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = 5000) -> Model | None:
    """Fit on at most about ``max_rows`` rows of each language (chosen by hash); None without labelled text."""
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter("lang is not null and t is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    if not sizes:
        return None
    rate = F.coalesce(*[F.when(F.col("lang") == lg, sample_rate(n, max_rows)) for lg, n in sizes.items()])
    rows = rows.filter(hash_sample(F.coalesce("id", F.xxhash64("t").cast("string")), rate))
    words = rows.select("lang", "t").mapInPandas(_words, "lang string, k string, n long")
    words = cut(words.groupBy("lang", "k").agg(F.sum("n").alias("n")))
    marked = F.concat(F.lit("<"), "k", F.lit(">"))
    grams = words.select("lang", "n", F.explode(F.flatten(F.array(*[
        _grams(marked, g) for g in range(1, LONGEST + 1)]))).alias("k"))
    langs = sorted(sizes)
    w, g = _log_rows(words, langs), _log_rows(grams, langs)
    return Model(langs, w[0], w[1], g[0], g[1])


def back_off(word: str, model: Model) -> np.ndarray:
    """Scores of an unseen word by its longest known n-grams; zeros if not even a character is known."""
    marked = f"<{word}>"
    for g in range(min(LONGEST, len(marked)), 0, -1):
        at = [r for i in range(len(marked) - g + 1) if (r := model.grams.get(marked[i:i + g])) is not None and (g > 1 or marked[i] not in "<>")]
        if at:
            return model.gram_rows[at].mean(axis=0)
    return np.zeros(len(model.langs), dtype=np.float32)


class Scorer:
    """Per-worker scorer: the model's rows with a bounded memory of unseen words behind them."""

    def __init__(self, model: Model):
        self.model = model
        self._reset()

    def _reset(self):
        self.at = dict(self.model.words)
        self.rows = np.concatenate([self.model.word_rows, np.zeros((CACHE, len(self.model.langs)), dtype=np.float32)])
        self.n = len(self.model.words)

    def _index(self, words: list[str]) -> np.ndarray:
        out = [self.at.get(w, -1) for w in words]
        idx = np.array(out, dtype=np.int64)
        for p in np.flatnonzero(idx < 0):
            r = self.at.get(words[p])
            if r is None:
                if self.n == len(self.rows):
                    self._reset()
                    return self._index(words)
                r = self.n
                self.rows[r] = back_off(words[p], self.model)
                self.at[words[p]] = r
                self.n += 1
            idx[p] = r
        return idx

    def __call__(self, text: str | None) -> tuple[str, float]:
        total, n, letters = np.zeros(len(self.model.langs)), 0, False
        for part in spans_of(text or ""):
            words = WORD.findall(part.lower())
            letters = letters or any(map(str.isalpha, words)) or any(any(map(str.isalpha, w)) for w in words)
            for lo in range(0, len(words), CACHE // 2):
                ws = words[lo:lo + CACHE // 2]
                total += self.rows[self._index(ws)].sum(axis=0, dtype=np.float64)
                n += len(ws)
        if not letters:
            return "und", 0.0
        z = (total - total.max()) / np.sqrt(n)
        p = np.exp(z)
        return self.model.langs[int(total.argmax())], float(p.max() / p.sum())


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and a score from 0 to 1 (softmax of the totals over the root of the word count).

    Null texts and texts without a letter are ``und`` with score 0, and so is
    everything without a fitted model; ties go to the first language in
    alphabetical order.  Whole texts are read, in parts; rows are neither
    lost nor merged.  A column that already has the name of an output is replaced;
    all others are untouched.
    """
    if model is None:
        return docs.withColumns({lang_out: F.lit("und"), score_out: F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_rows texts a language

    @F.pandas_udf("lang string, score double")
    def run(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for texts in it:
            yield pd.DataFrame([scorer(t) for t in texts], columns=["lang", "score"]).astype({"score": "float64"})

    tmp = fresh(docs, "scored")
    out = docs.withColumn(tmp, run(F.col(text_col)))
    return out.withColumns({lang_out: F.col(tmp)["lang"], score_out: F.col(tmp)["score"]}).drop(tmp)
