"""Text column expressions and word lists."""

from __future__ import annotations

import functools
import os

from pyspark.sql import Column
from pyspark.sql import functions as F

from faro.functions.core import col

# fixed values: a token is a maximal run of Unicode letters or digits, after lowercasing
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
# fixed values: sentence boundary = run of . ! ? followed by whitespace
SENTENCE_SPLIT = r"[.!?]+\s+"

# fixed values: extra domain stopwords added to the Spanish list in the reference course
EXTRA_STOPWORDS_ES = ["más", "país", "países", "región", "sigue", "siendo", "debe", "debería", "deberían", "ser", "siguen"]

_SPARK_LANG = {"en": "english", "es": "spanish", "fr": "french", "de": "german", "it": "italian", "pt": "portuguese",
               "nl": "dutch"}


def tokens(text: str | Column) -> Column:
    """Array of lowercase word tokens of the whole text (accents kept, punctuation dropped)."""
    return F.regexp_extract_all(F.lower(col(text)), F.lit(TOKEN_PATTERN), 0)


def ngram_array(tok: Column, n: int = 2) -> Column:
    """Consecutive n-grams (space-joined) of a token array; empty when too short."""
    m = F.size(tok) - n + 1
    return F.when(m >= 1, F.transform(F.sequence(F.lit(1), m), lambda i: F.concat_ws(" ", *[F.get(tok, i + (j - 1)) for j in range(n)]))) \
            .otherwise(F.array().cast("array<string>"))


def sentence_array(text: str | Column) -> Column:
    parts = F.split(F.trim(col(text)), SENTENCE_SPLIT)
    return F.filter(F.transform(parts, lambda s: F.lower(F.trim(s))), lambda s: s != "")


def char_array(text: str | Column) -> Column:
    return F.regexp_extract_all(F.lower(col(text)), F.lit(r"[\p{L}\p{N}]"), 0)


@functools.lru_cache(maxsize=None)
def default_stopwords(lang: str) -> tuple[str, ...]:
    """Spark's built-in stop word list for a language.

    The four languages of the default pipelines are package data (see
    ``stopwords/NOTICE``), so no query depends on where Spark's jars lie;
    other languages ask the running Spark.
    """
    name = _SPARK_LANG.get(lang, lang)
    path = os.path.join(os.path.dirname(os.path.abspath(__file__)), "stopwords", f"{name}.txt")
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            words = f.read().split()
    else:
        from pyspark.ml.feature import StopWordsRemover

        words = StopWordsRemover.loadDefaultStopWords(name)
    return tuple(dict.fromkeys(w.strip() for w in words if w.strip()))


def stopword_rows(langs=("en", "es", "fr", "de"), extra_es: bool = True) -> list[tuple[str, str]]:
    rows = []
    for lg in langs:
        ws = list(default_stopwords(lg))
        if lg == "es" and extra_es:
            ws += [w for w in EXTRA_STOPWORDS_ES if w not in ws]
        rows += [(lg, w) for w in ws]
    return rows


def hashed_vector(tok: str | Column, dim: int = 8) -> Column:
    """Deterministic pseudo word vector from the md5 of the token (values in [-0.5, 0.5]).

    Stands in for a pretrained word-vector table lookup; reproducible in SQL.
    """
    return F.array(*hashed_values(tok, dim))


def hashed_values(tok: str | Column, dim: int = 8) -> list[Column]:
    """The values of ``hashed_vector`` as columns; eight bytes of the md5 are read as one number."""
    h = F.md5(col(tok))
    eight = [F.conv(F.substring(h, 16 * c + 1, 16), 16, -10).cast("long") for c in range(-(-dim // 8))]
    return [F.shiftrightunsigned(eight[i // 8], 56 - 8 * (i % 8)).bitwiseAND(F.lit(255)).cast("double") / 255.0 - 0.5 for i in range(dim)]
