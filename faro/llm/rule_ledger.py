"""Quality rules as a bitmask ledger.

Every rule is evaluated once: one scan of the texts takes the measurements,
and the ledger stores them next to one long of failure bits a document (bit k:
rule k failed).  A policy is a version of which bits reject; applying one, or
asking what a rule contributes, reads the ledger only and never a text.

Rules compare integers (cross-multiplied shares), so that the bits are exact
and any SQL engine agrees.  A rule keeps its bit for ever: new rules are
appended, changed ones get a new name and bit, and policies name the rules they
use, so old ledgers stay readable under new policies and the other way round.

Scale: one narrow pass, nothing shuffled; a task holds one text at a time
(about 30 bytes a byte of it).  Ablations fold the ledger to one row per
distinct bitmask before anything else, at most 2 ** rules rows, however many
documents a mask has.

Defined results.  A null text counts as empty: no words, all measurements 0.
Repeated rows and null or repeated ids are judged each for itself.  An empty
table gives an empty ledger and an ablation of zeros.  The ledger holds the id,
the measurements and ``fail_bits`` only; other columns of the documents are not
read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faro.llm.common import fresh, word_codes

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_digits")
SYMBOLS = b"#*$%&|<>"
MARKS = b"!?"
SPACES = b" \t\n\v\f\r"


@dataclass(frozen=True)
class Rule:
    """``fails``: an SQL condition over the measurements (longs); a rule that cannot be judged does not fail."""

    name: str
    fails: str


RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "1000 * n_symbols > 30 * word_chars"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("short_words", "10 * word_chars < 25 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("capitals", "100 * n_upper > 30 * word_chars"),
    Rule("marks", "100 * n_marks > 25 * n_words"),
    Rule("digits", "100 * n_digits > 40 * word_chars"),
)
BIT = {r.name: 1 << k for k, r in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version of what rejects: any rule of ``reject``, or more than ``allowed`` rules of ``soft``."""

    name: str
    version: int
    reject: tuple[str, ...]
    soft: tuple[str, ...] = ()
    allowed: int = 0

    def mask(self, rules: tuple[str, ...]) -> int:
        return sum(BIT[r] for r in set(rules))

    def rejects(self, bits: Column, without: int = 0) -> Column:
        """Condition over failure bits; rules in the mask ``without`` count as never failing."""
        hard = bits.bitwiseAND(F.lit(self.mask(self.reject) & ~without).cast("long")) != 0
        soft = F.bit_count(bits.bitwiseAND(F.lit(self.mask(self.soft) & ~without).cast("long"))) > self.allowed
        return hard | soft if self.soft else hard


BASE = Policy("base", 1, ("few_words", "repeated_words"))
PROSE = {p.version: p for p in (
    Policy("prose", 1, (*BASE.reject, "symbols", "capitals", "marks")),
    Policy("prose", 2, (*BASE.reject, "symbols", "capitals", "marks", "digits"), ("repeated_lines", "short_words", "long_words"), 0),
)}
LATEST = PROSE[2]


def repeated_words(code: np.ndarray) -> int:
    """Words inside 3-word windows that occur at two or more places of the text."""
    n = len(code)
    if n < 4:
        return 0
    m = int(code.max()) + 1
    if m < 1 << 21:
        key = (code[:-2] * m + code[1:-1]) * m + code[2:]
    else:
        pair = np.unique(code[:-1] * m + code[1:], return_inverse=True)[1]
        key = pair[:-1] * np.int64(m) + code[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    first = np.zeros(n, dtype=bool)
    first[order[1:][same]] = first[order[:-1][same]] = True
    first[1:] |= first[:-1].copy()        # a window covers its word and the two after it
    again = np.zeros(n, dtype=bool)
    again[1:] = first[:-1]
    return int((first | again).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of a text in the order of ``MEASURES``."""
    raw = (text or "").encode()
    bytes_of = np.zeros(256, dtype=np.int64)
    for lo in range(0, len(raw), 1 << 22):
        bytes_of += np.bincount(np.frombuffer(raw, dtype=np.uint8, offset=lo, count=min(1 << 22, len(raw) - lo)), minlength=256)
    words, code = word_codes(text)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    points = len(raw) - int(bytes_of[0x80:0xC0].sum())       # bytes that do not continue a character

    def count(chars: bytes) -> int:
        return int(bytes_of[list(chars)].sum())

    return (len(words), points - count(SPACES), count(SYMBOLS), len(lines) - len(set(lines)), repeated_words(code), len(lines),
            int(bytes_of[65:91].sum()), count(MARKS), int(bytes_of[48:58].sum()))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, measurements as longs, ``fail_bits`` long): every rule evaluated once on every whole text."""

    def work(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=list(MEASURES), dtype="int64")

    schema = ", ".join(f"{m} bigint" for m in MEASURES)
    got = docs.select(F.col(f"`{id_col}`").alias("id"), F.pandas_udf(work, schema)(F.col(f"`{text_col}`")).alias("m"))
    return with_bits(got.select(F.col("id").alias(id_col), "m.*"))


def with_bits(measured: DataFrame) -> DataFrame:
    """``fail_bits`` of a table of measurements (also of a stored ledger, when rules were appended)."""
    bits = [F.when(F.expr(r.fails), F.lit(BIT[r.name]).cast("long")).otherwise(F.lit(0).cast("long")) for r in RULES]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measured.withColumn("fail_bits", total)


def apply(book: DataFrame, policy: Policy = LATEST) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a policy (a document that fails the base policy is never kept)."""
    bits = F.col("fail_bits")
    return book.withColumns({"base_failed": BASE.rejects(bits), "kept": ~(BASE.rejects(bits) | policy.rejects(bits))})


def filter_documents(docs: DataFrame, policy: Policy = LATEST, text_col: str = "text") -> DataFrame:
    """``docs`` (all columns as they were) without the rows whose text the policy rejects."""
    tag = fresh(docs, "ledger_row")
    judged = docs.withColumn(tag, F.pandas_udf(lambda texts: pd.DataFrame([measure(t) for t in texts], columns=list(MEASURES), dtype="int64"),
                                               ", ".join(f"{m} bigint" for m in MEASURES))(F.col(f"`{text_col}`")))
    bits = F.lit(0).cast("long")
    for r in RULES:
        fails = F.expr(" ".join(f"`{tag}`.{w}" if w in MEASURES else w for w in r.fails.split()))
        bits = bits.bitwiseOR(F.when(fails, F.lit(BIT[r.name]).cast("long")).otherwise(F.lit(0).cast("long")))
    return judged.filter(~(BASE.rejects(bits) | policy.rejects(bits))).drop(tag)


def patterns(book: DataFrame, *by: str) -> DataFrame:
    """Documents per distinct ``fail_bits`` (within the groups ``by``): at most 2 ** rules rows a group."""
    return book.groupBy(*by, "fail_bits").agg(F.count(F.lit(1)).alias("n"))


def ablate(book: DataFrame, policy: Policy = LATEST, most: int = 1) -> DataFrame:
    """What each set of up to ``most`` of the policy's rules contributes; one row a set, from the folded bitmasks.

    ``dropped`` names of the set, ``dropped_bits``; ``failed`` documents that
    fail a rule of it, ``failed_all`` that fail all of it, ``rejected`` by the
    whole policy, ``kept_without``: documents kept only because the set is
    left out, ``reasons`` bitwise or of the failures of those documents.
    """
    used = sorted(set(policy.reject) | set(policy.soft), key=lambda r: BIT[r])
    sets = [c for k in range(1, most + 1) for c in combinations(used, k)]
    folded = patterns(book)
    bits, zero = F.col("fail_bits"), F.lit(0).cast("long")
    out = []
    for s in sets:
        mask = policy.mask(s)
        hit = bits.bitwiseAND(F.lit(mask).cast("long"))
        saved = policy.rejects(bits) & ~policy.rejects(bits, mask)
        out.append(F.struct(
            F.lit("+".join(s)).alias("dropped"), F.lit(mask).cast("long").alias("dropped_bits"),
            F.coalesce(F.sum(F.when(hit != 0, F.col("n"))), zero).alias("failed"),
            F.coalesce(F.sum(F.when(hit == mask, F.col("n"))), zero).alias("failed_all"),
            F.coalesce(F.sum(F.when(policy.rejects(bits), F.col("n"))), zero).alias("rejected"),
            F.coalesce(F.sum(F.when(saved, F.col("n"))), zero).alias("kept_without"),
            F.coalesce(F.bit_or(F.when(saved, bits)), zero).alias("reasons")))
    return folded.agg(F.array(*out).alias("rows")).select(F.inline("rows"))


def compare(book: DataFrame, old: Policy, new: Policy) -> DataFrame:
    """Documents per (``kept_old``, ``kept_new``), with the failures that occur among them (``any_bits``) and that all share (``all_bits``)."""
    kept = {n: ~(BASE.rejects(F.col("fail_bits")) | p.rejects(F.col("fail_bits"))) for n, p in (("kept_old", old), ("kept_new", new))}
    return (patterns(book).withColumns(kept).groupBy("kept_old", "kept_new")
            .agg(F.sum("n").alias("n"), F.bit_or("fail_bits").alias("any_bits"), F.bit_and("fail_bits").alias("all_bits")))


def oracle() -> str:
    """DuckDB SQL of the query: measurements, base verdict and the latest policy, from the same rules."""

    def fails(name: str) -> str:
        return "(" + next(r.fails for r in RULES if r.name == name) + ")"

    base = " OR ".join(fails(r) for r in BASE.reject)
    soft = " + ".join(f"CAST({fails(r)} AS INT)" for r in LATEST.soft) or "0"
    hard = " OR ".join(fails(r) for r in LATEST.reject)
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
    win AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS k
            FROM w, unnest(range(1, len(words) - 1)) AS r(i)),
    twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1),
    rep AS (SELECT rid, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) AS s(o) GROUP BY rid),
    m AS (SELECT w.rid, doc_id, CAST(len(words) AS BIGINT) AS n_words,
                 CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                 CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                 CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                 CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
                 CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper,
                 CAST(length(regexp_replace(text, '[^!?]', '', 'g')) AS BIGINT) AS n_marks,
                 CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS BIGINT) AS n_digits
          FROM w LEFT JOIN rep ON rep.rid = w.rid)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({base}) AS base_failed,
           NOT (({base}) OR {hard} OR ({soft}) > {LATEST.allowed}) AS kept
    FROM m"""
