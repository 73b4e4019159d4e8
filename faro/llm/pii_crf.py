"""Personal data by fixed patterns and a skip-chain conditional random field.

Patterns find the base spans.  The field then looks at what the patterns
missed: all number runs of a document, with or without a base span in it, and
the names of its base addresses are its further nodes, next to the base spans.  Neighbouring nodes are joined by chain potentials; nodes
that hold the same digits (or end in the same digits), or the name part of an
e-mail address, are joined by skip potentials however far apart they stand.
A link speaks for agreement, whatever the label; shape and neighbours may
outvote it, and may find personal data where there is no link.
Loopy message passing makes labels agree over the whole document, so that a
number given once as +49 ... is found where it recurs without the sign, and
an address's name where it recurs without the domain.

Unary and chain weights are log-odds from counts over a bounded sample
(``max_rows`` documents) in which the base spans are the labels; runs that
resemble a base span have no known label and are not counted.  Tagging is
one scan without a shuffle; a document's links grow with its nodes (repeats are
tied to one occurrence each, not pairwise).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faro.llm.common import hash_sample, sample_rate

# fixed values: the kinds in the order in which spans are listed, and the patterns of the base spans
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")   # from the start of a digit run: the same matches, in linear time
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

NUMBER = re.compile(r"\(?[0-9](?:[ ().-]{0,2}[0-9]){5,}")
NAME = re.compile(r"[A-Za-z0-9._%+-]{5,}")
LABELS = ("other",) + KINDS
SAME, LIKE = 9.0, 6.0      # skip potentials of equal nodes and of nodes that end alike
SHAPE = 30.0               # most that the shape may speak against a label, for numeric range only
ROUNDS, DAMPING = 12, 0.5
NEAR = 40                  # characters between chain neighbours
TAIL = 7                   # digits that two similar numbers share at the end


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base matches, by kind and then start."""
    out = []
    at, end = text.find("@"), 0
    while at >= 0:
        lo = at
        while lo > end and text[lo - 1] in LOCAL:
            lo -= 1
        m = DOMAIN.match(text, at + 1) if lo < at else None
        if m:
            end = m.end()
            out.append(("email", lo, end))
        at = text.find("@", max(at + 1, end))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        d = _digits(m.group()) if m.end() - m.start() < 64 else ""
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def features(surface: str) -> list[str]:
    """Shape of a node: amount of digits, separators, letters, sizes of the last groups.  The plus sign is left out: it is what base phones all have."""
    d = len(_digits(surface))
    groups = [min(len(g), 9) for g in re.findall("[0-9]+", surface)]
    seps = "".join(sorted({c for c in surface if c in " ().-@_"}))
    return [f"digits={min(d, 20)}", f"seps={seps}", f"letters={any(c.isalpha() for c in surface)}",
            f"last={'-'.join(map(str, groups[-2:]))}"]


def impossible(surface: str) -> list[str]:
    """Kinds that a node cannot be: a number no email, a name only that, wrong check digits no card, a part beyond 255 no ip."""
    if not NUMBER.fullmatch(surface):
        return ["ip", "card", "phone"]
    d, parts = _digits(surface), surface.split(".")
    out = ["email"] + ["card"] * (len(d) > 19 or len(d) >= 16 and not luhn(d))
    return out + ["ip"] * (len(parts) == 4 and all(p.isdigit() for p in parts) and any(len(p.lstrip("0")) > 3 or int(p) > 255 for p in parts))


@dataclass
class Node:
    start: int
    end: int
    surface: str
    kind: str | None        # label of a base span
    exact: str              # equal nodes share it
    like: str               # similar nodes share it


def nodes_of(text: str, base: list[tuple[str, int, int]]) -> list[Node]:
    """Base spans, number runs between them, and further occurrences of the names in base addresses, by place."""
    found = [Node(s, e, text[s:e].lstrip("+"), k, *_keys(text[s:e], k)) for k, s, e in base]
    taken = sorted((s, e) for _, s, e in base)
    names = {n.exact for n in found if n.kind == "email"}

    def free(spans):
        k = 0
        for s, e in spans:
            while k < len(taken) and taken[k][1] <= s:
                k += 1
            if k == len(taken) or taken[k][0] >= e:
                yield s, e

    def runs():
        at = 0
        for s, e in [*taken, (len(text), len(text))]:
            if s > at:
                yield from (m.span() for m in NUMBER.finditer(text, at, s))   # a run that reaches into a base span is split there
            at = max(at, e)

    extra = [Node(s, e, text[s:e], None, *_keys(text[s:e], None)) for s, e in runs()]
    if names:
        for s, e in free(m.span() for m in NAME.finditer(text)):
            key = "name:" + text[s:e].strip("._%+-").casefold()
            if key in names:
                cut = text[s:e]
                lo = s + len(cut) - len(cut.lstrip("._%+-"))
                hi = e - (len(cut) - len(cut.rstrip("._%+-")))
                extra.append(Node(lo, hi, text[lo:hi], None, key, key))
    return sorted(found + extra, key=lambda n: (n.start, n.end, n.kind or ""))


def _keys(surface: str, kind: str | None) -> tuple[str, str]:
    if kind == "email":
        name = surface.split("@", 1)[0].strip("._%+-").casefold()
        # a bare word is too common to be a name: an address's name must be long or structured
        key = "name:" + name if len(name) >= 5 and any(c in "._-0123456789" for c in name) else "address:" + surface.casefold()
        return key, key
    d = _digits(surface)
    return "number:" + d, "tail:" + (d[-TAIL:] if len(d) >= TAIL else d)


@dataclass
class Model:
    unary: dict[tuple[str, int], float]
    bias: list[float]
    chain: list[list[float]]


def _unary(surface: str, model: Model) -> np.ndarray:
    fs = features(surface)
    return np.array([sum(model.unary.get((f, y), 0.0) for f in fs) + model.bias[y] for y in range(len(LABELS))])


def infer(nodes: list[Node], model: Model) -> np.ndarray:
    """Labels by damped loopy sum-product in the log domain; base spans are clamped."""
    n, k = len(nodes), len(LABELS)
    phi = np.stack([_unary(x.surface, model) for x in nodes])
    phi = np.clip(phi - phi.max(axis=1, keepdims=True), -SHAPE, 0)
    for i, x in enumerate(nodes):
        if x.kind:
            phi[i] = -60
            phi[i, LABELS.index(x.kind)] = 0
        else:
            phi[i, [LABELS.index(y) for y in impossible(x.surface)]] = -60
    pairs: list[tuple[int, int]] = []
    pots: list[np.ndarray] = []
    chain = np.array(model.chain)
    for i in range(n - 1):
        if 0 <= nodes[i + 1].start - nodes[i].end <= NEAR:
            pairs.append((i, i + 1))
            pots.append(chain)
    # repeats are tied to the first base span of their key, or where there is none to the occurrence before them
    seed: dict[str, int] = {}
    for i, x in enumerate(nodes):
        if x.kind:
            seed.setdefault(x.exact, i)
            seed.setdefault(x.like, i)
    last: dict[str, int] = {}
    for i, x in enumerate(nodes):
        for key, w in dict([(x.like, LIKE), (x.exact, SAME)]).items():
            j = seed.get(key, last.get(key, i))
            if j != i and (key == x.exact or nodes[j].exact != x.exact):   # equal nodes are tied once
                pairs.append((j, i))
                pots.append(w * np.eye(k))
            last[key] = i
    if not pairs:
        return phi.argmax(axis=1)
    src = np.array([p[0] for p in pairs] + [p[1] for p in pairs])
    dst = np.array([p[1] for p in pairs] + [p[0] for p in pairs])
    m = len(pairs)
    pot = np.concatenate([np.stack(pots), np.stack(pots).transpose(0, 2, 1)])   # edge, source label, target label
    back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
    msg = np.zeros((2 * m, k))
    for _ in range(ROUNDS):
        belief = phi.copy()
        np.add.at(belief, dst, msg)
        out = (belief[src] - msg[back])[:, :, None] + pot
        top = out.max(axis=1)
        new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
        new -= new.max(axis=1, keepdims=True)
        if np.abs(new - msg).max() < 1e-4:
            break
        msg = DAMPING * msg + (1 - DAMPING) * new
    belief = phi.copy()
    np.add.at(belief, dst, msg)
    return belief.argmax(axis=1)


def tag(text: str | None, model: Model) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), both by kind and then start."""
    text = text or ""
    base = base_spans(text)
    nodes = nodes_of(text, base)
    if len(nodes) == len(base):
        return base, base
    extra, end = [], -1
    for x, y in zip(nodes, infer(nodes, model)):
        if x.kind is None and y and x.start >= end:
            extra.append((LABELS[y], x.start, x.end))
            end = x.end
    return base, sorted(base + extra, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def count_evidence(text: str | None) -> Counter:
    """Counts of (feature, label), (label) and (label, next label) with base spans as labels and runs that resemble none as 'other'."""
    out: Counter = Counter()
    text = text or ""
    ns = nodes_of(text, base_spans(text))
    known = {x.like for x in ns if x.kind}
    ys = [LABELS.index(x.kind) if x.kind else None if x.like in known else 0 for x in ns]
    for x, y in zip(ns, ys):
        if y is None:
            continue
        out["n", "", y, 0] += 1
        for f in features(x.surface):
            out["f", f, y, 0] += 1
    for a, b, y, z in zip(ns, ns[1:], ys, ys[1:]):
        if y is not None and z is not None and 0 <= b.start - a.end <= NEAR:
            out["c", "", y, z] += 1
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 10_000) -> Model:
    """Weights from about ``max_rows`` documents, chosen by hash; counts are summed by Spark, a few hundred rows come back."""
    src = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("t"))
    n = src.count()
    sample = src.filter(hash_sample(F.coalesce("id", F.xxhash64("t").cast("string")), F.lit(sample_rate(n, max_rows)))).select("t")

    def run(batches):
        for b in batches:
            total: Counter = Counter()
            for t in b["t"]:
                total.update(count_evidence(t))
            yield pd.DataFrame([(*k, c) for k, c in total.items()], columns=["what", "f", "y", "z", "n"])

    rows = sample.mapInPandas(run, "what string, f string, y int, z int, n long").groupBy("what", "f", "y", "z").agg(F.sum("n").alias("n")).collect()
    k = len(LABELS)
    per, feat, chain = np.ones(k), defaultdict(lambda: np.full(k, 0.5)), np.zeros((k, k))
    for r in sorted(rows, key=lambda r: (r["what"], r["f"], r["y"], r["z"])):
        if r["what"] == "n":
            per[r["y"]] += r["n"]
        elif r["what"] == "f":
            feat[r["f"]][r["y"]] += r["n"]
        else:
            chain[r["y"], r["z"]] += r["n"]
    values = Counter(f.split("=")[0] for f in feat)
    unary = {(f, y): math.log(c[y] / (per[y] - 1 + 0.5 * values[f.split("=")[0]])) for f, c in feat.items() for y in range(k)}
    share = (per / per.sum())[None, :]
    chain = np.log((chain + k * share) / (chain.sum(axis=1, keepdims=True) + k) / share)   # neighbours never seen have no say
    bias = np.log(per / per.sum())
    bias[1:] -= 3.0   # weak shape alone does not make personal data
    return Model(unary, bias.tolist(), chain.tolist())


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans).

    Counts and digest are of the base spans, ``spans`` lists all of them
    (kind:start:end in code points, by kind, then start).  Null and empty
    texts have none; repeated rows are tagged each; whole texts are read.
    Other columns are not read; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred weights

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    def run(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            base, spans = tag(t, shared.value)
            n = Counter(s[0] for s in base)
            out.append((*(n[k] for k in KINDS), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
        return pd.DataFrame(out, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    src = docs.select(F.col(id_col).alias("doc_id"), run(F.col(text_col)).alias("r"))
    return src.select("doc_id", "r.*")


def redact_text(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first, longest one counts."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if e <= at:
            continue
        out += [text[at:max(s, at)], f"[{kind.upper()}]"] if s >= at else []
        at = e
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in the texts replaced by ``[KIND]``; rows, other columns and clean texts unchanged.

    Null and empty texts stay as they are; repeated rows are treated each for
    itself; an empty table stays empty.  A text and the links between its
    numbers are held whole in its task (719 MB measured for 5.4 MB of numbers).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([redact_text(t, tag(t, shared.value)[1]) for t in texts], dtype=object)

    return docs.withColumn(text_col, run(F.col(text_col)))
