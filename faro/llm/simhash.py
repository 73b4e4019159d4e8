"""SimHash near-duplicates with bit-sliced comparison.

A text's fingerprint has bit b set where more than half of its word shingles'
XXH64 hashes have it.  Two fingerprints at most ``radius`` bits apart agree
on at least one choice of ``bands - radius`` of ``bands`` bit ranges, so
every link meets in the bucket of such a choice: no link is lost.

Within a bucket the fingerprints are stored as 64 vertical bit planes.  One
query is compared with 64 fingerprints per machine word: the differing bits
of each plane go through carry-save adders into counter planes, and a block
is abandoned as soon as every fingerprint in it has passed the radius.

Scale: equal fingerprints collapse to one row before anything is paired, so
groups of copies cost nothing.  Buckets larger than ``block`` are cut into a
grid of block pairs, so a task holds two blocks at most; star edges (linear
in the block), not pairs, leave a task.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faro.llm.common import components, cut, fresh, row_keys, star

SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of one text, as a signed 64-bit integer."""
    from xxhash import xxh64_digest

    words = text.encode("utf-8").lower().split() if text else []  # bytes.lower and bytes.split: ASCII letters and white space
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = xxh64_digest(b" ".join(words), SEED)
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - shingle + 1].tolist()
        hashes = b"".join([xxh64_digest(line[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:].tolist())])
    h = np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[lo:lo + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = 3, out: str = "fp") -> DataFrame:
    """``docs`` with a long column ``out``: the SimHash of the whole text (null and wordless texts: 0); a column of that name is replaced."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.withColumn(out, fp(F.col(text_col)))


def planes(values: np.ndarray) -> np.ndarray:
    """Vertical layout: 64 rows of packed bits, one bit per fingerprint (padded to whole 64-bit words)."""
    n = -(-len(values) // 64) * 64
    bits = np.zeros((n, 64), dtype=np.uint8)
    bits[:len(values)] = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def within(queries: np.ndarray, block: np.ndarray, n: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, position in block) at most ``radius`` bits apart, from the block's ``planes``.

    ``low`` and ``high`` are the counter planes of a carry-save adder that
    takes two difference planes at a time; counts above the radius stick in
    ``over``.  Queries whose whole block has passed the radius leave the loop.
    """
    levels = max(1, int(radius + 1).bit_length())
    left = np.arange(len(queries))
    pad = np.zeros(block.shape[1] * 64, dtype=np.uint8)
    pad[n:] = 1
    over = np.tile(np.packbits(pad, bitorder="little").view("<u8"), (len(queries), 1))
    count = [np.zeros_like(over) for _ in range(levels)]
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    qbits = np.unpackbits(queries.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(bool)
    for b in range(0, 64, 2):
        d1 = block[b][None, :] ^ np.where(qbits[left, b], ones, np.uint64(0))[:, None]
        d2 = block[b + 1][None, :] ^ np.where(qbits[left, b + 1], ones, np.uint64(0))[:, None]
        u = count[0] ^ d1
        carry = (count[0] & d1) | (u & d2)
        count[0] = u ^ d2
        for k in range(1, levels):
            count[k], carry = count[k] ^ carry, count[k] & carry
        over |= carry
        over |= _above(count, radius)
        if b % 8 == 6:
            live = (over != ones).any(axis=1)
            if not live.all():
                left, over, count = left[live], over[live], [c[live] for c in count]
                if not len(left):
                    break
    hit = np.unpackbits(np.ascontiguousarray(~over).view(np.uint8), axis=1, bitorder="little").astype(bool)
    q, p = np.nonzero(hit) if len(left) else (np.empty(0, dtype=int), np.empty(0, dtype=int))
    return left[q], p


def _above(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Bit planes of 'counter > radius', from the highest counter bit down."""
    more = np.zeros_like(count[0])
    same = np.full_like(count[0], np.uint64(0xFFFFFFFFFFFFFFFF))
    for k in reversed(range(len(count))):
        if radius >> k & 1:
            same &= count[k]
        else:
            more |= same & count[k]
            same &= ~count[k]
    return more


def _ranges(bands: int) -> list[tuple[int, int]]:
    edge = [round(64 * k / bands) for k in range(bands + 1)]
    return list(zip(edge, edge[1:]))


def _compare(radius: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf["fp"].to_numpy()
        left, right = np.flatnonzero(pdf["as_i"].to_numpy()), np.flatnonzero(pdf["as_j"].to_numpy())
        block = planes(v[right].view(np.uint64))
        i, j = [], []
        for lo in range(0, len(left), 512):
            at = left[lo:lo + 512]
            q, p = within(v[at].view(np.uint64), block, len(right), radius)
            i.append(at[q])
            j.append(right[p])
        i, j = np.concatenate(i), np.concatenate(j)
        keep = v[i] != v[j]
        root = star(len(v), i[keep], j[keep])
        at = np.flatnonzero(root != np.arange(len(v)))
        return pd.DataFrame({"a": v[at], "b": v[root[at]]})

    return run


def fingerprint_links(prints: DataFrame, radius: int = 2, bands: int = 4, block: int = 4096) -> DataFrame:
    """Star edges (a, b) joining the distinct fingerprints of ``prints(fp)`` that lie within ``radius`` bits."""
    if not 0 <= radius < bands:
        raise ValueError("radius must be below the number of bands")
    if radius == 0:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    masks = []
    for chosen in itertools.combinations(_ranges(bands), bands - radius):
        m = sum((1 << (64 - lo)) - (1 << (64 - hi)) for lo, hi in chosen)
        masks.append(m - (1 << 64) if m >= 1 << 63 else m)
    keys = F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(masks)])
    spots = prints.select("fp", F.explode(keys).alias("k")).select("fp", "k.t", "k.key")
    size = spots.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    part = spots.join(size, ["t", "key"]).withColumn("nb", F.ceil(F.col("n") / block).cast("int"))
    part = part.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("nb")).cast("int"))
    # block pairs (i <= j): every fingerprint stands in its row and its column of the grid
    grid = F.transform(F.sequence(F.lit(0), F.col("nb") - 1),
                       lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j")))
    part = part.select("t", "key", "fp", "own", F.explode(grid).alias("g"))
    part = part.select("t", "key", "fp", "g.i", "g.j", (F.col("own") == F.col("g.i")).alias("as_i"), (F.col("own") == F.col("g.j")).alias("as_j"))
    return part.groupBy("t", "key", "i", "j").applyInPandas(_compare(radius), "a long, b long")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, bands: int = 4) -> DataFrame:
    """One row per document: (id, fingerprint as 16 hex digits, component_id).

    ``component_id`` is the smallest id that links of at most ``radius``
    differing bits reach, through any chain.

    Edge cases: null, empty and wordless texts have fingerprint zero and link
    like any other; fewer words than a shingle count as one shingle; long
    texts are read whole.  Repeated rows stay rows of their own.  Null ids
    never name a component unless it has no other.  Other columns are not
    read; an empty table gives an empty result.
    """
    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    prints = cut(with_fingerprint(ids, "text", shingle).select("doc_id", "fp"))
    named = component_names(prints, radius, bands).drop("root")
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def component_names(prints: DataFrame, radius: int, bands: int) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint of ``prints(doc_id, fp)``; root = the component's own name."""
    least = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    comp = components(fingerprint_links(least.select("fp"), radius, bands))
    least = least.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return least.join(least.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, bands: int = 4) -> DataFrame:
    """The rows of ``docs`` (all columns) with one document left of each near-duplicate group: the smallest id.

    A row repeated whole counts as copies of one document; where rows share
    the smallest id, the one with the smallest row hash stays.
    """
    k1, k2 = row_keys(docs)
    one = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), k1.alias("k1"), k2.alias("k2"))
    prints = cut(with_fingerprint(one, "text", shingle).select("doc_id", "k1", "k2", "fp"))
    named = prints.join(component_names(prints, radius, bands), "fp")
    best = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")).alias("m")).select("m.k1", "m.k2")
    names = [fresh(docs, "row_k1"), fresh(docs, "row_k2")]
    keyed = docs.withColumns({names[0]: k1, names[1]: k2})
    kept = keyed.join(best.toDF(*names), names, "left_semi").dropDuplicates(names)
    return kept.drop(*names)
