"""Bulk-synchronous best-fit packing of tokenised documents into fixed-length sequences.

Documents are tokenised in one scan; longer ones are cut.  Pieces and gaps
(the free ends of opened sequences) are kept range-sorted by size, and rounds
of successor matching fill the gaps: sweeping the sizes upwards, every gap
takes the largest waiting piece that fits, pieces of one size being handed
out by rank so that no two gaps can claim the same one; the gaps shrink and
the next round follows.  When no piece fits any gap, the largest waiting
pieces open as many sequences as the rest needs at least.

Scale: sizes are whole numbers up to the capacity, so a sorted run of equal
pieces (or of equal gaps) is one row (size, first rank, count).  The rounds
move these runs, at most the capacity many pieces' runs whatever the data;
rows are touched twice, to be ranked within their size (split over buckets,
so that a size with a third of all rows is no hot task) and to look up their
rank's place.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faro.llm.common import stage

# fixed values: the pre-tokenisation pattern of byte-level BPE vocabularies, written for texts of SETTLED characters only
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
# characters that all Unicode versions and pattern libraries class alike; a text with any other goes to the tokenizer whole
SETTLED = "\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u2000-\u206f\u20a0-\u20bf"
ODD = re.compile(f"[^{SETTLED}]")
CACHE = 600_000
BUCKET = 50_000   # rows of one size that are ranked together


def _letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def word_encoder(path: str):
    """A function from one word to its ids, faster than the tokenizer's but equal to it; None where that isn't certain.

    In a vocabulary whose merged tokens are numbered in the order of their
    merges, merging by lowest id is merging by rank.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
             and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer"))
    vocab, merges = model.get("vocab", {}), model.get("merges", [])
    joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
    if not plain or [vocab.get(t) for t in joined] != list(range(256, 256 + len(joined))):
        return None
    import tiktoken

    byte = _letters()
    added = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in added}
    return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Encoder:
    """Token ids of whole texts as little-endian 32-bit bytes, remembering the ids of words seen before."""

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        if not os.path.exists(tokenizer):
            import public_tokenizers

            tokenizer = public_tokenizers.path(tokenizer)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_file(tokenizer)
        self.word = word_encoder(tokenizer)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.cache: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _one(self, word: str) -> bytes:
        ids = array("I", self.word(word)).tobytes()
        if len(word) <= 64:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = ids
        return ids

    def _join(self, words) -> bytes:
        get = self.cache.get
        out = [get(w) for w in words]
        if None in out:
            out = [b if b is not None else get(w) or self._one(w) for w, b in zip(words, out)]
        return b"".join(out)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.word is None or ODD.search(text) or any(t in text for t in self.special):
            return self._ids(text)
        if len(text) < 1 << 20:
            return self._join(PIECES.findall(text))
        it, out = (m.group() for m in PIECES.finditer(text)), []
        while words := list(islice(it, 100_000)):
            out.append(self._join(words))
        return b"".join(out)


def _cut(tokenizer: str, capacity: int, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        encode = Encoder(tokenizer)
        for b in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(b["doc_id"], b["text"]):
                ids = encode(text) + end
                n = len(ids) // 4
                lo, size = 0, n if n <= capacity else n % capacity or capacity
                piece = 0
                while lo < n:
                    rows.append((doc_id, piece, lo, size, zlib.crc32(ids[4 * lo:4 * (lo + size)])))
                    lo, size, piece = lo + size, capacity, piece + 1
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k.json",
           capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document, cut into pieces of at most ``capacity`` tokens."""
    # ids travel as text: pandas would turn whole numbers beside nulls into floats
    src = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    cut = src.mapInPandas(_cut(tokenizer, capacity, end_id), "doc_id string, piece int, start long, length long, ids_crc32 long")
    return cut.withColumn("doc_id", F.col("doc_id").cast("long"))


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Places for ``counts`` pieces by size: runs (size, first rank, how many, first sequence, offset)."""
    left = {s: n for s, n in counts.items() if n}
    taken = dict.fromkeys(left, 0)
    out, gaps, opened = [], [], 0   # gaps: runs (free, first sequence, how many)

    def give(size: int, n: int, seq: int, offset: int) -> None:
        out.append((size, taken[size], n, seq, offset))
        taken[size] += n
        left[size] -= n
        if not left[size]:
            del left[size]

    def open_new(size: int, n: int) -> None:
        nonlocal opened
        give(size, n, opened, 0)
        if size < capacity:
            gaps.append((capacity - size, opened, n))
        opened += n

    for s in sorted(left, reverse=True):
        if 2 * s > capacity:
            open_new(s, left[s])
    while left:
        # one bulk round: sweep upwards, each gap's successor match is the largest waiting piece that fits
        waiting: list[int] = []
        sizes, k, after, matched = sorted(left), 0, [], False
        spare = dict(left)
        for free, seq, n in sorted(gaps):
            while k < len(sizes) and sizes[k] <= free:
                waiting.append(sizes[k])
                k += 1
            while n and waiting:
                s = waiting[-1]
                m = min(n, spare[s])
                give(s, m, seq, capacity - free)
                spare[s] -= m
                if not spare[s]:
                    waiting.pop()
                if free > s:
                    after.append((free - s, seq, m))
                seq, n, matched = seq + m, n - m, True
            if n:
                after.append((free, seq, n))
        gaps = after
        if not matched:
            need = -(-sum(s * n for s, n in left.items()) // capacity)
            for s in sorted(left, reverse=True):
                if need:
                    m = min(need, left[s])
                    open_new(s, m)
                    need -= m
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k.json",
         capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    Edge cases: null and empty texts are one piece that holds the end id
    alone; texts of exactly the capacity are not cut; repeated rows and null
    ids are packed like any other row.  Pieces of equal length are
    interchangeable, so ties are settled by the row's place in the written
    table of pieces.  Other columns are not read; an empty table packs into
    nothing.
    """
    spark = docs.sparkSession
    cut = stage(pieces(docs, id_col, text_col, tokenizer, capacity, end_id).withColumn("rid", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    runs = sorted(best_fit(counts, capacity))
    span = max(counts.values(), default=0) + 1
    first = np.array([s * span + r for s, r, *_ in runs], dtype=np.int64)
    where = np.array([(r, q, o) for _, r, _, q, o in runs], dtype=np.int64).reshape(-1, 3)
    shared = spark.sparkContext.broadcast((first, where, span))  # bounded by the capacity, not by the rows
    split = spark.createDataFrame([(s, -(-n // BUCKET)) for s, n in counts.items()], "length long, nb int")
    ranked = cut.join(F.broadcast(split), "length").withColumn("bucket", F.pmod(F.xxhash64("rid"), F.col("nb")).cast("int"))
    before = ranked.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = before.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("base"))
    ranked = ranked.withColumn("r", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("rid")) - 1)
    ranked = ranked.join(before, ["length", "bucket"]).withColumn("r", F.col("r") + F.col("base"))

    def place(batches):
        first, where, span = shared.value
        for b in batches:
            at = np.searchsorted(first, b["length"].to_numpy() * span + b["r"].to_numpy(), side="right") - 1
            rank, seq, offset = where[at].T
            yield b.assign(sequence_id=seq + b["r"].to_numpy() - rank, offset=offset).drop(columns="r")

    cols = "doc_id string, piece int, start long, length long, ids_crc32 long"
    placed = ranked.select(F.col("doc_id").cast("string").alias("doc_id"), "piece", "start", "length", "ids_crc32", "r") \
                   .mapInPandas(place, f"{cols}, sequence_id long, offset long")
    return placed.withColumn("doc_id", F.col("doc_id").cast("long"))
