"""Removal of repeated byte strings by a distributed, common-prefix-aware merge sort of suffixes.

Every ``length``-byte window of a text is represented by one suffix: the one
that starts at the window's anchor, the least of its hashed ``GRAM``-byte
grams (equal windows have equal anchors, so none can hide).  Suffixes whose
gram occurs once in the corpus cannot lie in a repeated window and are
dropped; the rest is sorted:

1. every task sorts its suffixes into runs, folds equal ones, and front-codes
   them (shared prefix length and the remaining bytes);
2. the runs are exchanged by gram and merged by loser trees that carry the
   common prefix with the last output, so known prefixes are never compared
   again; the merge yields the neighbours' common prefix lengths;
3. two windows that start d bytes before their anchors are equal exactly when
   the suffixes share length - d bytes and the d bytes to their left agree;
   both follow from the common prefix lengths, for all d at once.

Scale: equal suffixes of a task are settled there and only one witness goes
on, so a group of copies sends one suffix a task, not one a copy.  A gram
with more than ``HOT`` occurrences (a passage in very many documents) is
split: its windows are sorted as suffixes of their own and dealt by their
whole content.  Texts are held compressed and are shuffled twice; documents
are cut nowhere and nothing is dropped by size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faro.llm.common import stage

GRAM = 64                 # bytes of an anchor gram, a power of two
HOT = 50_000              # occurrences from which a gram's windows are dealt singly
RUN = 60_000              # suffixes of a run
GROUP = 150_000           # suffixes that one merge takes, on average
CHUNK = 1 << 20           # windows of a text handled at once
_RNG = np.random.default_rng(20260)
_BYTE = _RNG.integers(1, 2 ** 63, size=256, dtype=np.uint64) | np.uint64(1)
_MUL = _RNG.integers(1, 2 ** 63, size=16, dtype=np.uint64) | np.uint64(1)


def gram_hashes(raw: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes (a power of two) that start at each place."""
    h = _BYTE[raw]
    step, level = 1, 0
    while step < width:
        h = h[:-step] * _MUL[level] + h[step:]
        h ^= h >> np.uint64(31)
        step, level = 2 * step, level + 1
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    m, have = x, 1
    while 2 * have <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    rest = width - have
    return np.minimum(m[:-rest], m[rest:]) if rest else m


def anchors(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, anchor, first window, last window) of a text's anchors; windows start at the given places."""
    out = []
    for c in range(0, max(len(raw) - length + 1, 0), CHUNK):
        part = raw[c:c + CHUNK + length - 1]
        g = gram_hashes(part, GRAM)
        bits = np.uint64((1 << 21) - 1)
        low = _sliding_min((g & ~bits) | np.arange(len(g), dtype=np.uint64), length - GRAM + 1)
        at = (low & bits).astype(np.int64)
        lo = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
        hi = np.concatenate((lo[1:] - 1, [len(at) - 1]))
        a = at[lo]
        out.append((g[a].view(np.int64), a + c, lo + c, hi + c))
    if not out:
        z = np.empty(0, dtype=np.int64)
        return z, z, z, z
    return tuple(np.concatenate(z) for z in zip(*out))


def _lcp_rows(m: np.ndarray) -> np.ndarray:
    """Common prefix length of each row of a byte matrix with the row before it (0 for the first)."""
    out = np.zeros(len(m), dtype=np.int64)
    for lo in range(1, len(m), 8192):
        diff = m[lo:lo + 8192] != m[lo - 1:lo - 1 + len(m[lo:lo + 8192])]
        first = diff.argmax(axis=1)
        out[lo:lo + len(diff)] = np.where(diff.any(axis=1), first, m.shape[1])
    return out


def _matrix(strings: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join([s.ljust(width, b"\0") for s in strings]), dtype=np.uint8).reshape(len(strings), width)


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of a and b, known to be at least ``at``."""
    n = min(len(a), len(b))
    if a[at:n] == b[at:n]:
        return n
    while True:  # halve: the first difference lies in the first half if that differs
        mid = (at + n + 1) // 2
        if a[at:mid] == b[at:mid]:
            at = mid
        elif mid - at == 1:
            return at
        else:
            n = mid


def front_code(strings: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """A sorted run as shared prefix lengths and the bytes that follow them."""
    lcp = np.zeros(len(strings), dtype=np.uint16)
    tails, last = [], b""
    for k, s in enumerate(strings):
        n = _common(last, s, 0) if k else 0
        lcp[k] = n
        tails.append(s[n:])
        last = s
    return lcp, tails


def merge(runs: list[tuple[np.ndarray, list[bytes]]]) -> tuple[list[tuple[int, int]], list[bytes], np.ndarray]:
    """Loser-tree merge of front-coded runs: (run, place) and string in sorted order, and neighbours' common prefixes.

    Each head knows its common prefix with the last output.  Of two heads the
    one that shares more is smaller; only on a tie are bytes compared, and
    only behind the shared prefix.  The loser then remembers its prefix with
    the winner, which is what the next output needs.
    """
    k = max(len(runs), 1)
    at = [0] * k
    head: list[bytes | None] = [r[1][0] if len(r[1]) else None for r in runs] or [None]
    share = [0] * k
    loser = [-1] * k   # inner nodes 1..k-1; index 0 is the winner

    def play(x: int, y: int) -> tuple[int, int]:
        """(winner, loser) of two runs' heads; updates the loser's known prefix to that with the winner."""
        a, b = head[x], head[y]
        if a is None:
            return y, x
        if b is None:
            return x, y
        if share[x] > share[y]:
            return x, y
        if share[y] > share[x]:
            return y, x
        n = _common(a, b, share[x])
        if n == len(a) or (n < len(b) and a[n] < b[n]):
            share[y] = n
            return x, y
        share[x] = n
        return y, x

    # build: leaves k..2k-1
    win = [0] * (2 * k)
    for i in range(k):
        win[k + i] = i
    for node in range(k - 1, 0, -1):
        win[node], loser[node] = play(win[2 * node], win[2 * node + 1])
    top = win[1] if k > 1 else 0
    order, strings, lcps = [], [], []
    while head[top] is not None:
        s = head[top]
        order.append((top, at[top]))
        strings.append(s)
        lcps.append(share[top])
        at[top] += 1
        lcp, tails = runs[top]
        if at[top] < len(tails):
            n = int(lcp[at[top]])
            head[top], share[top] = s[:n] + tails[at[top]], n
        else:
            head[top], share[top] = None, -1
        node = (k + top) // 2
        while node:
            top, loser[node] = play(top, loser[node])
            node //= 2
    if lcps:
        lcps[0] = 0
    return order, strings, np.array(lcps, dtype=np.int64)


def _pack(ids: np.ndarray, lcp: np.ndarray, tails: list[bytes], lefts: list[bytes]) -> bytes:
    import zstandard

    sizes = np.array([[len(t) for t in tails], [len(s) for s in lefts]], dtype="<u2")
    head = np.array([len(tails)], dtype="<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + ids.astype("<i8").tobytes() + lcp.astype("<u2").tobytes() + sizes.tobytes() + b"".join(tails) + b"".join(lefts))


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes], list[bytes]]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    ids = np.frombuffer(raw, "<i8", 4 * n, 8).reshape(n, 4)
    lcp = np.frombuffer(raw, "<u2", n, 8 + 32 * n)
    sizes = np.frombuffer(raw, "<u2", 2 * n, 8 + 34 * n)
    ends = (8 + 38 * n + np.cumsum(sizes)).tolist()
    parts = [raw[s:e] for s, e in zip([8 + 38 * n, *ends[:-1]], ends)] if n else []
    return ids, lcp, parts[:n], parts[n:]


RUN_SCHEMA = "part int, blob binary, rid long, lo array<long>, hi array<long>"


def _runs(length: int, parts: int):
    """Map side: sorted, folded, front-coded runs, and the windows that a run settles by itself."""

    def flush(entries: list[tuple]):
        # (deal, right, left, rid, anchor, shortest d): equal suffixes with equal left sides fold to one
        entries.sort(key=lambda e: (e[0] % parts, e[1], e[2]))
        done: dict[int, list] = {}
        run: list[tuple] = []
        part, k = -1, 0
        while k < len(entries):
            deal, right, left, rid, a, dmin = entries[k]
            j = k + 1
            while j < len(entries) and entries[j][1] == right and entries[j][2] == left and entries[j][5] == dmin and entries[j][0] == deal:
                j += 1
            for e in entries[k:j] if j > k + 1 else ():
                lo, hi = done.setdefault(e[3], [[], []])
                lo.append(e[4] - len(left))
                hi.append(e[4] - dmin + length)
            if deal % parts != part:
                if run:
                    yield part, run
                part, run = deal % parts, []
            run.append((right, left, rid if j == k + 1 else -1, a, dmin))
            k = j
        if run:
            yield part, run
        for rid, (lo, hi) in done.items():
            yield rid % parts, (rid, lo, hi)

    def rows(entries):
        out = []
        for part, got in flush(entries):
            if isinstance(got, tuple):
                out.append((part, None, *got))
            else:
                lcp, tails = front_code([e[0] for e in got])
                ids = np.array([(e[2], e[3], e[4], 0) for e in got], dtype=np.int64)
                out.append((part, _pack(ids, lcp, tails, [e[1] for e in got]), -1, None, None))
        return pd.DataFrame(out, columns=["part", "blob", "rid", "lo", "hi"])

    def run(batches):
        import zstandard

        unz = zstandard.ZstdDecompressor()
        entries: list[tuple] = []
        for b in batches:
            for rid, z, pos, hot in zip(b["rid"], b["z"], b["pos"], b["hot"]):
                text = unz.decompress(z)
                g, a, lo, hi = anchors(np.frombuffer(text, dtype=np.uint8), length)
                is_hot = dict(zip(pos, hot))
                for k in np.flatnonzero(np.isin(a, np.asarray(pos))).tolist():
                    at, first, last = int(a[k]), int(lo[k]), int(hi[k])
                    if is_hot[at]:
                        for p in range(first, last + 1):
                            w = text[p:p + length]
                            entries.append((int.from_bytes(hashlib.blake2b(w, digest_size=7).digest(), "big"), w, b"", rid, p, 0))
                    else:
                        entries.append((int(g[k]) & (2 ** 63 - 1), text[at:last + length], text[first:at], rid, at, at - last))
                    if len(entries) >= RUN:
                        yield rows(entries)
                        entries = []
        if entries:
            yield rows(entries)

    return run


def repeated_windows(strings: list[bytes], lcp: np.ndarray, lefts: list[bytes], dmin: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(entry, d) of every window that another entry shares.

    ``strings`` are sorted suffixes with neighbours' common prefixes ``lcp``,
    ``lefts`` the bytes before them; entry i has the windows that start d
    bytes before it, dmin[i] <= d <= len(lefts[i]).
    """
    dmax = np.array([len(s) for s in lefts], dtype=np.int64)
    wide = max(int(dmax.max(initial=0)), 1)
    back = _matrix([s[::-1] for s in lefts], wide)
    order = np.argsort(np.ascontiguousarray(back).view(f"S{wide}").ravel(), kind="stable")
    back_lcp = _lcp_rows(back[order])
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    entry, depth = [], []
    for d in range(int(dmin.min(initial=0)), int(dmax.max(initial=0)) + 1):
        at = np.flatnonzero((dmin <= d) & (d <= dmax))
        if len(at) < 2:
            continue
        right = np.cumsum(lcp < length - d)[at]
        left = np.cumsum(back_lcp < d)[rank[at]]
        code = right * (len(lcp) + 1) + left
        s = np.argsort(code, kind="stable")
        c = code[s]
        same = c[1:] == c[:-1]
        twice = s[np.concatenate((same, [False])) | np.concatenate(([False], same))]
        entry.append(at[twice])
        depth.append(np.full(len(twice), d))
    if not entry:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(entry), np.concatenate(depth)


def _merge_part(length: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        settled = pdf[pdf["blob"].isna()][["rid", "lo", "hi"]]
        blobs = [_unpack(z) for z in pdf["blob"] if z is not None]
        if not blobs:
            return settled
        order, strings, lcp = merge([(b[1], b[2]) for b in blobs])
        ids = np.stack([blobs[r][0][k] for r, k in order])
        entry, d = repeated_windows(strings, lcp, [blobs[r][3][k] for r, k in order], ids[:, 2], length)
        named = ids[entry, 0] >= 0
        entry, d = entry[named], d[named]
        if not len(entry):
            return settled
        rid, start = ids[entry, 0], ids[entry, 1] - d
        s = np.lexsort((start, rid))
        rid, start = rid[s], start[s]
        first = np.concatenate(([True], (rid[1:] != rid[:-1]) | (start[1:] > start[:-1] + 1)))
        lo, who = start[first], rid[first]
        hi = start[np.concatenate((np.flatnonzero(first)[1:] - 1, [len(start) - 1]))] + length
        got = pd.DataFrame({"rid": who, "lo": [[x] for x in lo.tolist()], "hi": [[x] for x in hi.tolist()]})
        return pd.concat([settled, got], ignore_index=True)

    return run


def _compress(batches):
    import zstandard

    zip_ = zstandard.ZstdCompressor(level=3)
    for b in batches:
        yield pd.DataFrame({"doc_id": b["doc_id"], "z": [zip_.compress((t or "").encode("utf-8")) for t in b["text"]]})


def _anchor_rows(length: int):
    def run(batches):
        import zstandard

        unz = zstandard.ZstdDecompressor()
        for b in batches:
            g, p, r = [], [], []
            for rid, z in zip(b["rid"], b["z"]):
                got = anchors(np.frombuffer(unz.decompress(z), dtype=np.uint8), length)
                g.append(got[0])
                p.append(got[1])
                r.append(np.full(len(got[0]), rid))
            if g:
                yield pd.DataFrame({"g": np.concatenate(g), "rid": np.concatenate(r), "pos": np.concatenate(p)})

    return run


def _finish(keep_text: bool):
    def run(batches):
        import zstandard

        unz = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for doc_id, z, los, his in zip(b["doc_id"], b["z"], b["lo"], b["hi"]):
                text = unz.decompress(z)
                kept, end, removed, spans = [], 0, 0, 0
                if los is not None and len(los):
                    lo, hi = np.concatenate([np.asarray(x) for x in los]), np.concatenate([np.asarray(x) for x in his])
                    s = np.argsort(lo, kind="stable")
                    stop = -1
                    for x, y in zip(lo[s].tolist(), hi[s].tolist()):
                        if x > stop:
                            kept.append(text[end:x])
                            spans += 1
                            removed += y - x
                            stop = end = y
                        elif y > stop:
                            removed += y - stop
                            stop = end = y
                kept.append(text[end:])
                left = b"".join(kept)
                out.append((doc_id, len(text), removed, spans, hashlib.sha256(left).hexdigest(), left if keep_text else None))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, keep_text: bool = True) -> DataFrame:
    """One row per document: (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept).

    Removes every byte covered by a ``length``-byte string that also starts
    anywhere else in the corpus, in the same document too; strings are judged
    on the whole input.  ``kept`` holds the remaining bytes (null unless
    ``keep_text``).

    Edge cases: null texts count as empty; texts shorter than ``length`` lose
    nothing; a row repeated whole is another document, so both lose whatever
    a window covers; null ids stay null.  Other columns are not read; an
    empty table gives an empty result.
    """
    if not 2 * GRAM <= length <= 16384:
        raise ValueError(f"length is from {2 * GRAM} to 16384 bytes")
    src = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    held = stage(src.mapInPandas(_compress, "doc_id string, z binary").withColumn("rid", F.monotonically_increasing_id()), "texts")
    found = held.select("rid", "z").mapInPandas(_anchor_rows(length), "g long, rid long, pos long")
    often = found.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("g", (F.col("n") > HOT).alias("hot"))
    # candidates of a document, bounded by its length
    cand = stage(found.join(often, "g").groupBy("rid").agg(F.collect_list("pos").alias("pos"), F.collect_list("hot").alias("hot")), "candidates")
    n = cand.agg(F.coalesce(F.sum(F.size("pos")), F.lit(0))).first()[0]
    parts = max(16, -(-n // GROUP))
    runs = held.select("rid", "z").join(cand, "rid").mapInPandas(_runs(length, parts), RUN_SCHEMA)
    cover = runs.groupBy("part").applyInPandas(_merge_part(length), "rid long, lo array<long>, hi array<long>")
    cover = cover.groupBy("rid").agg(F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi"))
    out = held.join(cover, "rid", "left").select("doc_id", "z", "lo", "hi").mapInPandas(
        _finish(keep_text), "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
