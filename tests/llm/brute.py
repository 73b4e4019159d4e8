"""Plain brute-force versions of the operators' results, from the definitions."""

from __future__ import annotations

import hashlib
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import xxhash

sys.set_int_max_str_digits(0)
UP = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UP, UP.lower())


def reach(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def embeddings(rows, threshold=0.9):
    """rows (vec_id, vector) -> sorted (vec_id, n_links, component_id, kept)."""
    rows = sorted(rows, key=lambda r: r[0])
    ok = [v is not None and len(v) > 0 and None not in list(v) and bool(np.isfinite(np.array(v, dtype=float)).all()) and any(v) for _, v in rows]
    links = []
    unit = [np.array(v, dtype=float) / np.sqrt((np.array(v, dtype=float) ** 2).sum()) if o else None for (_, v), o in zip(rows, ok)]
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= threshold:
                links.append((j, i))
    deg = Counter(x for p in links for x in p)
    root = reach(len(rows), links)
    least = {}
    for k, r in enumerate(root):
        least[r] = min(least.get(r, rows[k][0]), rows[k][0])
    return sorted((rows[k][0], deg[k], least[root[k]], rows[k][0] == least[root[k]]) for k in range(len(rows)))


def fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def simhash(rows, radius=2):
    """rows (doc_id, text) -> sorted (doc_id, fingerprint hex, component_id)."""
    prints = [fingerprint(t) for _, t in rows]
    arr = np.array(prints, dtype=np.uint64)
    pairs = []
    for i in range(len(rows)):
        d = np.bitwise_count(arr[:i] ^ arr[i])
        pairs += [(int(j), i) for j in np.flatnonzero(d <= radius)]
    root = reach(len(rows), pairs)
    least = {}
    for k, r in enumerate(root):
        least[r] = min(least.get(r, rows[k][0]), rows[k][0])
    return sorted((rows[k][0], f"{prints[k]:016x}", least[root[k]]) for k in range(len(rows)))


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(docs, items, n=10):
    wins = defaultdict(set)
    for item, text in items:
        ws = words(text)
        size = min(len(ws), n)
        for i in range(len(ws) - size + 1 if ws else 0):
            wins[tuple(ws[i:i + size])].add(item)
    lens = {len(w) for w in wins}
    out = []
    for doc_id, text in docs:
        ws, hit, items_ = words(text), set(), set()
        for size in lens:
            for i in range(len(ws) - size + 1):
                got = wins.get(tuple(ws[i:i + size]))
                if got:
                    hit |= set(range(i, i + size))
                    items_ |= got
        ids = ",".join(sorted(str(x) for x in items_ if x is not None))
        out.append((doc_id, len(ws), len(hit), len([x for x in items_ if x is not None]), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


def pii_base(text):
    """The contract's base matches with the plain patterns."""
    text = text or ""
    pats = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, pat in pats.items():
        for m in re.finditer(pat, text):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                s = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d)))
                if not 16 <= len(d) <= 19 or s % 10:
                    continue
            if kind == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def repeated_bytes(rows, length=200):
    """rows (doc_id, text) -> (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    raws = [(t or "").encode() for _, t in rows]
    count = Counter()
    for r in raws:
        count.update(hash(r[i:i + length]) for i in range(len(r) - length + 1))
    out = []
    for (doc_id, _), r in zip(rows, raws):
        gone = np.zeros(len(r) + 1, dtype=bool)
        for i in range(len(r) - length + 1):
            if count[hash(r[i:i + length])] > 1:
                gone[i:i + length] = True
        gone[len(r)] = False
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = int((gone[1:] < gone[:-1]).sum())
        out.append((doc_id, len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rule_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text, from the definitions."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


def period_runs(words, shortest=6, exponent=4):
    """(start, length, period) of every run, by trying every period at every place."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(shortest, exponent * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1 if j > i else i + 1
    return sorted(((s, m, q) for (s, m), q in found.items()), key=lambda r: (r[0], r[2]))


def planted_words(doc_id, text):
    """The words of a document after the contract's periodic rewriting."""
    import zlib

    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
