"""Periodic runs of words, found as maximal pairs of a text's suffixes.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical), at least max(``shortest``, ``exponent`` * q) words long, that
no neighbouring word extends.  Two suffixes at places i < j = i + q that share
exactly l words, with different words to their left, are a maximal pair; the
stretch from i of l + q words has period q and cannot be extended on either
side.  So every maximal pair with l + q >= max(shortest, exponent * q) is a run
as it stands, and every run is such a pair: nothing is extended word by word.

The pairs of a text come from its LCP-interval tree, walked bottom up: an
interval is a set of places whose suffixes share l words, kept as lists of
places by the word to their left.  When a child joins an interval, places of
different children and different left words are maximal pairs of length l; the
smaller side looks up the larger.  Only pairs at most l / (exponent - 1) apart
matter.  Places that near to each other lie in one arithmetic progression of
which all but the first have the same left word (``exponent`` >= 3), so one look
to the left and one to the right finds every pair of different left words.
Intervals that share fewer words than any run needs are not built: places whose
next words occur nowhere else in the text are never sorted.

Scale: texts are independent rows; a task holds one text and its tree at a
time, so its memory is bounded by the longest text (about 250 bytes a word,
ten times that where all of it is periodic).  Nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faro.llm.common import fresh, word_codes

Run = tuple[int, int, int]      # start, length, period
FOUND = "start array<bigint>, length array<bigint>, period array<bigint>, collapsed string"


def repeated_places(code: np.ndarray, words: int) -> np.ndarray:
    """True at places whose next ``words`` words may occur at another place too (hash of them not unique)."""
    n = len(code)
    out = np.zeros(n, dtype=bool)
    if n <= words:
        return out
    mixed = (code.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h = np.zeros(n - words + 1, dtype=np.uint64)
    for k in range(words):
        h = (h ^ mixed[k:n - words + 1 + k]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def suffix_ranks(code: np.ndarray) -> np.ndarray:
    """Rank of every suffix by prefix doubling; only suffixes still tied are sorted again."""
    n = len(code)
    count = np.bincount(code)
    rank = (np.cumsum(count) - count)[code]
    tied = np.flatnonzero(count[code] > 1)
    h = 1
    while len(tied):
        ahead = tied + h
        key = rank[tied] * np.int64(n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        tied, key = tied[order], key[order]
        old = rank[tied]
        first = np.arange(len(tied))
        new_group = np.r_[True, key[1:] != key[:-1]]
        old_group = np.r_[True, old[1:] != old[:-1]]
        at_new = np.maximum.accumulate(np.where(new_group, first, 0))
        at_old = np.maximum.accumulate(np.where(old_group, first, 0))
        rank[tied] = old + at_new - at_old
        alone = new_group & np.r_[new_group[1:], True]
        tied = tied[~alone]
        h *= 2
    return rank


def common_prefixes(code: np.ndarray, rank: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order, and for every wanted suffix the words shared with the one before it (0 for the others)."""
    n = len(code)
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    lcp = np.zeros(n, dtype=np.int64)
    word, ranks, before = code.tolist(), rank.tolist(), order.tolist()
    h, last = 0, -2
    for i in np.flatnonzero(wanted).tolist():
        h = max(h - 1, 0) if i == last + 1 else 0
        last = i
        r = ranks[i]
        if not r:
            h = 0
            continue
        j = before[r - 1]
        top = n - max(i, j)
        while h < top and word[i + h] == word[j + h]:
            h += 1
        lcp[r] = h
    return order, lcp


class Places:
    """The places of an LCP interval: sorted, and as sorted lists by the word to their left."""

    __slots__ = ("at", "by_left")

    def __init__(self, place: int, left: int):
        self.at = [place]
        self.by_left = {left: [place]}

    def take(self, other: Places) -> None:
        self.at = joined(self.at, other.at)
        for left, places in other.by_left.items():
            mine = self.by_left.get(left)
            self.by_left[left] = places if mine is None else joined(mine, places)


def joined(a: list[int], b: list[int]) -> list[int]:
    """Sorted union of two sorted lists, ``b`` the shorter."""
    if len(b) * 8 < len(a):
        for x in b:
            insort(a, x)
        return a
    return sorted(a + b)


def find_runs(code: np.ndarray, shortest: int = 6, exponent: int = 4) -> list[Run]:
    """All runs of a text given as word numbers, by start, then period."""
    if exponent < 3:
        raise ValueError("runs are defined here for an exponent of 3 or more")
    least = max(min(max(shortest, exponent * q) - q for q in range(1, shortest + 1)), 1)     # shared words of the shortest run
    wanted = repeated_places(code, least)
    if not wanted.any():
        return []
    order, lcp = common_prefixes(code, suffix_ranks(code), wanted)
    deep = np.flatnonzero(lcp >= least)
    found: dict[tuple[int, int], int] = {}      # (start, length) -> smallest period
    left = np.r_[-1, code[:-1]].tolist()

    def pairs(small: Places, large: Places, shared: int) -> None:
        reach = shared // (exponent - 1)
        if not reach:
            return
        places = large.at
        for word, mine in small.by_left.items():
            if len(large.by_left) == 1 and word in large.by_left:
                continue                        # every pair would extend to the left
            for i in mine:
                lo, hi = bisect_left(places, i - reach), bisect_right(places, i + reach)
                if lo == hi:
                    continue
                mid = bisect_left(places, i, lo, hi)
                if lo < mid and left[places[lo]] != word:
                    keep(places[lo], i, shared)
                if mid < hi and left[places[mid]] != word:
                    for j in places[mid:hi]:
                        keep(i, j, shared)

    def keep(i: int, j: int, shared: int) -> None:
        q = j - i
        if shared + q >= max(shortest, exponent * q):
            at = (i, shared + q)
            if found.get(at, q) >= q:
                found[at] = q

    def join(a: Places, b: Places, shared: int) -> Places:
        small, large = (a, b) if len(a.at) < len(b.at) else (b, a)
        pairs(small, large, shared)
        large.take(small)
        return large

    if len(deep):
        sa, share = order.tolist(), lcp.tolist()
        for block in np.split(deep, np.flatnonzero(np.diff(deep) > 1) + 1):
            p = sa[block[0] - 1]
            child = Places(p, left[p])
            open_: list[list] = []              # open intervals: [shared words, places]
            for k in block.tolist():
                shared = share[k]
                while open_ and open_[-1][0] > shared:
                    depth, node = open_.pop()
                    child = join(node, child, depth)
                if open_ and open_[-1][0] == shared:
                    open_[-1][1] = join(open_[-1][1], child, shared)
                else:
                    open_.append([shared, child])
                child = Places(sa[k], left[sa[k]])
            while open_:
                depth, node = open_.pop()
                child = join(node, child, depth)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """True for words that no run contains after its first period."""
    step = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return np.cumsum(step[:n]) == 0


def collapse(docs: DataFrame, text_col: str = "text", shortest: int = 6, exponent: int = 4) -> DataFrame:
    """``docs`` with ``runs`` (array of start, length, period; by start, then period) and ``collapsed`` text.

    ``collapsed`` holds the words that no run contains after its first period,
    joined by one space.  Words are ``[^\\x20\\x09-\\x0D]+``.  A null or empty
    text, or one of white space, has no runs and collapses to the empty text;
    repeated rows are treated each for itself; an empty table stays empty.
    Columns already named ``runs`` or ``collapsed`` are kept, and the new ones
    get a trailing underscore.
    """

    def work(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            words, code = word_codes(text)
            runs = find_runs(code, shortest, exponent)
            if runs:
                words = [w for w, k in zip(words, kept_words(len(words), runs)) if k]
            out.append(([r[0] for r in runs], [r[1] for r in runs], [r[2] for r in runs], b" ".join(words).decode()))
        return pd.DataFrame(out, columns=["start", "length", "period", "collapsed"])

    found = fresh(docs, "found")
    runs, collapsed = fresh(docs, "runs"), fresh(docs, "collapsed")
    seen = docs.withColumn(found, F.pandas_udf(work, FOUND)(F.col(f"`{text_col}`")))
    zipped = F.arrays_zip(F.col(f"{found}.start"), F.col(f"{found}.length"), F.col(f"{found}.period"))
    return seen.withColumns({runs: zipped, collapsed: F.col(f"{found}.collapsed")}).drop(found)
