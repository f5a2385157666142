"""Periodic runs: stretches of words that repeat with a period, found on an enhanced suffix array.

A run that counts holds each of its words at least four times, so words that are rarer in their
document end stretches; only stretches of six or more such words are looked at (an exact
reduction: what is left out can hold no run).  All stretches of a batch of documents then share
one enhanced suffix array, in which suffixes of different stretches never meet:

1. the suffix array and its inverse by prefix doubling; each round sorts only the suffixes that are
   still tied, and its ranks are kept, so that equal pieces of any length can be told;
2. the LCP values of neighbours by descending through those ranks;
3. the branching-tandem test: an LCP interval of depth p is split at each of its borders
   (found by nearest smaller values, no tree nodes) and the suffixes i of the smaller part
   look up ISA[i + p] and ISA[i - p] in the other part.  A hit is a square of period p that the
   next word ends;
4. squares that cannot reach the least run length are dropped by comparing ranks, the others are
   rotated to the left, by powers of two, to the first word of their run; squares with
   the same borders are one run, of the least period.

Every step is a NumPy operation over the whole batch: O(n log n) for n words.

Defined cases: a null text has no words, no runs and the digest of the empty string; a null id leaves
the words as they are; a repeated row gives a row each; other columns of the input, whatever
their names, are not read; an empty table gives an empty result.  A very long text is one
unit: a task holds about 4 * log2(longest repeat) bytes for each of its frequent words.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches

#: A run has at least LEAST words and LEAST_PERIODS periods.
LEAST, LEAST_PERIODS = 6, 4
#: Words of the stretches that share one suffix array (a longer stretch has its own).
BATCH_WORDS = 1 << 19
SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


class SuffixArray:
    """Suffixes of many stretches, each followed by one border slot; ``word`` 0 is the border."""

    def __init__(self, word: np.ndarray, stretch: np.ndarray):
        n = len(word)
        key = stretch.astype(np.int64) * (int(word.max(initial=0)) + 1) + word
        self.sa = np.argsort(key, kind="stable")
        k = key[self.sa]
        self.stretch = stretch
        cut = np.concatenate(([True], k[1:] != k[:-1])) if n else np.empty(0, bool)
        first = np.maximum.accumulate(np.where(cut, np.arange(n), 0))
        rank = np.empty(n, np.int64)
        rank[self.sa] = first
        self.ranks = [rank.astype(np.int32)]  # ranks[r]: equal where 2**r words are equal
        tied = self._tied(first)
        step = 1
        while len(tied):
            at = self.sa[tied]
            k = rank[at] * (n + 1) + rank[at + step]  # tied suffixes are longer than ``step``
            order = np.argsort(k)
            k, at = k[order], at[order]
            self.sa[tied] = at
            cut = np.concatenate(([True], k[1:] != k[:-1]))
            first = np.maximum.accumulate(np.where(cut, tied, 0))
            rank = rank.copy()
            rank[at] = first
            self.ranks.append(rank.astype(np.int32))
            same = np.concatenate((~cut[1:], [False])) | ~cut
            tied = tied[same]
            step *= 2
        self.isa = rank

    @staticmethod
    def _tied(first: np.ndarray) -> np.ndarray:
        if not len(first):
            return first
        new = np.concatenate(([True], first[1:] != first[:-1]))
        return np.flatnonzero(~new | np.concatenate((~new[1:], [False])))

    def lcp(self) -> np.ndarray:
        """LCP of each suffix with the one before it in the array (0 at 0)."""
        out = np.zeros(len(self.sa), np.int64)
        same = np.flatnonzero(self.ranks[0][self.sa[1:]] == self.ranks[0][self.sa[:-1]]) + 1
        a, b = self.sa[same - 1].copy(), self.sa[same].copy()
        got = np.zeros(len(same), np.int64)
        for r in range(len(self.ranks) - 1, -1, -1):
            eq = self.ranks[r][a] == self.ranks[r][b]
            got[eq] += 1 << r
            a[eq] += 1 << r
            b[eq] += 1 << r
        out[same] = got
        return out

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether ``length`` >= 1 words from ``a`` and from ``b`` on are equal (all within their stretches)."""
        out = np.zeros(len(a), bool)
        log = np.frexp(length.astype(np.float64))[1] - 1
        for r in np.unique(log):
            if r < len(self.ranks):
                of = np.flatnonzero(log == r)
                rest = length[of] - (1 << int(r))
                k = self.ranks[r]
                out[of] = (k[a[of]] == k[b[of]]) & (k[a[of] + rest] == k[b[of] + rest])
        return out


def _nearest_smaller(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For borders with lcp > 0: the last one before with a smaller value, the next one with a smaller or equal value."""
    n = len(lcp)
    v = np.append(lcp, 0)
    v[0] = 0
    before, after = np.arange(n) - 1, np.arange(n) + 1
    todo = np.flatnonzero(v[:n] > 0)
    left = todo
    while len(left):
        left = left[v[before[left]] >= v[left]]
        before[left] = before[before[left]]
    while len(todo):
        todo = todo[v[after[todo]] > v[todo]]
        after[todo] = after[after[todo]]
    return before, after


def squares(s: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the branching tandem repeats."""
    lcp = s.lcp()
    before, after = _nearest_smaller(lcp)
    border = np.flatnonzero(lcp > 0)
    a, b = before[border], after[border]  # parts: slots a .. border-1 and border .. b-1
    small_left = border - a <= b - border
    lo = np.where(small_left, a, border)
    size = np.where(small_left, border - a, b - border)
    other_lo, other_hi = np.where(small_left, border, a), np.where(small_left, b, border)
    starts, periods = [], []
    ends = np.cumsum(size)
    at = 0
    while at < len(border):  # a bounded number of suffixes at a time
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 4 * BATCH_WORDS, "right")))
        n = size[at:to]
        own = np.repeat(np.arange(at, to), n)
        slot = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + lo[own]
        i, p = s.sa[slot], lcp[border[own]]
        for j, first in ((i + p, i), (i - p, i - p)):
            ok = (j >= 0) & (j < len(s.sa))
            jj = np.where(ok, j, 0)
            rank = s.isa[jj]
            ok &= (rank >= other_lo[own]) & (rank < other_hi[own])
            starts.append(first[ok])
            periods.append(p[ok])
        at = to
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(starts), np.concatenate(periods)


def find_runs(words: np.ndarray, stretch: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Rows (stretch, start in the stretch, length, period), sorted by these.

    ``words``: ids from 1 on, all stretches one after the other; ``stretch``: of every word, ascending;
    ``offset``: where each stretch begins in ``words``."""
    n_stretches = len(offset)
    n = len(words)
    to = np.arange(n) + stretch  # one border slot after each stretch
    x = np.zeros(n + n_stretches, np.int64)
    x[to] = words
    of = np.empty(n + n_stretches, np.int64)
    of[to] = stretch
    lens = np.diff(np.append(offset, n))
    first = offset + np.arange(n_stretches)
    of[first + lens] = np.arange(n_stretches)
    s = SuffixArray(x, of)
    i, p = squares(s)
    end = i + 2 * p
    need = np.maximum(LEAST, LEAST_PERIODS * p)
    begin = end - need
    ok = begin >= first[of[i]]
    i, p, end, need, begin = (v[ok] for v in (i, p, end, need, begin))
    ok = s.equal(begin, begin + p, need - p) if len(i) else np.empty(0, bool)
    p, end, at = p[ok], end[ok], begin[ok]
    low = first[of[at]]
    for r in range(len(s.ranks) - 1, -1, -1):  # rotate: whole powers of two to the left
        back = at - (1 << r)
        can = np.flatnonzero(back >= low)
        can = can[s.ranks[r][back[can]] == s.ranks[r][back[can] + p[can]]]
        at[can] -= 1 << r
    if not len(at):
        return np.empty((0, 4), np.int64)
    order = np.lexsort((p, end, at))
    at, end, p = at[order], end[order], p[order]
    one = np.concatenate(([True], (at[1:] != at[:-1]) | (end[1:] != end[:-1])))  # the least period of equal borders
    at, end, p = at[one], end[one], p[one]
    rows = np.stack([of[at], at - first[of[at]], end - at, p], axis=1)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def planted_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of the contract: of every tenth id, those from ``a`` on repeat with a period."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a:a + p]
    return words[:a] + (cycle * (-(-(n - a) // p)))[:n - a]


def _stretches(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ids from 1 on; starts and ends of the stretches that can hold runs."""
    ids = pd.factorize(np.array(words, dtype=object))[0]
    often = np.bincount(ids)[ids] >= LEAST_PERIODS
    edge = np.flatnonzero(np.diff(often.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    s, e = edge[0::2], edge[1::2]
    long = e - s >= LEAST
    return ids + 1, s[long], e[long]


def runs_of(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Runs of every list of words: rows (start, length, period), by start and period."""
    out = [np.empty((0, 3), np.int64)] * len(texts)
    parts: list[tuple[int, int, np.ndarray]] = []  # document, first word, ids

    def flush():
        lens = np.array([len(w) for _, _, w in parts])
        found = find_runs(np.concatenate([w for _, _, w in parts]), np.repeat(np.arange(len(parts)), lens), np.cumsum(lens) - lens)
        if len(found):
            doc = np.array([d for d, _, _ in parts])[found[:, 0]]
            rows = np.stack([found[:, 1] + np.array([f for _, f, _ in parts])[found[:, 0]], found[:, 2], found[:, 3]], axis=1)
            for d in np.unique(doc):
                mine = rows[doc == d] if len(rows) < 1000 else rows[np.searchsorted(doc, d):np.searchsorted(doc, d, "right")]
                out[d] = np.concatenate([out[d], mine])
        parts.clear()

    held = 0
    for d, words in enumerate(texts):
        if len(words) < LEAST:
            continue
        ids, starts, ends = _stretches(words)
        for s, e in zip(starts, ends):
            parts.append((d, int(s), ids[s:e]))
            held += e - s
            if held >= BATCH_WORDS:
                flush()
                held = 0
    if parts:
        flush()
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that stay: of each run its first period."""
    if not len(runs):
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]


def summary(words: list[bytes], runs: np.ndarray) -> tuple:
    """The digest columns after ``doc_id``."""
    best = (None,) * 4
    if len(runs):
        s, length, p = (int(v) for v in runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]])
        best = s, length, p, 1000 * length // p
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs.tolist())
    return (len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest())


def _rows(planted: bool):
    def run(batches):
        for pdf in batches:
            ids = [None if i is None else int(i) for i in pdf["id"]]
            texts = [t.encode().split() if t else [] for t in pdf["text"]]
            if planted:
                texts = [planted_words(i, w) for i, w in zip(ids, texts)]
            rows = [(i, *summary(w, r)) for i, w, r in zip(ids, texts, runs_of(texts))]
            columns = list(zip(*rows)) or [()] * len(NAMES)
            # whole numbers with gaps: as nullable integers, never by way of floats
            yield pd.DataFrame({c: pd.array(v, dtype="string" if c.endswith("sha256") else "Int64") for c, v in zip(NAMES, columns)})
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: bool = False) -> DataFrame:
    """``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256`` per row.

    ``planted``: words of every tenth id are made periodic first, as the query asks."""
    bound_batches(docs.sparkSession)
    # ids travel as text: pandas would turn large ones next to a null into floats
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInPandas(_rows(planted), SCHEMA)


def op13_runs(spark, sf_dir: str) -> DataFrame:
    return periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), planted=True)
