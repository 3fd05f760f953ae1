"""Substring dedup: relative Lempel-Ziv parsing against indexed reference blocks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from seqloom.llm.fragments import Units, remove, repeats, rows_of

#: Words of a factor at most.
LONGEST = 32


class Reference:
    """A block of fragments, indexed: suffixes in order, and the smallest document of any range of them."""

    def __init__(self, words: np.ndarray, ids: np.ndarray, longest: int):
        n = len(words)
        self.words = np.concatenate((words, np.full(longest + 1, words.max(initial=0) + 1)))
        key = np.append(words, [])
        size = 1
        while True:
            order = np.argsort(key, kind="stable")
            ahead = key[order]
            new = np.concatenate(([0], np.cumsum(ahead[1:] != ahead[:-1])))
            if size >= longest or new[-1] == n - 1:
                break
            rank = np.empty(n, np.int64)
            rank[order] = new
            key = rank << 32 | np.append(rank[size:] + 1, np.zeros(min(size, n), np.int64))[:n]
            size *= 2
        self.order = order
        self.least = [ids[order]]
        while 2 << (len(self.least) - 1) <= n:
            half = 1 << (len(self.least) - 1)
            low = self.least[-1]
            self.least.append(np.minimum(low[:-half], low[half:]))

    def smallest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest document in each range [low, high) of suffixes."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level).tolist():
            m = level == k
            table = self.least[k]
            out[m] = np.minimum(table[low[m]], table[high[m] - (1 << k)])
        return out

    def _bound(self, low: np.ndarray, high: np.ndarray, depth: np.ndarray, word: np.ndarray, right: bool) -> np.ndarray:
        """Where ``word`` would stand among the words at ``depth`` of the suffixes in [low, high)."""
        low, high = low.copy(), high.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            mid = (low[open_] + high[open_]) >> 1
            there = self.words[self.order[mid] + depth[open_]]
            up = there <= word[open_] if right else there < word[open_]
            low[open_[up]] = mid[up] + 1
            high[open_[~up]] = mid[~up]
            open_ = open_[low[open_] < high[open_]]
        return low

    def longest(self, at: np.ndarray, most: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The longest factor at each place ``at``, of ``most`` words or fewer, that stands in a document smaller than ``ids``."""
        low = np.zeros(len(at), np.int64)
        high = np.full(len(at), len(self.order))
        length = np.zeros(len(at), np.int64)
        live = np.flatnonzero(most > 0)
        while len(live):
            word = self.words[at[live] + length[live]]
            a = self._bound(low[live], high[live], length[live], word, False)
            b = self._bound(a, high[live], length[live], word, True)
            fine = b > a
            fine[fine] = self.smallest(a[fine], b[fine]) < ids[live[fine]]
            live, a, b = live[fine], a[fine], b[fine]
            low[live], high[live] = a, b
            length[live] += 1
            live = live[length[live] < most[live]]
        return length


def factored_windows(length: int, longest: int = LONGEST):
    """An index for ``fragments.repeats``: flags for windows of ``length`` words that also start in a smaller document.

    The bucket is a reference block.  Each fragment is factored greedily from its left end against
    the block; windows inside a factor are repeats.  A window across the end of a factor lies in no
    factor, so there the longest match from the window's own start is looked up.
    """
    longest = max(longest, length)

    def index(fragments: list[bytes], ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        parts = b" ".join(fragments).split(b" ")
        number = {w: k for k, w in enumerate(set(parts))}
        words = np.fromiter(map(number.__getitem__, parts), np.int64, len(parts))
        size = counts + (length - 1)
        begin = np.cumsum(size) - size
        end = begin + size
        owner = np.repeat(np.arange(len(size)), size)
        # A separator of its own kind stands between fragments, so that no factor crosses them.
        gap = owner + np.arange(len(words))
        text = np.full(len(words) + len(size), words.max(initial=0) + 1)
        text[gap] = words
        doc = np.full(len(text), np.iinfo(np.int64).max)
        doc[gap] = ids[owner]
        block = Reference(text, doc, longest)
        shift = np.arange(len(size))
        covered = np.zeros(len(words) + 1, np.int64)
        at, live = begin.copy(), np.arange(len(size))
        while len(live):
            n = block.longest(at[live] + shift[live], np.minimum(end[live] - at[live], longest), ids[live])
            hit = n >= length
            np.add.at(covered, at[live][hit], 1)
            np.add.at(covered, at[live][hit] + n[hit] - (length - 1), -1)
            at[live] += np.maximum(n, 1)
            live = live[end[live] - at[live] >= 1]
        step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        of = np.repeat(np.arange(len(size)), counts)
        window = begin[of] + step
        flags = np.cumsum(covered)[window] > 0
        across = np.flatnonzero(~flags)
        n = block.longest(window[across] + shift[of[across]], np.full(len(across), length), ids[of[across]])
        flags[across] = n >= length
        return flags

    return index


def remove_repeated_words(docs: DataFrame, length: int = 13) -> DataFrame:
    """Remove each word covered by a window of ``length`` words that also starts in a smaller doc_id.

    Words are ``[^\\x20\\x09-\\x0D]+`` of ``docs(doc_id, text, ...)``, unchanged; windows are judged
    on the input.  Returns doc_id, n_words, n_removed, n_spans, spans (in words) and kept_sha256 for
    every row.  Null text has no words; an empty table gives an empty table; other columns are not read.
    Rows of one doc_id with unlike texts, and rows without a doc_id, are documents of their own, in
    the order of a hash of their text, null ids last; rows that repeat id and text are one document.
    Words of a bucket are compared by their bytes.
    """
    units = Units("words", length, max(1, (length * 2) // 5))
    rows = rows_of(docs)
    found = repeats(rows, units, factored_windows(length), within=False)
    return remove(rows, units, found).withColumnRenamed("n_units", "n_words")
