"""Suffix-array dedup: threshold-bounded interval expansion on a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from seqloom.llm.fragments import Units, remove, repeats, rows_of

_END = 255  # no byte of UTF-8


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """The rotations of ``text`` sorted by their first ``depth`` bytes or more, by prefix doubling."""
    n = len(text)
    ring = np.concatenate((text, np.resize(text, 8))).tobytes()
    key = np.ndarray((n,), ">u8", ring, strides=(1,)).astype(np.uint64)
    size = 8
    while True:
        order = np.argsort(key)
        ahead = key[order]
        new = np.concatenate(([0], np.cumsum(ahead[1:] != ahead[:-1])))
        if size >= depth or new[-1] == n - 1:
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = new
        key = rank << np.uint64(32) | np.roll(rank, -size)
        size *= 2


def prefix_classes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): rotations in suffix order, and whether each begins a class of equal ``length``-byte prefixes.

    Backward extension on the transform: the interval of a string s becomes those of all strings
    cs, the LF images of its rows with byte c.  Intervals are expanded breadth first, so common
    prefixes come by increasing value; a right end seen for the first time at length l has a common
    prefix of l with its neighbour.  Expansion stops at ``length``: ends not seen by then lie
    within a class.
    """
    n = len(text)
    order = suffix_order(text, length + 1)
    last = text[order - 1]  # the transform
    lf = np.empty(n, np.int64)
    lf[np.argsort(last, kind="stable")] = np.arange(n)
    seen = np.zeros(n + 1, bool)
    seen[[0, n]] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        size = high - low
        one = size == 1
        to = [lf[low[one]]]
        till = [to[0] + 1]
        low, size = low[~one], size[~one]
        if len(low):
            # Rows of an interval in the order of their LF images: a byte's rows are neighbours.
            owner = np.repeat(np.arange(len(low)), size)
            row = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
            byte, image = owner << 8 | last[row], lf[row]
            if len(low) < 1 << 23 and n < 1 << 32:  # both fit one long
                key = np.sort(byte << 32 | image)
                byte, image = key >> 32, key & 0xFFFFFFFF
            else:  # rows of one byte stand in the order of their images
                order_of = np.argsort(byte, kind="stable")
                byte, image = byte[order_of], image[order_of]
            edge = np.flatnonzero(byte[1:] != byte[:-1]) + 1
            begin = np.concatenate(([0], edge))
            end = np.append(edge, len(byte))
            to.append(image[begin])
            till.append(image[end - 1] + 1)
        low, high = np.concatenate(to), np.concatenate(till)
        new = ~seen[high]
        low, high = low[new], high[new]
        seen[high] = True
        if not len(low):
            break
    return order, seen[:n]


def earlier_windows(length: int):
    """An index for ``fragments.repeats``: flags for windows of ``length`` bytes that start at an earlier place."""

    def index(fragments: list[bytes], ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        text = np.frombuffer(b"".join(f + b"\xff" for f in fragments), np.uint8)
        size = np.fromiter(map(len, fragments), np.int64, len(fragments)) + 1
        at = np.cumsum(size) - size
        step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        window = np.repeat(at, counts) + step  # its place in text
        place = np.repeat(starts, counts) + step
        turn = np.empty(len(window), np.int64)
        turn[np.lexsort((place, np.repeat(ids, counts)))] = np.arange(len(window))
        order, first = prefix_classes(text, length)
        rank = np.empty(len(text), np.int64)
        rank[order] = np.cumsum(first) - 1
        of = rank[window]
        least = np.full(of.max() + 1 if len(of) else 0, len(window), np.int64)
        np.minimum.at(least, of, turn)
        return turn > least[of]

    return index


def remove_repeated_bytes(docs: DataFrame, length: int = 100) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts earlier.

    ``docs(doc_id, text, ...)``; earlier means a smaller doc_id, or the same document and an
    earlier start.  Strings are judged on the input and never cross documents.  Returns doc_id,
    n_bytes, n_removed, n_spans, spans and kept_sha256 for every row.  Null text counts as empty;
    texts shorter than ``length`` stay whole.  Rows of one doc_id with unlike texts, and rows without a
    doc_id, are documents of their own, in the order of a hash of their text, null ids last; rows
    that repeat id and text are one document.  An empty table gives an empty table; other columns are not read.
    """
    units = Units("bytes", length, max(8, length // 24 * 8))
    rows = rows_of(docs)
    found = repeats(rows, units, earlier_windows(length), within=True)
    return remove(rows, units, found).withColumnRenamed("n_units", "n_bytes")
