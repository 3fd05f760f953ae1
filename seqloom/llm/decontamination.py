"""Benchmark decontamination: a broadcast hash set of the test items' n-grams, looked up at every window of the documents."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import ascii_lower, discard, fresh, materialize

#: Words of a window.
SIZE = 10
#: (window, item) pairs of one broadcast set; more pairs make more sets, and documents are scanned once for each.
LIMIT = 200_000
#: Rows and bytes of text that a task looks at together.
ROWS, BYTES = 256, 4_000_000

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word of a text whose A-Z are not lower-cased yet.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Bytes of a text: A-Z in lower case, what ends a word as a space.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def plain_words(text: str | None) -> list[bytes]:
    """The words of a text in lower case, in UTF-8."""
    return (text or "").encode().translate(_PLAIN).split()


def _item_words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BREAK), lambda w: w != "")


def item_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """(w, item): each different window of each item of ``benchmark(item_id, text, ...)``; an item of fewer words is one window."""
    words = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), _item_words(F.col("text").cast("string")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (size - 1), F.lit(1)))
    return words.select(F.explode(F.transform(starts, lambda i: F.array_join(F.slice("words", i, size), " "))).alias("w"), "item").distinct()


class WindowSet:
    """Windows as rows of word numbers, found by a 64-bit hash and then compared word by word."""

    def __init__(self, pairs: list[tuple[str, str]]):
        by_window: dict[bytes, list[str]] = {}
        for window, item in pairs:
            by_window.setdefault(window.encode(), []).append(item)
        split = [w.split(b" ") for w in by_window]
        #: Words of the windows, from 1; every other word is 0.
        self.number = {w: i for i, w in enumerate(dict.fromkeys(w for words in split for w in words), 1)}
        self.items = list(by_window.values())
        by_length: dict[int, list[int]] = {}
        for i, words in enumerate(split):
            by_length.setdefault(len(words), []).append(i)
        self.lengths = {}
        for length, members in by_length.items():
            rows = np.array([[self.number[w] for w in split[i]] for i in members], np.int64)
            seed = 0
            while True:  # until no two windows have one hash
                factors = np.random.default_rng(seed).integers(-(1 << 62), 1 << 62, length, np.int64) | 1
                keys = (rows * factors).sum(axis=1)
                order = np.argsort(keys)
                if not (np.diff(keys[order]) == 0).any():
                    break
                seed += 1
            self.lengths[length] = (factors, keys[order], rows[order], np.array(members)[order])

    def find(self, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """(starts, length, windows) of all occurrences in a row of word numbers."""
        known = np.concatenate([[0], np.cumsum(numbers > 0)])
        for length, (factors, keys, rows, members) in self.lengths.items():
            # Only a run of known words can hold a window.
            starts = np.flatnonzero(known[length:] - known[:-length] == length) if len(numbers) >= length else np.empty(0, np.int64)
            for at in range(0, len(starts), 1 << 17):
                part = starts[at : at + (1 << 17)]
                words = numbers[part[:, None] + np.arange(length)]
                key = (words * factors).sum(axis=1)
                place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = np.flatnonzero(keys[place] == key)
                hit = hit[(rows[place[hit]] == words[hit]).all(axis=1)]
                if len(hit):
                    yield part[hit], length, members[place[hit]]


def _look(found: WindowSet, texts: list[str | None]) -> Iterator[tuple[int, list[int], set[str]]]:
    """(words, places of hit words, items) of each text; texts are looked at together, with a 0 between them."""
    numbers, ends = [], []
    total = 0
    for t in texts:
        words = plain_words(t)
        numbers.append(np.fromiter(map(found.number.get, words, [0] * len(words)), np.int64, len(words)))
        numbers.append(np.zeros(1, np.int64))
        total += len(words) + 1
        ends.append(total)
    row = np.concatenate(numbers) if numbers else np.empty(0, np.int64)
    hit = np.zeros(len(row), bool)
    items: dict[int, set[str]] = {}
    edges = np.array(ends)
    for starts, length, windows in found.find(row):
        for k in range(length):
            hit[starts + k] = True
        docs = np.searchsorted(edges, starts, "right")
        for d, w in set(zip(docs.tolist(), windows.tolist())):
            items.setdefault(d, set()).update(found.items[w])
    begin = 0
    for i, end in enumerate(ends):
        yield end - begin - 1, np.flatnonzero(hit[begin:end]).tolist() if i in items else [], items.get(i, set())
        begin = end


def _parts(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts of column ``at``), cut so that a part has at most ROWS rows and, but for one long text, BYTES of text."""
    begin, texts, size = 0, [], 0
    for i in range(batch.num_rows):
        text = batch.column(at)[i].as_py()
        n = len(text or "")
        if texts and (len(texts) >= ROWS or size + n > BYTES):
            yield begin, texts
            begin, texts, size = i, [], 0
        texts.append(text)
        size += n
    if texts:
        yield begin, texts


def _blocks(benchmark: DataFrame, size: int, limit: int) -> tuple[DataFrame, int]:
    """The pairs of windows and items, written, and how many sets of at most ``limit`` pairs they are dealt to."""
    pairs = materialize(item_windows(benchmark, size), "benchmark-windows")
    total = pairs.count()
    sets = -(-total // limit)
    while sets > 1 and pairs.groupBy(F.pmod(F.xxhash64("w", "item"), F.lit(sets)).alias("b")).count().agg(F.max("count")).first()[0] > limit:
        sets += 1 + sets // 8
    return pairs, sets


def mark(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, limit: int = LIMIT) -> tuple[DataFrame, list[str]]:
    """(``docs`` with three columns behind them, the names of these): words, places of hit words, sorted items with occurring windows.

    The set is broadcast only up to ``limit`` pairs of windows and items.  Beyond it the pairs are dealt to several sets by
    hash, and each set's scan adds its hits to those of the scans before; between scans rows are
    written, so one task never holds two sets.  Documents are not shuffled.
    """
    spark = docs.sparkSession
    names = fresh(docs, "_n_words", "_hit", "_items")
    kinds = dict(zip(names, ("long", "array<int>", "array<string>")))
    out = docs.withColumns({n: F.lit(None).cast(t) for n, t in kinds.items()})
    pairs, sets = _blocks(benchmark, size, limit)
    columns, text_at = out.columns, docs.columns.index("text")
    for b in range(max(1, sets)):
        rows = pairs.where(F.pmod(F.xxhash64("w", "item"), F.lit(max(1, sets))) == b).collect()
        shared = spark.sparkContext.broadcast(WindowSet([(r["w"], r["item"]) for r in rows]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            found = shared.value
            for batch in batches:
                for begin, texts in _parts(batch, text_at):
                    part = batch.slice(begin, len(texts))
                    before = part.column(len(columns) - 2).to_pylist(), part.column(len(columns) - 1).to_pylist()
                    n, hits, items = [], [], []
                    for i, (words, hit, item) in enumerate(_look(found, texts)):
                        n.append(words)
                        hits.append(sorted({*hit, *before[0][i]}) if before[0][i] else hit)
                        items.append(sorted(item.union(before[1][i] or ())))
                    new = [pa.array(n, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays([*part.columns[: len(columns) - 3], *new], columns)

        typed = out.withColumn("text", F.col("text").cast("string"))
        out = typed.mapInArrow(run, typed.schema)
        if b + 1 < sets:
            out = materialize(out, "contamination")
    discard(pairs)
    return out, names


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated): a row for each row of ``docs(doc_id, text, ...)``.

    A word is a run of digits, a-z (after A-Z are lower-cased) and characters beyond ASCII.  A word is hit if it stands
    in an occurrence of a window: ``size`` consecutive words of an item, or all words of a shorter item.
    ``items_sha256`` is of the item_ids with occurring windows, sorted as strings and comma-joined.

    Null and empty texts have no words, in either table; without items nothing is contaminated; an empty table gives an
    empty result.  Rows with null or repeated doc_ids are judged each by its own text.  Rows of one item_id are one
    item, and a null item_id stands as ''.  Extra columns, whatever their names, are not read.  Texts are looked at whole; a
    very long one is a part of its own.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked, (words, hit, items) = mark(plain, benchmark, size, limit)
    digest = F.sha2(F.array_join(F.col(items), ","), 256)
    return marked.select(
        "doc_id", F.col(words).alias("n_words"), F.size(hit).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"), digest.alias("items_sha256"), (F.size(hit) > 0).alias("contaminated")
    )


def without_words(text: str, hit: list[int]) -> str:
    """``text`` without the words at places ``hit`` (sorted); of consecutive ones what stands between them goes too."""
    gone = set(hit)
    out, at, begun = [], 0, None
    for i, m in enumerate(_WORD.finditer(text)):
        if i in gone:
            if begun is None:
                begun = m.start()
                out.append(text[at:begun])
            at = m.end()
        else:
            begun = None
    return "".join(out) + text[at:]


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", size: int = SIZE, max_share: float = 0.0, limit: int = LIMIT) -> DataFrame:
    """``docs`` without what they share with ``benchmark``.

    ``remove='spans'`` cuts each maximal run of hit words out of the text; ``remove='documents'`` drops a document if over
    ``max_share`` of its words are hit.  Clean documents stay as they are, null texts too.  Only ``text`` (and ``n_chars``, if
    there) of a document with a hit changes.  Rows with null or repeated doc_ids are treated each by its own text;
    extra columns, whatever their names, stay; an empty table gives an empty table.
    """
    if remove not in ("spans", "documents"):
        raise ValueError("remove is 'spans' or 'documents'")
    marked, (words, hit, _) = mark(docs, benchmark, size, limit)
    if remove == "documents":
        return marked.where(F.size(hit) <= F.lit(max_share) * F.col(words)).select(*docs.columns)
    columns = docs.columns
    at, counted = columns.index("text"), columns.index("n_chars") if "n_chars" in columns else None
    read = [*columns, hit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(len(columns)).to_pylist()
            changed = [i for i, p in enumerate(places) if p]
            arrays = list(batch.columns[: len(columns)])
            if changed:
                texts = arrays[at].to_pylist()
                for i in changed:
                    texts[i] = without_words(texts[i], places[i])
                arrays[at] = pa.array(texts, arrays[at].type)
                if counted is not None:
                    sizes = arrays[counted].to_pylist()
                    for i in changed:
                        sizes[i] = len(texts[i])
                    arrays[counted] = pa.array(sizes, arrays[counted].type)
            yield pa.RecordBatch.from_arrays(arrays, columns)

    return marked.select(*read).mapInArrow(run, marked.select(*columns).schema)
