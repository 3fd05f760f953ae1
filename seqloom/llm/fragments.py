"""Routing of repeated windows: fragments dealt by content to bounded buckets.

A window is L consecutive units (bytes or words) of one document.  Its minimizer is the smallest
hash among the m-unit grams in it, so equal windows have equal minimizers.  Consecutive windows
with one minimizer form a run, and the units they cover a fragment.  Windows can only be equal
if their fragments share the minimizer, so:

1. minimizers are counted; runs whose minimizer occurs once in all documents are left out;
2. equal fragments (by minimizer and a second 64-bit hash) are one class, which keeps its first place;
3. the text of each class's first place is fetched once and dealt by minimizer to a bucket, where
   an index (given by the operator) finds which of its windows also start at an earlier place;
4. the places of a class that come after its first are repeats as a whole.

Nothing is sampled and no bucket is capped: the windows of a minimizer with very many different
fragments (say, where a common passage begins in ever other text) are dealt anew by their second
smallest gram.  All joins are on hash keys or on
doc_id and pre-aggregated where a key can be hot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import materialize

_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
#: Stands for a null doc_id, which comes after all others.
NO_ID = (1 << 63) - 1
#: Windows of a run, different fragments of a bucket before it is dealt anew, bytes indexed together,
#: and bytes of documents that are cut together.
RUN, WIDE, CHUNK, BATCH = 1024, 1_000, 1 << 20, 1 << 15


@dataclass(frozen=True)
class Units:
    """What a window is made of.  ``length``: units of a window; ``gram``: units of a hashed gram."""

    kind: str
    length: int
    gram: int

    def read(self, text: bytes | None) -> tuple[bytes, np.ndarray, np.ndarray]:
        """(data, starts, ends): unit i is data[starts[i]:ends[i]]; for bytes both arrays are empty."""
        if self.kind == "bytes":
            return text or b"", np.empty(0, np.int64), np.empty(0, np.int64)
        data = b" ".join((text or b"").split())
        if not data:
            return data, np.empty(0, np.int64), np.empty(0, np.int64)
        gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
        return data, np.concatenate(([0], gaps + 1)), np.append(gaps, len(data))

    def gram_hashes(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash for each gram."""
        if self.kind == "bytes":
            n = len(data) - self.gram + 1
            if n < 1:
                return np.empty(0, np.uint64)
            eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
            places = [*range(0, self.gram - 7, 8)] + ([self.gram - 8] if self.gram % 8 else [])
            x = eights[:n] * _K[0]
            for k, at in enumerate(places[1:], 1):
                x += eights[at : at + n] * (_K[k % 4] ^ np.uint64(2 * k))
            x ^= x >> np.uint64(32)
            x *= _K[1]
            x ^= x >> np.uint64(29)
            return x
        n = len(ends) - self.gram + 1
        if n < 1:
            return np.empty(0, np.uint64)
        words = word_hashes(data, starts, ends)
        x = np.zeros(n, np.uint64)
        for k in range(self.gram):
            x = (x ^ words[k : k + n]) * _K[k % 4]
            x ^= x >> np.uint64(31)
        return x

    def cut(self, data: bytes, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, count: np.ndarray) -> Iterator[bytes]:
        """The fragments of runs of ``count`` windows from unit ``at``."""
        if self.kind == "bytes":
            a, b = at, at + count + (self.length - 1)
        else:
            a, b = starts[at], ends[at + count + (self.length - 2)]
        return (data[i:j] for i, j in zip(a.tolist(), b.tolist()))


_LETTER = np.random.default_rng(7).integers(0, 1 << 64, 256, np.uint64)
_POWER = np.cumprod(np.full(1 << 12, 0xD1342543DE82EF95, np.uint64))


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each word data[starts[i]:ends[i]] of words joined by one space; it depends on the word alone."""
    size = ends - starts
    long = np.flatnonzero(size >= len(_POWER))
    letters = _LETTER[np.frombuffer(data, np.uint8)]
    at = np.arange(len(data)) - np.repeat(starts, np.append(np.diff(starts), len(data) - starts[-1]))
    letters *= _POWER[np.minimum(at, len(_POWER) - 1) if len(long) else at]
    if len(starts) > 1:
        letters[ends[:-1]] = 0  # the spaces
    x = np.add.reduceat(letters, starts) + size.astype(np.uint64)
    x = (x ^ x >> np.uint64(32)) * _K[0]
    x ^= x >> np.uint64(29)
    for i in long.tolist():  # very long words one by one
        x[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]])
    return x


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over every ``width`` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        x = op(x[:-size], x[size:])
        size *= 2
    return op(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def runs(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, first window, windows, twice) of each run, from gram hashes; ``width`` grams are in a window.

    ``twice``: the minimizer stands at several places, so that windows of the run itself may be equal.
    """
    if len(x) < width:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none, np.empty(0, bool)
    low = _slide(x, width, np.minimum)
    start = np.concatenate(([0], np.flatnonzero(low[1:] != low[:-1]) + 1))
    count = np.diff(np.append(start, len(low)))
    if count.max() > RUN:
        parts = -(-count // RUN)
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start = np.repeat(start, parts) + step * RUN
        count = np.minimum(np.repeat(count, parts) - step * RUN, RUN)
    found = low[start]
    # Minimizers are small hashes, so few places need a look.
    small = np.sort(x[x <= found.max()])
    equal = small[1:][small[1:] == small[:-1]]
    twice = np.isin(found, equal) if len(equal) else np.zeros(len(start), bool)
    return found, start, count, twice


@dataclass
class Batch:
    """Runs of several documents at once: their documents, minimizers, first windows and numbers of windows.

    Documents are put together, so that the arrays are long enough to be worth a call; windows
    across two documents are left out.
    """

    doc: np.ndarray
    h: np.ndarray
    start: np.ndarray
    count: np.ndarray
    twice: np.ndarray
    pieces: Callable[[], Iterator[bytes]]


def batch_runs(texts: list[bytes | None], units: Units) -> Batch:
    """The runs of all ``texts``, as ``runs`` finds them in each."""
    if units.kind == "bytes":
        parts = [t or b"" for t in texts]
        data, starts, ends = b"".join(parts), np.empty(0, np.int64), np.empty(0, np.int64)
        size = np.fromiter(map(len, parts), np.int64, len(parts))
    else:
        parts = [b" ".join((t or b"").split()) for t in texts]
        size = np.fromiter((p.count(b" ") + 1 if p else 0 for p in parts), np.int64, len(parts))
        data, starts, ends = units.read(b" ".join(parts))
    begin = np.cumsum(size) - size
    width = units.length - units.gram + 1
    windows = np.maximum(size - (units.length - 1), 0)
    total = int(windows.sum())
    if not total:
        none = np.empty(0, np.int64)
        return Batch(none, np.empty(0, np.uint64), none, none, np.empty(0, bool), lambda: iter(()))
    x = units.gram_hashes(data, starts, ends)
    doc = np.repeat(np.arange(len(parts)), windows)
    at = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
    low = _slide(x, width, np.minimum)[at + begin[doc]]
    first = np.concatenate(([0], np.flatnonzero((low[1:] != low[:-1]) | (doc[1:] != doc[:-1])) + 1))
    count = np.diff(np.append(first, total))
    start, owner, found = at[first], doc[first], low[first]
    if count.max() > RUN:
        parts_of = -(-count // RUN)
        step = np.arange(parts_of.sum()) - np.repeat(np.cumsum(parts_of) - parts_of, parts_of)
        start = np.repeat(start, parts_of) + step * RUN
        owner, found = np.repeat(owner, parts_of), np.repeat(found, parts_of)
        count = np.minimum(np.repeat(count, parts_of) - step * RUN, RUN)
    # Minimizers are small hashes, so few places need a look for those that stand twice in a document.
    place = np.flatnonzero(x <= found.max())
    where = np.searchsorted(begin + size, place, "right")
    order = np.lexsort((where, x[place]))
    value, where = x[place][order], where[order]
    equal = value[1:][(value[1:] == value[:-1]) & (where[1:] == where[:-1])]
    twice = np.isin(found, equal) if len(equal) else np.zeros(len(start), bool)
    return Batch(owner, found, start, count, twice, lambda: units.cut(data, starts, ends, start + begin[owner], count))


def _batches(texts: pa.Array) -> Iterator[tuple[int, list[bytes | None]]]:
    """(first row, texts) of parts of a column with about BATCH bytes."""
    held: list[bytes | None] = []
    size, first = 0, 0
    for row, text in enumerate(texts.cast(pa.binary())):
        value = text.as_py()
        held.append(value)
        size += len(value or b"")
        if size >= BATCH:
            yield first, held
            held, size, first = [], 0, row + 1
    if held:
        yield first, held


def rows_of(docs: DataFrame) -> DataFrame:
    """(id, twin, text): a document is told by its doc_id and, where that is null or repeated, by a hash of its text.

    ``twin`` is 0 for all other rows, so that it costs next to nothing in a shuffle.  Documents stand
    in the order (id, twin), null ids last; rows that repeat both id and text are one document.
    """
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.col("text").cast("string").alias("text"))
    again = materialize(ids.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 AND id <> " + str(NO_ID)).select("id"), "repeated-ids")
    marked = ids.join(again.withColumn("again", F.lit(True)), "id", "left")
    twin = F.when((F.col("id") == NO_ID) | F.col("again"), F.xxhash64(F.coalesce("text", F.lit("")))).otherwise(F.lit(0).cast("long"))
    return marked.select("id", twin.alias("twin"), "text")


def repeated_runs(rows: DataFrame, units: Units) -> DataFrame:
    """(h, g, id, twin, start, count, twice) of every run of ``rows_of`` a table whose minimizer h occurs again anywhere."""

    def minimizers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _batches(batch.column(0)):
                found = batch_runs(texts, units)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((found.h, found.h[found.twice])).view(np.int64))], ["h"])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            ids, twins = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, texts in _batches(batch.column(2)):
                found = batch_runs(texts, units)
                g = np.fromiter(map(digest, found.pieces()), np.uint64, len(found.h))
                columns = [found.h.view(np.int64), g.view(np.int64), ids[row + found.doc], twins[row + found.doc], found.start, found.count.astype(np.int32), found.twice]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "g", "id", "twin", "start", "count", "twice"])

    counted = rows.select("text").mapInArrow(minimizers, "h long").groupBy("h").agg(F.count("*").alias("n"))
    # Written ahead of the join, as the aggregation would tie a hot minimizer's rows to one task.
    again = materialize(counted.where("n > 1").select("h"), "minimizers")
    found = rows.mapInArrow(places, "h long, g long, id long, twin long, start long, count int, twice boolean").join(again, "h")
    return materialize(found, "runs")


def repeats(rows: DataFrame, units: Units, index: Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray], np.ndarray], within: bool) -> DataFrame:
    """(id, twin, start, count): runs of windows of ``rows_of`` a table that also start at an earlier place.

    Earlier: in a document that stands before or, if ``within``, at a smaller start of the same document.
    ``index(fragments, ids, starts, counts)`` gets whole buckets, documents numbered in their order, and returns a flag for every
    window of every fragment: whether it starts at an earlier place among these fragments.
    """
    found = repeated_runs(rows, units)
    first = found.groupBy("h", "g").agg(F.min(F.struct("id", "twin", "start", "count")).alias("first"), F.max("twice").alias("twice"))
    first = materialize(first.select("h", "g", "first.*", "twice"), "classes")
    # A bucket of one fragment that cannot repeat itself needs no index.  Written ahead of the join,
    # whose sides are then plain exchanges, so that Spark can split a hot minimizer's rows.
    kinds = first.groupBy("h").agg(F.count("*").alias("k"), F.max("twice").alias("again")).where("k > 1 OR again" if within else "k > 1")
    kinds = materialize(kinds.select("h", (F.col("k") > WIDE).alias("wide")), "buckets")
    wide = first.join(kinds, "h")
    wanted = wide.groupBy("id", "twin").agg(F.collect_list(F.struct("start", "count", "h", "g", "wide")).alias("want"))
    width = units.length - units.gram + 1

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        names = ["h", "sub", "g", "id", "twin", "start", "off", "count", "piece"]
        for batch in batches:
            for id_, twin, text, want in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()), batch.column(3)):
                read = units.read(text.as_py())
                w = want.values.flatten()
                start, count, h, g, wide = (c.to_numpy(zero_copy_only=False) for c in w)
                size = len(read[0]) if units.kind == "bytes" else len(read[2])
                inside = start + count + (units.length - 1) <= size
                out: list[tuple] = []
                for k, piece in zip(np.flatnonzero(inside).tolist(), units.cut(*read, start[inside], count[inside].astype(np.int64))):
                    if digest(piece) != int(g[k]) & 0xFFFFFFFFFFFFFFFF:
                        continue  # another text, by a collision of hashes
                    if not wide[k]:
                        out.append((h[k], 0, g[k], id_, twin, start[k], 0, count[k], piece))
                        continue
                    own = units.read(piece)
                    x = units.gram_hashes(*own)
                    x[x == np.int64(h[k]).view(np.uint64)] = ~np.uint64(0)
                    second, at, long, _ = runs(x, width)
                    for sub, off, n, part in zip(second.view(np.int64).tolist(), at.tolist(), long.tolist(), units.cut(*own, at, long)):
                        out.append((h[k], sub, g[k], id_, twin, start[k] + off, off, n, part))
                columns = list(zip(*out)) if out else [[] for _ in names]
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    pieces = rows.join(wanted, ["id", "twin"]).select("id", "twin", "text", "want").mapInArrow(
        fetch, "h long, sub long, g long, id long, twin long, start long, off int, count int, piece binary"
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solve(table: pa.Table) -> pa.RecordBatch:
            place = [table[c].to_numpy() for c in ("h", "sub", "id", "twin", "start")]
            again = np.all([x[1:] == x[:-1] for x in place], axis=0)
            if again.any():  # repeated rows
                table = table.filter(pa.array(np.concatenate(([True], ~again))))
            ids, twin, start, off, count = (table[c].to_numpy() for c in ("id", "twin", "start", "off", "count"))
            if twin.any():  # documents as numbers in their order
                order = np.lexsort((twin, ids))
                step = (np.diff(ids[order]) != 0) | (np.diff(twin[order]) != 0)
                number = np.empty(len(ids), np.int64)
                number[order] = np.concatenate(([0], np.cumsum(step)))
                ids = number
            flags = index(table["piece"].to_pylist(), ids, start, count.astype(np.int64))
            piece = np.repeat(np.arange(len(ids)), count)
            at = np.arange(len(flags)) - np.repeat(np.cumsum(count) - count, count)
            edge = np.concatenate(([True], (flags[1:] != flags[:-1]) | (piece[1:] != piece[:-1]))) if len(flags) else np.empty(0, bool)
            begin = np.flatnonzero(edge)
            long = np.diff(np.append(begin, len(flags)))
            hit = flags[begin] if len(flags) else np.empty(0, bool)
            begin, long = begin[hit], long[hit]
            of = piece[begin]
            return pa.RecordBatch.from_arrays([pa.array(table["h"].to_numpy()[of]), pa.array(table["g"].to_numpy()[of]), pa.array((off[of] + at[begin]).astype(np.int32)), pa.array(long.astype(np.int32))], ["h", "g", "off", "count"])

        size, open_ = 0, None  # open_: the bucket of the last row, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            h, sub = batch.column("h").to_numpy(), batch.column("sub").to_numpy()
            same = (h[0], sub[0]) == (h[-1], sub[-1]) == open_
            open_ = (h[-1], sub[-1])
            held.append(batch)
            size += batch.column("piece").nbytes
            if size >= CHUNK and not same:  # else there is nothing to cut, so nothing is put together
                table = pa.Table.from_batches(held).combine_chunks()
                h, sub = table["h"].to_numpy(), table["sub"].to_numpy()
                other = np.flatnonzero((h != h[-1]) | (sub != sub[-1]))
                if len(other):
                    cut = int(other[-1]) + 1
                    yield solve(table.slice(0, cut))
                    held = table.slice(cut).combine_chunks().to_batches()
                    size = sum(b.column("piece").nbytes for b in held)
        if held and sum(b.num_rows for b in held):
            yield solve(pa.Table.from_batches(held))

    dealt = pieces.repartition("h", "sub").sortWithinPartitions("h", "sub", "id", "twin", "start")
    verdict = dealt.mapInArrow(search, "h long, g long, off int, count int")
    key = ["id", "twin", "start"] if within else ["id", "twin"]
    later = F.struct(*key) > F.struct(*[f"first_{c}" for c in key])
    places = found.join(first.select("h", "g", *[F.col(c).alias(f"first_{c}") for c in ("id", "twin", "start")]), ["h", "g"])
    whole = places.where(later).select("id", "twin", "start", "count")
    parts = places.where(~later).select("h", "g", "id", "twin", "start").join(verdict, ["h", "g"]).select("id", "twin", (F.col("start") + F.col("off")).alias("start"), "count")
    return whole.unionByName(parts)


def remove(rows: DataFrame, units: Units, windows: DataFrame) -> DataFrame:
    """For each of ``rows_of`` a table (doc_id, n_units, n_removed, n_spans, spans, kept_sha256): every unit covered by ``windows`` goes.

    ``spans`` are the maximal removed runs as (start, end) in units; the kept units are joined by
    nothing (bytes) or one space (words) before hashing.
    """
    lists = windows.groupBy("id", "twin").agg(F.collect_list(F.struct("start", "count")).alias("gone"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for id_, text, gone in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), batch.column(2)):
                data, starts, ends = units.read(text.as_py())
                n = len(data) if units.kind == "bytes" else len(ends)
                spans: list[dict] = []
                kept, taken = data, 0
                if gone.is_valid and n:
                    start, count = (c.to_numpy(zero_copy_only=False) for c in gone.values.flatten())
                    depth = np.zeros(n + 1, np.int64)
                    np.add.at(depth, np.minimum(start, n), 1)
                    np.add.at(depth, np.minimum(start + count + (units.length - 1), n), -1)
                    lost = np.cumsum(depth)[:n] > 0
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], lost.view(np.int8), [0]))))
                    spans = [{"start": a, "end": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
                    taken = int(lost.sum())
                    if units.kind == "bytes":
                        kept = np.frombuffer(data, np.uint8)[~lost].tobytes()
                    else:
                        kept = b" ".join(data[a:b] for a, b in zip(starts[~lost].tolist(), ends[~lost].tolist()))
                out.append((None if id_ == NO_ID else id_, n, taken, len(spans), spans, hashlib.sha256(kept).hexdigest()))
            fields = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string()]
            columns = list(zip(*out)) if out else [[] for _ in fields]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fields)], ["doc_id", "n_units", "n_removed", "n_spans", "spans", "kept_sha256"])

    return (
        rows.join(lists, ["id", "twin"], "left")
        .select("id", "text", "gone")
        .mapInArrow(run, "doc_id long, n_units long, n_removed long, n_spans long, spans array<struct<start: long, end: long>>, kept_sha256 string")
    )
