"""Centroid clustering over a VA-file: few-bit cells per dimension bound distances, full vectors decide where bounds overlap."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import discard, materialize

#: Bits of a cell; a byte holds the cells of two dimensions.
BITS = 4
CELLS = 1 << BITS
#: Components are scaled to integers; vectors with one of this size or more are left out, as squares of distances would not fit a long.
SCALE, WIDEST = 256, 1 << 24
#: Vectors whose bounds a task works out together.
BLOCK = 4096


def kept_vectors(vectors: DataFrame, dim: int) -> DataFrame:
    """(vec_id, v): vectors of exactly ``dim`` finite components, as integers floor(256 * x)."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(F.floor(e * SCALE)) < WIDEST), F.lit(False)))
    good = vectors.where((F.size("embedding") == dim) & fine)
    return good.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e * SCALE).cast("int")).alias("v"))


def first_centroids(kept: DataFrame, k: int) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``2:<vec_id>``; equal hashes go by the vector."""
    name = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return np.array([r["v"] for r in kept.select(name.alias("h"), "v").orderBy("h", "v").limit(k).collect()], np.int64)


def cell_bounds(kept: DataFrame, dim: int) -> np.ndarray:
    """The CELLS + 1 bounds of each dimension's cells: least, quantiles and most over all vectors; one row reaches the driver."""
    steps = [i / CELLS for i in range(1, CELLS)]
    parts = []
    for i in range(dim):
        x = F.get("v", F.lit(i))
        parts += [F.min(x), F.percentile_approx(x, steps, 1000), F.max(x)]
    row = kept.agg(*[p.alias(f"c{i}") for i, p in enumerate(parts)]).first()
    return np.array([[row[3 * i], *row[3 * i + 1], row[3 * i + 2] + 1] for i in range(dim)], np.int64)


def write_cells(kept: DataFrame, bounds: np.ndarray) -> DataFrame:
    """The VA-file (vec_id, cells, v): packed cells, and the vector as little-endian 32-bit integers, read only where needed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _numbers(batch.column(1), len(bounds))
            cell = np.empty(v.shape, np.uint8)
            for d, edge in enumerate(bounds):
                cell[:, d] = np.searchsorted(edge[1:-1], v[:, d], "right")
            if v.shape[1] % 2:
                cell = np.concatenate([cell, np.zeros((len(cell), 1), np.uint8)], axis=1)
            packed = cell[:, ::2] | cell[:, 1::2] << BITS
            yield pa.RecordBatch.from_arrays([batch.column(0), _binary(packed), _binary(v.astype("<i4"))], ["vec_id", "cells", "v"])

    return materialize(kept.mapInArrow(run, "vec_id long, cells binary, v binary"), "va-file")


def _numbers(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64)


def _binary(rows: np.ndarray) -> pa.Array:
    """A binary value for each row of an array."""
    raw = np.ascontiguousarray(rows)
    width = raw.shape[1] * raw.itemsize
    offsets = np.arange(len(raw) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes())])


def _rows_of(column: pa.Array, width: int, dtype: str) -> np.ndarray:
    """Binary values of equal length as rows, without a copy."""
    if not len(column):
        return np.empty((0, width), dtype)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(dtype).reshape(len(column), width)


class Bounds:
    """Lookup tables of least and most squared distance from each cell to each centroid, and assignment by them."""

    def __init__(self, bounds: np.ndarray, centroids: np.ndarray):
        self.centroids = centroids
        k, dim = centroids.shape
        low, high = bounds[:, :-1, None], bounds[:, 1:, None] - 1  # a cell's least and most integer
        high = np.maximum(low, high)
        c = centroids.T[:, None, :]
        least = np.maximum(np.maximum(low - c, c - high), 0) ** 2
        most = np.maximum(np.abs(c - low), np.abs(c - high)) ** 2
        table = np.concatenate([least, most], axis=2)
        if dim % 2:
            table = np.concatenate([table, np.zeros((1, CELLS, 2 * k), np.int64)])
        # One entry for both cells of a byte.
        self.table = (table[::2, None, :, :] + table[1::2, :, None, :]).reshape(len(table) // 2, CELLS * CELLS, 2 * k)

    def assign(self, cells: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, int]:
        """(nearest centroid of each row, rows whose vectors were needed); of equally near ones the smaller number."""
        k = len(self.centroids)
        out = np.empty(len(cells), np.int64)
        fetched = 0
        for at in range(0, len(cells), BLOCK):
            part = cells[at : at + BLOCK]
            sums = np.zeros((len(part), 2 * k), np.int64)
            for byte, table in enumerate(self.table):
                sums += table[part[:, byte]]
            possible = sums[:, :k] <= sums[:, k:].min(axis=1, keepdims=True)
            nearest = possible.argmax(axis=1)
            open_ = np.flatnonzero(possible.sum(axis=1) > 1)
            if len(open_):
                fetched += len(open_)
                row, centroid = np.nonzero(possible[open_])
                gap = vectors[at + open_].astype(np.int64)[row] - self.centroids[centroid]
                far = np.full((len(open_), k), np.iinfo(np.int64).max)
                far[row, centroid] = (gap * gap).sum(axis=1)
                nearest[open_] = far.argmin(axis=1)
            out[at : at + BLOCK] = nearest
        return out, fetched


def _add(sums: np.ndarray, to: np.ndarray, rows: np.ndarray) -> None:
    """Add ``rows`` to the sums of their clusters ``to``."""
    if len(to):
        order = np.argsort(to, kind="stable")
        first = np.flatnonzero(np.diff(to[order], prepend=-1))
        sums[to[order[first]]] += np.add.reduceat(rows[order], first, axis=0)


def _moves(table: DataFrame, bounds: np.ndarray, now: np.ndarray, before: np.ndarray | None) -> dict[int, tuple[int, list[int]]]:
    """What each cluster's count and sums gain between centroids ``before`` (None: no vector assigned) and ``now``.

    Only vectors that change their cluster, or whose bounds overlap, are read.  Each task adds up its rows; a row for
    each cluster and dimension reaches the driver.
    """
    k, dim = now.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Tables are made here: what is sent to a task is k x dim numbers.
        new, old = Bounds(bounds, now), None if before is None else Bounds(bounds, before)
        sums = np.zeros((k, dim + 1), np.int64)
        for batch in batches:
            cells, vectors = _rows_of(batch.column(0), (dim + 1) // 2, "u1"), _rows_of(batch.column(1), dim, "<i4")
            to, _ = new.assign(cells, vectors)
            left = None if old is None else old.assign(cells, vectors)[0]
            at = np.arange(len(to)) if left is None else np.flatnonzero(to != left)
            moved = np.concatenate([np.ones((len(at), 1), np.int64), vectors[at]], axis=1)
            _add(sums, to[at], moved)
            if left is not None:
                _add(sums, left[at], -moved)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size)), pa.array(sums.reshape(-1))], ["at", "s"])

    # A task's sums fit a long (its rows times 2^24); those of all tasks are added as decimals.
    parts = table.select("cells", "v").mapInArrow(run, "at long, s long").groupBy("at").agg(F.sum(F.col("s").cast("decimal(19,0)")).alias("s"))
    sums = {r["at"]: int(r["s"]) for r in parts.collect()}
    return {c: (sums.get(c * (dim + 1), 0), [sums.get(c * (dim + 1) + 1 + d, 0) for d in range(dim)]) for c in range(k)}


def train(table: DataFrame, bounds: np.ndarray, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """The centroids after ``rounds`` rounds: each becomes floor(sum / count) of its vectors by component; an empty one stays."""
    k, dim = centroids.shape
    count, total, before = [0] * k, [[0] * dim for _ in range(k)], None
    for _ in range(rounds):
        for c, (n, sums) in _moves(table, bounds, centroids, before).items():
            count[c] += n
            total[c] = [a + b for a, b in zip(total[c], sums)]
        before = centroids
        centroids = np.array([[s // count[c] for s in total[c]] if count[c] else centroids[c] for c in range(k)], np.int64)
    return centroids


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for each kept row of ``vectors(vec_id, embedding, ...)``.

    Lloyd rounds over integer vectors, exact: bounds from cells only leave out centroids that cannot be nearest.  The
    first centroids are the ``k`` vectors with the smallest hashes of their ids.  What reaches the driver and every task is
    k x dim numbers.  Each round's sums are those of the round before with what vectors that changed
    their cluster add and take.

    Null vectors, those of another length and those with a null, NaN or infinite component are left out, and so are those with a
    component of 2^16 or more, as squares would not fit a long.  Rows with null or repeated vec_ids each have a row; a null
    vec_id is hashed as the empty string.  With fewer than ``k`` vectors there are as many centroids as vectors; equal vectors
    may make several centroids, of which the first has all.  An empty table gives an empty result; other columns are not
    read.  Inertias beyond a long are null.
    """
    kept = materialize(kept_vectors(vectors, dim), "kept-vectors")
    centroids = first_centroids(kept, k)
    schema = "vec_id long, cluster int, distance long"
    if not len(centroids):
        empty = kept.sparkSession.createDataFrame([], f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string")
        discard(kept)
        return empty
    bounds = cell_bounds(kept, dim)
    table = write_cells(kept, bounds)
    discard(kept)
    centroids = train(table, bounds, centroids, rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = Bounds(bounds, centroids)
        for batch in batches:
            vectors = _rows_of(batch.column(2), dim, "<i4")
            to, _ = last.assign(_rows_of(batch.column(1), (dim + 1) // 2, "u1"), vectors)
            gap = vectors.astype(np.int64) - last.centroids[to]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(to.astype(np.int32)), pa.array((gap * gap).sum(axis=1))], ["vec_id", "cluster", "distance"])

    placed = materialize(table.mapInArrow(run, schema), "clusters")
    discard(table)
    names = {c: hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for c, row in enumerate(centroids.tolist())}
    sums = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(19,0)")).alias("s")).collect()}
    short = lambda x: x if x < 1 << 63 else None
    rows = [(c, short(s), short(sum(sums.values())), names[c]) for c, s in sums.items()]
    each = placed.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # a row a cluster
    return placed.join(F.broadcast(each), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
