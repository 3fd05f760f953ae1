"""SimHash near-dedup over a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import connected_components, materialize

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

#: Leaves of the index under one upper node, and pairs of nodes expanded at a time.
FANOUT = 8
PAIRS = 20_000


def fingerprint(text: bytes | None, width: int = 4, seed: int = 42) -> int:
    """The 64-bit SimHash of a text's ``width``-word shingles, repeats included; 0 without words."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    n = len(words) - width + 1
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[width - 1 :].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        part = hashes[at : at + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42, key: str = "doc_id long") -> DataFrame:
    """(doc_id, fp): each document's fingerprint as a signed long; a narrow map over whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, width, seed) for t in batch.column(1).cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64), pa.int64())], ["doc_id", "fp"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"{key}, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The position of each 64-bit pattern in Gray-code order."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Union the pairs (i, j) in ``label``, which holds each leaf's root."""
    while len(i):
        a, b = label[i], label[j]
        open_ = a != b
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := label[label], label):
            label[:] = up


def linked(group: np.ndarray, fp: np.ndarray, bits: int) -> np.ndarray:
    """The root (an index) of every leaf, for leaves linked inside their group at ``bits`` or fewer differing bits.

    ``fp`` stands in Gray order inside each group.  An upper node covers FANOUT neighbours and
    holds the bits that all of them share (mask and pattern); what a child adds is only the bits
    that its parent doesn't share.  Pairs of nodes are searched from the roots down; differences
    are added up from the residual bits, and a pair over the limit is pruned with all that stands
    below it.  Where even all open bits could not exceed the limit, or where both nodes are in
    one component already, the pair needs no expansion either.
    """
    n = len(fp)
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    levels = [{"mask": np.full(n, ~np.uint64(0)), "bits": fp, "at": np.arange(n), "sizes": np.diff(np.append(first, n))}]
    while levels[-1]["sizes"].max() > 1:
        low = levels[-1]
        sizes = -(-low["sizes"] // FANOUT)
        rank = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        start = np.repeat(np.cumsum(low["sizes"]) - low["sizes"], sizes) + rank * FANOUT
        same_mask = np.bitwise_and.reduceat(low["mask"], start)
        ones = np.bitwise_and.reduceat(low["bits"], start)
        some = np.bitwise_or.reduceat(low["bits"], start)
        mask = same_mask & ~(ones ^ some)
        levels.append({"mask": mask, "bits": ones & mask, "start": start, "end": np.append(start[1:], len(low["mask"])), "at": low["at"][start], "sizes": sizes})
    label = np.arange(n)
    root = np.arange(len(first))
    stack = [(len(levels) - 1, root, root, np.zeros(len(root), np.int64), np.zeros(len(root), np.uint64))]
    while stack:
        k, a, b, far, seen = stack.pop()
        if len(a) > PAIRS:
            stack += [(k, a[c : c + PAIRS], b[c : c + PAIRS], far[c : c + PAIRS], seen[c : c + PAIRS]) for c in range(0, len(a), PAIRS)]
            continue
        node = levels[k]
        both = node["mask"][a] & node["mask"][b]
        far = far + np.bitwise_count((node["bits"][a] ^ node["bits"][b]) & both & ~seen)
        fine = far <= bits
        a, b, far, both = a[fine], b[fine], far[fine], both[fine]
        if k == 0:
            _merge(label, a, b)
            continue
        lo, hi = np.minimum.reduceat(label, node["at"]), np.maximum.reduceat(label, node["at"])
        one = (lo[a] == hi[a]) & (lo[b] == hi[b]) & (lo[a] == lo[b])
        sure = ~one & (far + np.bitwise_count(~both) <= bits)
        if sure.any():
            stop = np.append(node["at"][1:], n)
            head = node["at"][a[sure]]
            for x in (a[sure], b[sure]):
                long = stop[x] - node["at"][x]
                leaf = np.arange(long.sum()) - np.repeat(np.cumsum(long) - long, long) + np.repeat(node["at"][x], long)
                _merge(label, np.repeat(head, long), leaf)
        more = ~one & ~sure
        a, b, far, both = a[more], b[more], far[more], both[more]
        na, nb = node["end"][a] - node["start"][a], node["end"][b] - node["start"][b]
        total = na * nb
        pair = np.repeat(np.arange(len(a)), total)
        inner = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
        x, y = node["start"][a][pair] + inner // nb[pair], node["start"][b][pair] + inner % nb[pair]
        keep = x <= y if k > 1 else x < y
        pair = pair[keep]
        if len(pair):
            stack.append((k - 1, x[keep], y[keep], far[pair], both[pair]))
    return label


def _masks(bits: int, depth: int) -> list[int]:
    """Fixed bits for each path of ``depth`` choices: every choice takes one of bits + 1 parts of the bits still free."""
    paths = [0]
    for _ in range(depth):
        grown = []
        for fixed in paths:
            free = [i for i in range(64) if not fixed >> i & 1]
            for part in np.array_split(free, bits + 1):
                grown.append(fixed | sum(1 << int(i) for i in part))
        paths = grown
    return paths


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_links(groups: DataFrame, bits: int = 4, most: int = 4096, deepest: int = 3) -> DataFrame:
    """(src, dst) edges that connect what the links at ``bits`` or fewer differing bits connect.

    ``groups(rep, fp)`` has distinct fingerprints.  Two fingerprints at ``bits`` differences
    agree on one of bits + 1 blocks (pigeonhole), so each block's value is a bucket with its own
    index.  A bucket of over ``most`` fingerprints is dealt anew by the same rule over the bits
    that are still free, up to ``deepest`` times, which splits hot buckets without losing a link.
    Every fingerprint sends one edge, to its bucket's root: pairs are never listed.
    """
    ready = None
    now = groups.select("rep", "fp", F.lit(0).alias("path"))
    for depth in range(1, deepest + 1):
        table = F.array(*[F.lit(_signed(m)).cast("long") for m in _masks(bits, depth)])
        part = F.explode(F.sequence(F.lit(0), F.lit(bits)))
        dealt = now.select("rep", "fp", "path", part.alias("part")).select("rep", "fp", (F.col("path") * (bits + 1) + F.col("part")).alias("path"))
        dealt = dealt.withColumn("key", F.col("fp").bitwiseAND(F.get(table, F.col("path"))))
        if depth == deepest:
            fine, hot = dealt, None
        else:
            many = materialize(dealt.groupBy("path", "key").agg(F.count("*").alias("n")).where(F.col("n") > most).select("path", "key"), "hot")
            hot = dealt.join(many, ["path", "key"], "left_semi") if many.take(1) else None
            fine = dealt.join(many, ["path", "key"], "left_anti") if hot is not None else dealt
        fine = fine.select("rep", "fp", F.xxhash64(F.lit(depth), "path", "key").alias("bucket"), F.lit(depth).alias("depth"), "path", "key")
        ready = fine if ready is None else ready.unionByName(fine)
        if hot is None:
            break
        now = hot.select("rep", "fp", "path")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def solve(rows: np.ndarray) -> pa.RecordBatch:
            fp = rows["fp"].view(np.uint64)
            ids = np.cumsum(np.concatenate(([0], (rows["d"][1:] != rows["d"][:-1]) | (rows["p"][1:] != rows["p"][:-1]) | (rows["k"][1:] != rows["k"][:-1]))))
            order = np.lexsort((gray_rank(fp), ids))
            root = linked(ids[order], fp[order], bits)
            rep = rows["rep"][order]
            own = root != np.arange(len(root))
            return pa.RecordBatch.from_arrays([pa.array(rep[own]), pa.array(rep[root[own]])], ["src", "dst"])

        size = 0
        for batch in batches:
            rows = np.empty(batch.num_rows, [("rep", np.int64), ("fp", np.int64), ("d", np.int32), ("p", np.int32), ("k", np.int64)])
            for name, column in zip(rows.dtype.names, batch.columns):
                rows[name] = column.to_numpy(zero_copy_only=False)
            held.append(rows)
            size += len(rows)
            if size >= 1 << 16:
                rows = np.concatenate(held)
                last = (rows["d"] != rows["d"][-1]) | (rows["p"] != rows["p"][-1]) | (rows["k"] != rows["k"][-1])
                cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0  # the last bucket may go on
                if cut:
                    yield solve(rows[:cut])
                held, size = [rows[cut:]], len(rows) - cut
        if size:
            yield solve(np.concatenate(held))

    dealt = ready.repartition("bucket").sortWithinPartitions("depth", "path", "key")
    return dealt.select("rep", "fp", "depth", "path", "key").mapInArrow(search, "src long, dst long")


def near_duplicates(docs: DataFrame, bits: int = 4, width: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp, component_id, n_same) for every row of ``docs(doc_id, text, ...)``.

    Documents whose fingerprints differ in ``bits`` or fewer bits are linked; ``component_id`` is
    the smallest doc_id that can be reached, itself included; ``n_same`` counts rows with the same
    fingerprint.  Null or wordless texts have fingerprint 0 and are linked like any other.  Rows
    with a null doc_id take part with their fingerprint's class but never name it (a class of
    such rows only has a null component).  Repeated rows come back as often as they came.
    """
    fps = materialize(fingerprints(docs.select(F.col("doc_id").cast("long"), "text"), width, seed), "fps")
    groups = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_same")), "fp-groups")
    links = fingerprint_links(groups.where("rep IS NOT NULL"), bits)
    classes = connected_components(links)
    named = groups.join(classes, groups["rep"] == classes["node"], "left").select("fp", "n_same", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(named, "fp").select("doc_id", "fp", "component_id", "n_same")


def drop_near_duplicates(docs: DataFrame, bits: int = 4, width: int = 4, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` that stay: of each class those with the smallest doc_id, and those without a doc_id.

    A row goes only if its own text is in the class: rows meet verdicts by doc_id and a hash of the text.
    """
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    near = near_duplicates(rows, bits, width, seed).select("fp", "component_id").distinct()
    row = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    fps = fingerprints(rows.select(F.struct("doc_id", row.alias("row")).alias("doc_id"), "text"), width, seed, "doc_id struct<doc_id: long, row: long>")
    gone = fps.join(near, "fp").where("doc_id.doc_id <> component_id").select(F.col("doc_id.doc_id").alias("_gone"), F.col("doc_id.row").alias("_row")).distinct()
    return docs.join(gone, (docs["doc_id"] == gone["_gone"]) & (row == gone["_row"]), "left_anti")
