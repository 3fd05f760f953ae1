"""Near-dedup by shingle similarity: MinHash bands find pairs, their exact Jaccard similarity decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import connected_components, materialize
from seqloom.llm.simhash import _LOWER, fingerprint, fingerprint_links

#: Bands of a signature and minima in a band: at similarity 0.8 a pair misses all bands once in 8 million.
BANDS, ROWS = 40, 5
#: Rounds in which a bucket's members are compared with a centre and by their differences from it.
CENTRES = 2

_FACTOR = np.random.default_rng(11).integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)
_MIX = np.random.default_rng(13).integers(0, 1 << 64, (BANDS, ROWS), np.uint64) | np.uint64(1)


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """The different 64-bit hashes of a text's ``width``-word shingles, in order; of a shorter text the one of all its words."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b]) for a, b in zip(starts[:n].tolist(), ends[min(width, len(words)) - 1 :].tolist())), np.uint64, n))


def node_of(hashes: np.ndarray) -> int:
    """The name of a set of shingles."""
    return xxhash.xxh64_intdigest(hashes.tobytes())


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each band of the set's MinHash signature."""
    low = np.full(BANDS * ROWS, ~np.uint64(0))
    for at in range(0, len(hashes), 512):
        x = hashes[at : at + 512, None] * _FACTOR
        np.minimum(low, (x ^ x >> np.uint64(32)).min(axis=0), out=low)
    x = ((low.reshape(BANDS, ROWS) >> np.uint64(7)) * _MIX).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
    x = (x ^ x >> np.uint64(31)) * _FACTOR[0]
    return x ^ x >> np.uint64(29)


def _judge(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs(src, dst)`` whose sets have a Jaccard similarity of ``similarity`` or more."""
    both = pairs.join(sets.select(F.col("node").alias("src"), F.col("s").alias("x")), "src").join(sets.select(F.col("node").alias("dst"), F.col("s").alias("y")), "dst")
    total = F.size("x") + F.size("y")
    possible = F.least(F.size("x"), F.size("y")) >= similarity * F.greatest(F.size("x"), F.size("y")) - 1e-9
    return both.where(possible).where(F.size(F.array_intersect("x", "y")) * (1 + similarity) >= similarity * total - 1e-9).select("src", "dst")


def _differences(family: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``family(centre, node, c, inside)`` with ``d``, how many shingles one of node and centre has alone; ``u``, ``d`` less the
    node's share of what a link allows; and ``shared``, those of the ``d`` that another of the centre's nodes has too, rarest first.
    """
    both = family.join(sets.select("node", F.col("s").alias("x")), "node").join(sets.select(F.col("node").alias("centre"), F.col("s").alias("y")), "centre")
    alone = F.concat(F.array_except("x", "y"), F.array_except("y", "x"))
    rate = (1 - similarity) / (1 + similarity)
    apart = materialize(both.select("centre", "node", "c", "inside", F.size("x").alias("size"), alone.alias("alone")), "similar-apart")
    rows = apart.select("centre", "node", F.explode("alone").alias("e"))
    often = rows.groupBy("centre", "e").agg(F.count("*").alias("n")).where("n > 1")
    shared = rows.join(often, ["centre", "e"]).groupBy("centre", "node").agg(F.array_sort(F.collect_list(F.struct("n", "e"))).alias("shared"))
    d = F.size("alone")
    return apart.select("centre", "node", "c", "inside", d.alias("d"), (d - rate * F.col("size")).alias("u")).join(shared, ["centre", "node"])


def _met_by_differences(apart: DataFrame, last: bool) -> DataFrame:
    """The pairs (src, dst) of a family that may be linked: of one inside and one outside, and if ``last`` of two outside.

    x and y differ in ``d(x) + d(y) - 2 * common`` shingles, ``common`` being those in the differences of both; so a link
    needs ``common >= (u(x) + u(y)) / 2``.  Nodes outside aren't linked to the centre, which has the least u of all, so this is over
    zero.  Two sets with that many elements in common share one of their rarest ``d - common + 1`` (prefix filter): nodes
    meet by an equal element there.  Most differences are a node's own, and such elements are rarest and meet nothing.
    """
    least = apart.groupBy("centre").agg(F.min(F.when(F.col("inside"), F.col("u"))).alias("in_u"), F.min(F.when(~F.col("inside"), F.col("u"))).alias("out_u"))
    rows = apart.join(least, "centre")

    def rarest(side: DataFrame, other: str) -> DataFrame:
        common = F.greatest(F.lit(1), F.ceil((F.col("u") + F.col(other)) / 2 - 1e-6).cast("int"))
        private = F.col("d") - F.size("shared")
        most = F.greatest(F.lit(0), F.col("d") - common + 1 - private)
        return side.select("centre", "node", "c", "u", F.explode(F.slice("shared", F.lit(1), most)["e"]).alias("e"))

    outside = rows.where(~F.col("inside"))
    sides = [(rarest(outside.where("in_u IS NOT NULL"), "in_u"), rarest(rows.where("inside AND out_u IS NOT NULL"), "out_u"), "c <> other_c")]
    if last:  # the one with the smaller u needs u elements in common at least
        sides.append((rarest(outside, "u"), rarest(outside, "out_u"), "c <> other_c AND (u < other_u OR u = other_u AND node < other)"))
    found = None
    for one, two, unlike in sides:
        met = one.join(two.select("centre", "e", F.col("node").alias("other"), F.col("c").alias("other_c"), F.col("u").alias("other_u")), ["centre", "e"]).where(unlike)
        pairs = met.select(F.least("node", "other").alias("src"), F.greatest("node", "other").alias("dst"))
        found = pairs if found is None else found.unionByName(pairs)
    return found.distinct()


def similarity_links(nodes: DataFrame, sets: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """(node, component) of what ``known(src, dst)`` and the pairs of a bucket at ``similarity`` or more connect.

    ``nodes(node, size, keys)`` has band keys; nodes with an equal key share a bucket.  In each of CENTRES rounds the members of a
    bucket are compared with its centre, the member that meets most others over all its buckets, as a text from which
    copies were made does.  Of the rest, links to what is connected with the centre come from differences (see
    ``_met_by_differences``), and what is outside goes to the next round; in the last round links among
    those come from differences too.  So no link is left out, and no bucket's pairs are listed.
    """
    dealt = nodes.select("node", "size", F.explode("keys").alias("key"))
    shared = materialize(dealt.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "similar-shared")
    met = materialize(dealt.join(shared, "key"), "similar-met")
    score = met.groupBy("node").agg(F.sum("n").alias("score"))
    left = materialize(met.join(score, "node").select("key", "node", "size", "score"), "similar-left")
    edges = materialize(known, "similar-edges")

    def placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        found = materialize(connected_components(edges), "similar-found")
        named = found.select(F.col("node").alias("node_"), "component")
        return found, materialize(rows.join(named, F.col("node") == F.col("node_"), "left").withColumn("c", F.coalesce("component", "node")).drop("node_", "component"), "similar-placed")

    def joined(found: DataFrame, pairs: DataFrame) -> DataFrame:
        return materialize(found.select(F.col("node").alias("src"), F.col("component").alias("dst")).unionByName(_judge(pairs, sets, similarity)), "similar-edges")

    for turn in range(CENTRES):
        found, now = placed(left)
        best = F.max(F.struct("score", F.xxhash64("node").alias("h"), "node", "c", "size")).alias("m")
        centres = now.groupBy("key").agg(best, F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high")
        centres = materialize(centres.select("key", F.col("m.node").alias("centre"), F.col("m.c").alias("centre_c"), F.col("m.size").alias("centre_size")), "similar-centres")
        if centres.isEmpty():
            return found
        possible = F.least("size", "centre_size") >= similarity * F.greatest("size", "centre_size") - 1e-9
        pairs = now.join(centres, "key").where((F.col("c") != F.col("centre_c")) & possible)
        edges = joined(found, pairs.select(F.least("node", "centre").alias("src"), F.greatest("node", "centre").alias("dst")).distinct())
        found, now = placed(now.drop("c").join(centres.select("key", "centre"), "key"))
        within = F.max(F.when(F.col("node") == F.col("centre"), F.col("c"))).alias("centre_c")
        unlike = materialize(now.groupBy("key").agg(within, F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("key", "centre_c"), "similar-open")
        if unlike.isEmpty():
            return found
        now = materialize(now.join(unlike, "key").withColumn("inside", F.col("c") == F.col("centre_c")), "similar-now")
        family = now.where("node <> centre").select("centre", "node", "c", "inside").distinct()
        apart = materialize(_differences(family, sets, similarity), "similar-differences")
        edges = joined(found, _met_by_differences(apart, turn == CENTRES - 1))
        left = now.where("NOT inside").select("key", "node", "size", "score")
    return connected_components(edges)


def drop_similar(docs: DataFrame, similarity: float = 0.8, width: int = 5, bits: int = 4) -> DataFrame:
    """The rows of ``docs(doc_id, text, ...)`` that stay: of each group the one with the smallest doc_id.

    Two texts are linked if the Jaccard similarity of their different ``width``-word shingles
    (A-Z in lower case) is ``similarity`` or more, or if their SimHashes of such shingles differ in ``bits``
    or fewer bits.  Pairs by similarity come from MinHash bands and are checked exactly, by 64-bit hashes.

    Rows are told apart by doc_id and a hash of the text.  Rows with a null doc_id stay.
    """
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    row = F.xxhash64(F.coalesce("text", F.lit("")))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            sets = [shingles(t, width) for t in texts]
            node = np.array([node_of(s) for s in sets], np.uint64).view(np.int64)
            fp = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
            keys = pa.array([band_keys(s).view(np.int64) if len(s) else [] for s in sets], pa.list_(pa.int64()))
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(node), sizes, pa.array(fp), keys], ["doc_id", "row", "node", "size", "fp", "keys"])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, width) for t in batch.column(0).cast(pa.binary()).to_pylist()]
            node = np.array([node_of(s) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "s"])

    marks = materialize(rows.select("doc_id", row.alias("row"), "text").mapInArrow(mark, "doc_id long, row long, node long, size long, fp long, keys array<long>"), "similar-marks")
    nodes = materialize(marks.groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("size").alias("size"), F.first("keys").alias("keys")), "similar-nodes")
    # Only nodes that share a key need their sets.
    dealt = nodes.select("node", "rep", F.explode("keys").alias("key"))
    again = materialize(dealt.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "similar-again")
    wanted = materialize(dealt.join(again, "key").select("rep", "node").distinct(), "similar-wanted")
    fetched = rows.join(wanted.select(F.col("rep").alias("doc_id")).distinct(), "doc_id").select("text").mapInArrow(take, "node long, s array<long>")
    sets = materialize(fetched.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "similar-sets")
    groups = materialize(marks.groupBy("fp").agg(F.min("node").alias("rep")), "similar-fps")
    equal = marks.join(groups, "fp").where("node <> rep").select(F.col("node").alias("src"), F.col("rep").alias("dst"))
    known = fingerprint_links(groups, bits).unionByName(equal).distinct()
    classes = materialize(similarity_links(nodes, sets, known, similarity).distinct(), "similar-classes").withColumnRenamed("node", "node_")
    named = materialize(nodes.join(classes, nodes["node"] == classes["node_"], "left").select("node", "rep", F.coalesce("component", "node").alias("c")), "similar-named")
    keep = materialize(named.groupBy("c").agg(F.min("rep").alias("keep")), "similar-keep")
    stays = named.join(keep, "c").select("node", "keep")
    gone = marks.join(stays, "node").where("doc_id <> keep").select(F.col("doc_id").alias("_gone"), F.col("row").alias("_row")).distinct()
    return docs.join(gone, (docs["doc_id"] == gone["_gone"]) & (row == gone["_row"]), "left_anti")
