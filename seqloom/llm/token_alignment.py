"""Cross-tokenizer alignment: tokens of two vocabularies over the same bytes, and how often their ids are linked."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.bpe import Coder, default_vocabulary
from seqloom.llm.common import discard, materialize

#: Characters of text that a task aligns together; longer texts are cut there, where both tokenizers have a border.
PIECE = 500_000
#: Pairs of ids whose counts every task knows; a pair in the part of all rows that one of these has, or more, is one of them.
HOT = 1 << 18
#: Pairs that a task adds up before it sends their counts.
GATHER = 2_000_000
_BLANK = "▁"
#: A space between two other characters: no pre-token of A and no piece of B has it inside (see ``Aligner``).
_BORDER = re.compile(r"(?<=\S)(?= \S)")


def default_pieces() -> str:
    """The place of the public vocabulary of 32k pieces with byte fallback."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Aligner:
    """Ids of both tokenizers with their bytes, and the precomputed array from an A id to the B id of the same bytes."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = Coder(a_path)
        self.a.split, self.a.special = None, {}  # special tokens' strings inside texts are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        byte = [self.b.is_byte(i) for i in range(n)]
        self.a_bytes = [self.a.bytes_of.get(i, b"") for i in range(max(self.a.bytes_of) + 1)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if byte[i] else p.replace(_BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # Bytes that both a piece and a byte stand for are the piece's; control tokens stand for none.
        usable = [i for i in range(n) if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i))]
        of_bytes = {self.b_bytes[i]: i for i in sorted(usable, key=lambda i: not byte[i])}
        self.same = np.array([of_bytes.get(x, -1) if x else -1 for x in self.a_bytes], np.int64)
        # Texts may be cut ahead of a blank only if no piece goes across such a place.
        self.cuts = not any(re.search(f"[^{_BLANK}]{_BLANK}", p) for i, p in enumerate(pieces) if not byte[i])
        # Each id as text, with the sign behind it: inside its side of a group, or at that side's end.
        self.signs = [f"{i}{s}".encode() for i in range(len(self.a_bytes)) for s in ",|"] + [f"{i}{s}".encode() for i in range(n) for s in ",;"]

    def pieces(self, text: str, size: int) -> list[str]:
        """Space and text, cut to parts of about ``size`` characters at places where no token of either goes across."""
        whole = " " + text
        if len(whole) <= size or not self.cuts:
            return [whole]
        out, at = [], 0
        while at < len(whole):
            border = _BORDER.search(whole, at + size) if at + size < len(whole) else None
            end = border.start() if border else len(whole)
            out.append(whole[at:end])
            at = end
        return out

    def align(self, wholes: list[str]) -> dict[str, np.ndarray]:
        """Tokens, groups and links of parts that begin with a space.

        ``fine`` tells parts whose bytes both tokenizers keep; the others have no tokens.  The parts' bytes stand one behind the
        other, and a group ends where an A and a B token end.  ``link_*`` has a row for each pair of tokens with a common byte.
        """
        packed = self.a.encode_all(wholes)
        pieces = self.b.encode([w[1:] for w in wholes], num_threads=1)
        fine = np.zeros(len(wholes), bool)
        ids_a, ids_b = [], []
        for i, (whole, p, b) in enumerate(zip(wholes, packed, pieces)):
            a = memoryview(p).cast("I").tolist() if p else []
            raw = whole.encode()
            fine[i] = len(whole) > 1 and b"".join(map(self.a_bytes.__getitem__, a)) == raw and b"".join(map(self.b_bytes.__getitem__, b)) == raw
            ids_a.append(np.array(a if fine[i] else [], np.int64))
            ids_b.append(np.array(b if fine[i] else [], np.int64))
        n_a, n_b = np.array([len(x) for x in ids_a]), np.array([len(x) for x in ids_b])
        a, b = np.concatenate(ids_a), np.concatenate(ids_b)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        both = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(both, a_end), np.searchsorted(both, b_end)
        # The B tokens that an A token meets: from the one over its first byte to the one over its last.
        first = np.searchsorted(b_end, a_end - self.a_size[a], "right")
        met = np.searchsorted(b_end, a_end) - first + 1
        link_a = np.repeat(np.arange(len(a)), met)
        link_b = np.arange(len(link_a)) - np.repeat(np.cumsum(met) - met, met) + np.repeat(first, met)
        return {"fine": fine, "n_a": n_a, "n_b": n_b, "a": a, "b": b, "a_group": a_group, "b_group": b_group, "link_a": link_a, "link_b": link_b, "groups": len(both)}

    def group_text(self, r: dict[str, np.ndarray]) -> list[bytes]:
        """Each token of ``r`` with the sign behind it, in the order of groups, A tokens first."""
        a_last = np.append(r["a_group"][1:] != r["a_group"][:-1], True)[: len(r["a"])]
        b_last = np.append(r["b_group"][1:] != r["b_group"][:-1], True)[: len(r["b"])]
        b_ahead = np.searchsorted(r["b_group"], r["a_group"])
        a_ahead = np.searchsorted(r["a_group"], r["b_group"], "right")
        out = np.empty(len(r["a"]) + len(r["b"]), np.int64)
        out[np.arange(len(r["a"])) + b_ahead] = r["a"] * 2 + a_last
        out[np.arange(len(r["b"])) + a_ahead] = r["b"] * 2 + b_last + 2 * len(self.a_bytes)
        return list(map(self.signs.__getitem__, out.tolist()))


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner for each Python worker."""
    return Aligner(a_path, b_path)


class _Document:
    """What the parts of one document add up to."""

    def __init__(self) -> None:
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.digest, self.open, self.fine = hashlib.sha256(), False, True
        self.same: list[tuple[np.ndarray, np.ndarray]] = []
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []


def _sum_by(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys of several parts, and their summed counts."""
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def _count_by(doc: np.ndarray, key: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, counts) of each document, one behind the other, and where each document's begin; ``key`` fits 31 bits."""
    both, n = np.unique(doc << 32 | key, return_counts=True)
    return both & 0xFFFFFFFF, n, np.searchsorted(both >> 32, np.arange(n_docs + 1))


def _align_texts(al: Aligner, texts: list[str | None], size: int) -> list[_Document]:
    docs = [_Document() for _ in texts]
    jobs = [(i, p) for i, t in enumerate(texts) if t for p in al.pieces(t, size)]
    at = 0
    while at < len(jobs):
        part, total = [], 0
        while at < len(jobs) and (not part or total + len(jobs[at][1]) <= size):
            part.append(jobs[at])
            total += len(jobs[at][1])
            at += 1
        r = al.align([p for _, p in part])
        piece_a, piece_b = np.repeat(np.arange(len(part)), r["n_a"]), np.repeat(np.arange(len(part)), r["n_b"])
        words = al.group_text(r)
        groups = np.bincount(piece_a[np.flatnonzero(np.diff(r["a_group"], prepend=-1))], minlength=len(part)) if len(r["a"]) else np.zeros(len(part), int)
        piece = piece_a[r["link_a"]]
        a, b = r["a"][r["link_a"]], r["b"][r["link_b"]]
        same = al.same[a] == b
        same_ids, same_n, same_at = _count_by(piece[same], a[same], len(part))
        pair_ids, pair_n, pair_at = _count_by(piece[~same], a[~same] * len(al.b_bytes) + b[~same], len(part))
        links = np.bincount(piece, minlength=len(part))
        ends = np.concatenate([[0], np.cumsum(r["n_a"] + r["n_b"])])
        for k, (i, _) in enumerate(part):
            d = docs[i]
            d.fine = d.fine and bool(r["fine"][k])
            if not d.fine:
                continue
            d.n_a += int(r["n_a"][k])
            d.n_b += int(r["n_b"][k])
            d.n_groups += int(groups[k])
            d.n_links += int(links[k])
            # The last token's ';' is held back until another part follows.
            raw = b"".join(words[ends[k] : ends[k + 1]])
            d.digest.update((b";" if d.open else b"") + raw[:-1])
            d.open = True
            d.same.append((same_ids[same_at[k] : same_at[k + 1]], same_n[same_at[k] : same_at[k + 1]]))
            d.pairs.append((pair_ids[pair_at[k] : pair_at[k + 1]], pair_n[pair_at[k] : pair_at[k + 1]]))
    return docs


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


#: A document's counts, and its different pairs of ids with how many links each has: pairs of the same bytes by their A id.
_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, same array<int>, same_n array<int>, pairs array<long>, pairs_n array<int>"


def aligned_documents(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, size: int = PIECE) -> DataFrame:
    """A row for each document with its counts, the digest of its groups, and its pairs of linked ids; a narrow map."""
    a_path, b_path = a_path or default_vocabulary(), b_path or default_pieces()
    names = [c.split()[0] for c in _ALIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(a_path, b_path)
        none = _Document()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [d if d.fine else none for d in _align_texts(al, part.column(1).to_pylist(), size)]
                same, pairs = [_sum_by(d.same) for d in found], [_sum_by(d.pairs) for d in found]
                counts = [pa.array([getattr(d, n) for d in found], pa.int64()) for n in names[1:5]]
                digest = pa.array([d.digest.hexdigest() if d.open else "" for d in found])
                lists = [_lists([k for k, _ in same], pa.int32()), _lists([n for _, n in same], pa.int32()), _lists([k for k, _ in pairs], pa.int64()), _lists([n for _, n in pairs], pa.int32())]
                yield pa.RecordBatch.from_arrays([part.column(0), *counts, digest, *lists], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _ALIGNED)


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def pair_documents(table: DataFrame, n_a: int, n_b: int) -> tuple[np.ndarray, DataFrame]:
    """(documents of each A id linked with the B id of the same bytes, ``(pair, n)``: documents of each other pair).

    The first is added up in one vector a task, as long as the vocabulary.  Other pairs are counted by task, in parts, ahead
    of the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector, held, size = np.zeros(n_a, np.int64), [], 0

        def send() -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.int64),) * 2
            return pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])

        for batch in batches:
            vector += np.bincount(_flat(batch.column(0)), minlength=n_a)
            held.append(_flat(batch.column(1)))
            size += len(held[-1])
            if size >= GATHER:
                yield send()
                held, size = [], 0
        yield send()
        ids = np.flatnonzero(vector)
        # Ids below 0 are those of the vector.
        yield pa.RecordBatch.from_arrays([pa.array(-1 - ids), pa.array(vector[ids])], ["pair", "n"])

    counts = materialize(table.select("same", "pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    same = np.zeros(n_a, np.int64)
    for r in counts.where("pair < 0").collect():  # one row an A id at most
        same[-1 - r["pair"]] = r["n"]
    return same, counts.where("pair >= 0")


def token_alignment(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, size: int = PIECE, hot: int = HOT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): a row for each row of ``docs(doc_id, text, ...)``.

    Space and text are encoded by A (byte-level BPE) and the text by B (pieces with byte fallback), without special tokens.
    Byte offsets where tokens of both end cut them into groups; tokens with a common byte are linked.  An id
    pair's count is how many documents hold it linked.  ``n_best`` are links whose count is the highest of their A id,
    ``count_sum`` adds the counts of all links.

    Most groups are one A token and the B token of the same bytes: a precomputed array names it, and their counts are one
    vector.  Only other pairs are shuffled, counted by task first.  Counts come back in two ways, together exact: a pair
    in ``rows / hot`` documents' rows or more is among the ``hot`` commonest at most and known to every task; the others, none of
    which is common, are joined.

    Texts that are null or empty, or that a tokenizer doesn't keep byte by byte (U+2581 inside), have no tokens: zeros and ''.
    Rows with null or repeated doc_ids are documents of their own; an empty table gives an empty result; extra columns are not
    read.  Texts of over ``size`` characters are cut at blanks, where neither tokenizer has a token across, so memory is bounded
    unless a text has no blanks.
    """
    al = aligner(a_path or default_vocabulary(), b_path or default_pieces())
    n_a, n_b = len(al.a_bytes), len(al.b_bytes)
    row = F.monotonically_increasing_id()
    table = materialize(aligned_documents(docs, a_path, b_path, size).withColumn("row", row), "aligned")
    same, counts = pair_documents(table, n_a, n_b)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    common = total // hot + 1
    best = same.copy()
    for r in counts.groupBy(F.floor(F.col("pair") / n_b).alias("a")).agg(F.max("n").alias("n")).collect():  # one row an A id at most
        best[r["a"]] = max(best[r["a"]], r["n"])
    known = counts.where(F.col("n") >= common).orderBy("pair").collect()  # no more than ``hot``, as their counts add up to no more than ``total``
    shared = docs.sparkSession.sparkContext.broadcast((same, best, np.array([r["pair"] for r in known], np.int64), np.array([r["n"] for r in known], np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same, best, pairs, counts = shared.value
        for batch in batches:
            ids, ids_n, other, other_n = (_flat(batch.column(i)).astype(np.int64) for i in range(1, 5))
            row_same = np.repeat(np.arange(batch.num_rows), batch.column(1).value_lengths().to_numpy())
            row_other = np.repeat(np.arange(batch.num_rows), batch.column(3).value_lengths().to_numpy())
            place = np.minimum(np.searchsorted(pairs, other), max(0, len(pairs) - 1))
            hit = pairs[place] == other if len(pairs) else np.zeros(len(other), bool)
            n = np.where(hit, counts[place], 0) if len(pairs) else np.zeros(len(other), np.int64)
            best_n, sums = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(sums, row_same, same[ids] * ids_n)
            np.add.at(sums, row_other, n * other_n)
            np.add.at(best_n, row_same, np.where(same[ids] == best[ids], ids_n, 0))
            np.add.at(best_n, row_other, np.where(hit & (n == best[other // n_b]), other_n, 0))
            left = np.flatnonzero(~hit)
            ends = np.searchsorted(row_other[left], np.arange(batch.num_rows + 1)).astype(np.int32)
            rest = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[left], pa.int64())) for x in (other, other_n, best[other // n_b])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best_n), pa.array(sums), *rest], ["row", "n_best", "count_sum", "pair", "m", "best"])

    columns = table.select("row", "same", "same_n", "pairs", "pairs_n")
    partial = materialize(columns.mapInArrow(run, "row long, n_best long, count_sum long, pair array<long>, m array<long>, best array<long>"), "alignment-known")
    rare = partial.select("row", F.inline(F.arrays_zip("pair", "m", "best"))).join(counts.where(F.col("n") < common), "pair")
    sums = rare.groupBy("row").agg(F.sum(F.col("n") * F.col("m")).alias("s"), F.sum(F.when(F.col("n") == F.col("best"), F.col("m")).otherwise(0)).alias("b"))
    head = table.drop("same", "same_n", "pairs", "pairs_n").join(partial.select("row", "n_best", "count_sum"), "row").join(sums, "row", "left")
    added = {"n_best": "b", "count_sum": "s"}
    return head.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *[(F.col(c) + F.coalesce(x, F.lit(0))).alias(c) for c, x in added.items()], "groups_sha256")
