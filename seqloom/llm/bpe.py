"""Byte-level BPE encoding and decoding: a segment tree over adjacent pair ranks."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct pre-tokens whose ids a task keeps; the cache starts anew when it is full.
CACHE = 400_000
#: A pre-token is a contraction, letters, digits or signs with the blank before them, or blanks.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
#: The same pattern for texts of ASCII and Latin-1 letters only; the standard library is faster there.
_LATIN_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^ \t-\r{_LATIN}0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"
#: Characters of texts that are split at a time, and the longest pre-token (in bytes) of a batched tree.
CHUNK = 500_000
WIDEST = 64
_NONE = np.int64(1 << 60)


def default_vocabulary() -> str:
    """The place of the public byte-level vocabulary of 50k entries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairTree:
    """A segment tree whose leaf i has the rank of the pair that begins at symbol i.

    Each node holds (rank, position) of the smallest rank below it, the leftmost among equals;
    the root is the next merge.  A merge changes three leaves, each updated up one path.
    """

    def __init__(self, symbols: list[int], rank: dict[tuple[int, int], tuple[int, int]]):
        self.rank, n = rank, len(symbols)
        self.symbol = symbols
        self.next = [*range(1, n), -1]
        self.prev = [*range(-1, n - 1)]
        self.size = 1 << max(1, n - 1).bit_length()
        none = self.none = (1 << 60, 0)
        leaves = [(rank[p][0], i) if (p := (symbols[i], symbols[i + 1])) in rank else none for i in range(n - 1)]
        self.node = [none] * self.size + leaves + [none] * (self.size - len(leaves))
        for i in range(self.size - 1, 0, -1):
            self.node[i] = min(self.node[2 * i], self.node[2 * i + 1])

    def _set(self, i: int) -> None:
        j = self.next[i]
        found = self.rank.get((self.symbol[i], self.symbol[j])) if j >= 0 and self.symbol[i] >= 0 else None
        at, node = i + self.size, self.node
        node[at] = (found[0], i) if found else self.none
        at >>= 1
        while at:
            low = min(node[2 * at], node[2 * at + 1])
            if node[at] == low:
                break
            node[at] = low
            at >>= 1

    def merge_all(self) -> list[int]:
        while self.node[1] != self.none:
            i = self.node[1][1]
            j = self.next[i]
            self.symbol[i] = self.rank[self.symbol[i], self.symbol[j]][1]
            self.symbol[j] = -1
            self.next[i] = k = self.next[j]
            if k >= 0:
                self.prev[k] = i
            self._set(j)
            self._set(i)
            if self.prev[i] >= 0:
                self._set(self.prev[i])
        return [s for s in self.symbol if s >= 0]


class Coder:
    """Encodes and decodes as the file's tokenizer does, without special tokens added."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        vocab = spec["model"]["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocab.items()}
        self.first = np.array([vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.rank = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(pairs)}
        keys = np.array([a << 32 | b for a, b in self.rank], np.int64)
        order = np.argsort(keys)
        self.keys, self.key_rank = keys[order], order.astype(np.int64)
        self.merged = np.array([m for _, m in self.rank.values()], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.any, self.latin = regex.compile(PRE_TOKEN).findall, re.compile(_LATIN_TOKEN).findall
        self.odd = re.compile(rf"[^\x00-\x7f{_LATIN}]").search
        self.cache: dict[str, bytes] = {}

    def _ranks(self, a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leaves (rank << 20 | position) of the pairs (a, b) at positions ``at``."""
        key = a << 32 | b
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[found] == key) & (a >= 0) & (b >= 0), self.key_rank[found] << 20 | at, _NONE)

    def _trees(self, tokens: list[bytes], width: int) -> list[bytes]:
        """The ids of pre-tokens of at most ``width`` bytes: one segment tree each, worked in step.

        A row of ``tree`` is a tree whose leaf i has the pair that begins at symbol i; its root is
        the leftmost merge of lowest rank.  A merge changes three leaves and their paths.
        """
        n = len(tokens)
        size = np.fromiter(map(len, tokens), np.int64, n)
        raw = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in tokens), np.uint8).reshape(n, width)
        place = np.arange(width)
        # Column `width` is the place beyond the last symbol.
        symbol = np.full((n, width + 1), -1, np.int64)
        symbol[:, :width] = np.where(place < size[:, None], self.first[raw], -1)
        after = np.minimum(np.arange(1, width + 2), width)[None].repeat(n, 0)
        before = np.maximum(np.arange(-1, width), -1)[None].repeat(n, 0)
        tree = np.full((n, 2 * width), _NONE)
        tree[:, width:] = self._ranks(symbol[:, :-1], symbol[:, 1:], place)
        step = width >> 1
        while step:
            tree[:, step : 2 * step] = np.minimum(tree[:, 2 * step : 4 * step : 2], tree[:, 2 * step + 1 : 4 * step : 2])
            step >>= 1
        row = np.flatnonzero(tree[:, 1] < _NONE)
        while len(row):
            top = tree[row, 1]
            i = top & 0xFFFFF
            j = after[row, i]
            k = after[row, j]
            p = before[row, i]
            symbol[row, i] = new = self.merged[top >> 20]
            symbol[row, j] = -1
            after[row, i] = k
            before[row, k] = i
            tree[row, width + j] = _NONE
            tree[row, width + i] = self._ranks(new, symbol[row, k], i)
            has = p >= 0
            tree[row[has], width + p[has]] = self._ranks(symbol[row[has], p[has]], new[has], p[has])
            for leaf in (j, i, np.where(has, p, i)):
                at = (leaf + width) >> 1
                while at[0]:
                    tree[row, at] = np.minimum(tree[row, 2 * at], tree[row, 2 * at + 1])
                    at = at >> 1
            row = row[tree[row, 1] < _NONE]
        kept = symbol[:, :width] >= 0
        flat = symbol[:, :width][kept].astype("<u4").tobytes()
        ends = (np.cumsum(kept.sum(axis=1)) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def packed(self, pre_tokens: list[str]) -> dict[str, bytes]:
        """The ids of pre-tokens as little-endian unsigned 32-bit integers."""
        out: dict[str, bytes] = {}
        by_width: dict[int, list[str]] = {}
        for p in pre_tokens:
            n = len(p.encode())
            if n > WIDEST:
                symbols = self.first[np.frombuffer(p.encode(), np.uint8)].tolist()
                out[p] = np.array(PairTree(symbols, self.rank).merge_all(), "<u4").tobytes()
            else:
                by_width.setdefault(max(2, 1 << (n - 1).bit_length()), []).append(p)
        for width, group in by_width.items():
            for at in range(0, len(group), 4096):
                part = group[at : at + 4096]
                out |= zip(part, self._trees([p.encode() for p in part], width))
        return out

    def pre_tokens(self, text: str) -> list[str]:
        """The pre-tokens of a text without special tokens."""
        return self.any(text) if self.odd(text) else self.latin(text)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """All ids of each text, packed.  Pre-tokens seen before come from the cache."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            split, size = [], 0
            while at < len(texts) and size < CHUNK:
                text = texts[at]
                parts = [text] if self.split is None or not any(s in text for s in self.special) else self.split.split(text)
                split.append([(p, None) if p in self.special and len(parts) > 1 else (None, self.pre_tokens(p)) for p in parts])
                size += len(text)
                at += 1
            cache = self.cache
            new = {t for parts in split for _, tokens in parts if tokens for t in tokens if t not in cache}
            if new:
                if len(cache) + len(new) > CACHE:
                    cache.clear()
                    new = {t for parts in split for _, tokens in parts if tokens for t in tokens}
                cache |= self.packed(list(new))
            for parts in split:
                out.append(b"".join(self.special[s].to_bytes(4, "little") if s is not None else b"".join(map(cache.__getitem__, tokens)) for s, tokens in parts))
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The text of packed ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    """One coder for each Python worker and vocabulary."""
    return Coder(path)


def _id_lists(packed: list[bytes]) -> pa.Array:
    """Packed ids as lists of integers."""
    offsets = [0]
    for p in packed:
        offsets.append(offsets[-1] + len(p) // 4)
    values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, pa.py_buffer(b"".join(packed))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``docs`` with a column ``ids`` (array<int>): the token ids of ``text``.  A narrow map; other columns pass through unread.

    Null and empty texts have no ids; rows with null or repeated doc_ids are encoded each by its own text; a column ``ids`` of
    ``docs`` is replaced; an empty table gives an empty table.  A very long text is encoded whole, in memory for its pre-tokens.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = _id_lists(code.encode_all([t or "" for t in part.column("text").to_pylist()]))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [*part.schema.names, "ids"])

    docs = docs.drop("ids")
    fields = docs.withColumn("ids", F.lit(None).cast("array<int>")).schema
    return docs.mapInArrow(run, fields)


def decode(tokens: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``tokens`` with a column ``decoded``, the text of its column ``ids``, special tokens included.

    Null ids count as empty; bytes that are no UTF-8 become U+FFFD; a column ``decoded`` of ``tokens`` is replaced, others pass
    through unread; an empty table gives an empty table.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for batch in batches:
            texts = []
            for ids in batch.column("ids"):
                values = ids.values
                texts.append(code.decode(values.to_numpy(zero_copy_only=False).astype("<i4").tobytes()) if values is not None else "")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    tokens = tokens.drop("decoded")
    return tokens.mapInArrow(run, tokens.withColumn("decoded", F.lit(None).cast("string")).schema)


def digests(docs: DataFrame, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]): each text encoded, and its ids decoded again, in one pass.

    The digests are of the ids as little-endian unsigned 32-bit integers and of the decoded text
    in UTF-8; ``with_ids`` hands the ids (array<int>) on, too.

    Null and empty texts have no tokens.  Rows with null or repeated doc_ids, and repeated rows, each have a row.  An empty table
    gives an empty table; extra columns, whatever their names, are not read.  A very long text is encoded whole, in memory for
    its pre-tokens.
    """
    path = vocabulary or default_vocabulary()
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 256 if with_ids else max(1, whole.num_rows)):
                batch = whole.slice(at, 256) if with_ids else whole
                n, ids, texts = [], [], []
                coded = code.encode_all([t or "" for t in batch.column(1).to_pylist()])
                for packed in coded:
                    n.append(len(packed) // 4)
                    ids.append(hashlib.sha256(packed).hexdigest())
                    texts.append(hashlib.sha256(code.decode(packed).encode("utf-8")).hexdigest())
                columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(texts)]
                yield pa.RecordBatch.from_arrays(columns + ([_id_lists(coded)] if with_ids else []), names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
