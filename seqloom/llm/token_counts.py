"""Edit-aware token counts: segment trees over pre-tokens."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.bpe import CHUNK, Coder, coder, default_vocabulary

#: Pre-tokens of a leaf when the tree is built, and characters before an edit that can change how
#: the text ahead of it is split (a special token may begin there).
LEAF, CONTEXT = 32, 16

#: (start, end, replacement) of an edit, in characters of the text before any edit.
Edit = tuple[int, int, str]


def pieces(code: Coder, text: str) -> list[str]:
    """The pre-tokens of a text, special tokens among them."""
    if code.split is None or not any(s in text for s in code.special):
        return code.pre_tokens(text)
    out: list[str] = []
    for part in code.split.split(text):
        out += [part] if part in code.special else code.pre_tokens(part)
    return out


def count_pieces(code: Coder, lists: list[list[str]]) -> list[list[int]]:
    """The token count of each pre-token; new ones are encoded in one batch."""
    new = {p for tokens in lists for p in tokens if p not in code.cache}
    known = code.packed([p for p in new if p not in code.special]) | {p: b"\0" * 4 for p in new if p in code.special}
    if len(code.cache) + len(known) < 400_000:
        code.cache |= {p: b for p, b in known.items() if p not in code.special}
    else:
        for tokens in lists:
            for p in tokens:
                if p in code.cache:
                    known[p] = code.cache[p]
        code.cache.clear()
    get, rest = known.get, code.cache.get
    return [[len(get(p) or rest(p)) // 4 for p in tokens] for tokens in lists]


class CountTree:
    """A document's pre-tokens in leaves of a segment tree; each node has the characters and tokens below it.

    A leaf has the text of its pre-tokens, so an edit reads and writes only the leaves that it touches.
    """

    def __init__(self, text: str, sizes: list[int], counts: list[int]):
        self.leaves = [(sizes[i : i + LEAF], counts[i : i + LEAF]) for i in range(0, len(sizes), LEAF)] or [([], [])]
        self.width = 1 << max(0, len(self.leaves) - 1).bit_length()
        self.sums = [(0, 0)] * (2 * self.width)
        self.parts, at = [], 0
        for i, (s, c) in enumerate(self.leaves):
            self.sums[self.width + i] = (sum(s), sum(c))
            self.parts.append(text[at : at + self.sums[self.width + i][0]])
            at += len(self.parts[-1])
        for i in range(self.width - 1, 0, -1):
            (a, b), (c, d) = self.sums[2 * i], self.sums[2 * i + 1]
            self.sums[i] = (a + c, b + d)
        self.encoded = 0

    @property
    def text(self) -> str:
        """The document as it stands."""
        return "".join(self.parts)

    @property
    def total(self) -> int:
        """Tokens of the document as it stands."""
        return self.sums[1][1]

    def _leaf_at(self, char: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds ``char``; the last leaf for the text's end."""
        node, start = 1, 0
        while node < self.width:
            left = self.sums[2 * node][0]
            if char < start + left or self.sums[2 * node + 1][0] == 0:
                node = 2 * node
            else:
                start, node = start + left, 2 * node + 1
        return min(node - self.width, len(self.leaves) - 1), start

    def _update(self, leaf: int) -> None:
        node = self.width + leaf
        sizes, counts = self.leaves[leaf]
        self.sums[node] = (sum(sizes), sum(counts))
        while node > 1:
            node >>= 1
            (a, b), (c, d) = self.sums[2 * node], self.sums[2 * node + 1]
            self.sums[node] = (a + c, b + d)

    def edit(self, start: int, end: int, new: str, code: Coder) -> None:
        """Replace characters [start, end) by ``new``.

        Splitting goes on from a boundary by the text ahead alone, so it begins anew at the last
        boundary CONTEXT characters ahead of the edit, and stops where a boundary after the edit
        falls on an old one: from there on nothing changes.
        """
        shift = len(new) - (end - start)
        length = self.sums[1][0] + shift
        leaf, low = self._leaf_at(max(0, start - CONTEXT))
        at = low
        # The old text from the leaf's first character on, as far as it is needed.
        near, following = self.parts[leaf], leaf + 1
        sizes, counts = self.leaves[leaf]
        skip = 0
        while skip < len(sizes) and at + sizes[skip] <= start - CONTEXT:
            at += sizes[skip]
            skip += 1
        # Old boundaries at or after the edit, read leaf by leaf as they are needed.
        last, taken, old = leaf, skip, at
        reach = 64
        while True:
            stop = min(length, start + len(new) + reach)
            upto = stop - shift + (2 * CONTEXT if stop < length else 0)
            more = [near]
            have = len(near)
            while low + have < max(upto, end) and following < len(self.parts):
                more.append(self.parts[following])
                have += len(more[-1])
                following += 1
            near = "".join(more)
            fresh = pieces(code, near[at - low : start - low] + new + near[end - low : upto - low])
            pos, used = at, 0
            last, taken, old = leaf, skip, at
            found = stop == length
            for used, p in enumerate(fresh, 1):
                pos += len(p)
                if stop < length and pos > stop:
                    break
                if pos < start + len(new):
                    continue
                while old + shift < pos or old < end:
                    if taken == len(self.leaves[last][0]):
                        if last + 1 == len(self.leaves):
                            break
                        last, taken = last + 1, 0
                        continue
                    old += self.leaves[last][0][taken]
                    taken += 1
                if old + shift == pos and old >= end and (pos > start + len(new) or pos == length):
                    found = True
                    break
            if found:
                break
            reach *= 4
        fresh = fresh[:used] if stop < length or pos < length else fresh
        if pos == length:  # everything up to the end is new
            last, taken = len(self.leaves) - 1, len(self.leaves[-1][0])
        tail = (self.leaves[last][0][taken:], self.leaves[last][1][taken:])
        tail_text = self.parts[last][sum(self.leaves[last][0][:taken]) :]
        self.parts[leaf] = self.parts[leaf][: at - low] + "".join(fresh)
        number = count_pieces(code, [fresh])[0]
        self.encoded += len(fresh)
        self.leaves[leaf] = (sizes[:skip] + list(map(len, fresh)), counts[:skip] + number)
        if last == leaf:
            self.leaves[leaf] = (self.leaves[leaf][0] + tail[0], self.leaves[leaf][1] + tail[1])
            self.parts[leaf] += tail_text
        else:
            for k in range(leaf + 1, last):
                self.leaves[k], self.parts[k] = ([], []), ""
                self._update(k)
            self.leaves[last], self.parts[last] = tail, tail_text
            self._update(last)
        self._update(leaf)

    def edit_all(self, edits: list[Edit], code: Coder) -> None:
        """Edits of the text as it was, without overlap; later ones first, so that places stay right."""
        for start, end, new in sorted(edits, reverse=True):
            self.edit(start, end, new, code)


#: A stored tree: the document's text and, for each pre-token, its characters and tokens.
_TREE = "text string, sizes array<int>, counts array<int>, n_tokens long"


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK characters."""
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and size < CHUNK:
            size += len(texts[upto])
            upto += 1
        yield at, upto
        at = upto


def build_trees(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, text, sizes, counts, n_tokens) for every row of ``docs(doc_id, text, ...)``: trees to be kept in a table, for ``edit_trees``.

    A narrow map, memory for one chunk of texts.  Null text counts as empty; rows with null or repeated doc_ids each have a
    tree; extra columns are not read; an empty table gives an empty table.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for at, upto in _chunks(texts):
                split = [pieces(code, t) for t in texts[at:upto]]
                counts = count_pieces(code, split)
                columns = [pa.array(texts[at:upto], pa.string()), pa.array([list(map(len, p)) for p in split], pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32())), pa.array([sum(c) for c in counts], pa.int64())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, upto - at), *columns], ["doc_id", "text", "sizes", "counts", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, f"doc_id long, {_TREE}")


def edit_trees(trees: DataFrame, edits: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``trees`` after ``edits(doc_id, start, end, new)``, with ``n_encoded_again``: the pre-tokens that were encoded anew.

    Edits are in characters of the stored text, without overlap inside a document; those past its end are cut to it, null
    ``new`` deletes, and edits of unknown or null doc_ids are left out.  Documents without edits pass as they are.  A document's
    edits meet in one row; the trees are joined with those rows, and no text is encoded but around edits.
    """
    path = vocabulary or default_vocabulary()
    e = edits.where("doc_id IS NOT NULL AND start IS NOT NULL AND end IS NOT NULL")
    per = e.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.sort_array(F.collect_list(F.struct(F.col("start").cast("long").alias("a"), F.col("end").cast("long").alias("b"), F.coalesce("new", F.lit("")).alias("new")))).alias("_edits"))
    joined = trees.join(per, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "text", "sizes", "counts", "n_tokens", "_edits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                columns = [c.to_pylist() for c in part.columns]
                again = [0] * part.num_rows
                for i, changes in enumerate(columns[5]):
                    if changes:
                        tree = CountTree(columns[1][i], columns[2][i], columns[3][i])
                        n = tree.sums[1][0]
                        tree.edit_all([(min(c["a"], n), min(c["b"], n), c["new"]) for c in changes], code)
                        columns[1][i], columns[4][i], again[i] = tree.text, tree.total, tree.encoded
                        columns[2][i] = [x for leaf, _ in tree.leaves for x in leaf]
                        columns[3][i] = [x for _, leaf in tree.leaves for x in leaf]
                lists = pa.list_(pa.int32())
                new = [pa.array(columns[1], pa.string()), pa.array(columns[2], lists), pa.array(columns[3], lists), pa.array(columns[4], pa.int64()), pa.array(again, pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column(0), *new], ["doc_id", "text", "sizes", "counts", "n_tokens", "n_encoded_again"])

    return joined.mapInArrow(run, f"doc_id long, {_TREE}, n_encoded_again long")


def pattern_edits(pattern: str, new: str) -> Callable[[str], list[Edit]]:
    """Edits that put ``new`` for each match of ``pattern``."""
    find = re.compile(pattern).finditer
    return lambda text: [(m.start(), m.end(), new) for m in find(text)]


#: E-mail addresses, web addresses and long numbers.
PRIVATE = r"[\w.+-]+@[\w-]+\.[\w.-]+|https?://\S+|\+?\d[\d ().-]{7,}\d"


def count_with_edits(docs: DataFrame, edits_of: Callable[[str], list[Edit]], vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_tokens_before, n_tokens, n_edits, n_pre_tokens, n_encoded_again) for every row of ``docs(doc_id, text, ...)``.

    Each document's tree is built once; edits then touch only their own regions.  A narrow map:
    no shuffle, and memory for one chunk of texts.  Null and empty texts have no tokens; edits past a text's
    end are cut to it.  Rows with null or repeated doc_ids, and repeated rows, each have a row; an empty table gives an empty
    table; extra columns, whatever their names, are not read; a very long text is a chunk of its own.  See ``build_trees`` for
    trees that are kept.
    """
    path = vocabulary or default_vocabulary()
    schema = "doc_id long, n_tokens_before long, n_tokens long, n_edits long, n_pre_tokens long, n_encoded_again long"
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = [t or "" for t in texts]
            for at, upto in _chunks(texts):
                chunk = texts[at:upto]
                split = [pieces(code, t) for t in chunk]
                rows = []
                for id_, text, tokens, counts in zip(ids[at:upto], chunk, split, count_pieces(code, split)):
                    edits = [(min(a, len(text)), min(b, len(text)), new) for a, b, new in edits_of(text)]
                    before = sum(counts)
                    after, again = before, 0
                    if edits:
                        tree = CountTree(text, list(map(len, tokens)), counts)
                        tree.edit_all(edits, code)
                        after, again = tree.total, tree.encoded
                    rows.append((id_, before, after, len(edits), len(tokens), again))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
