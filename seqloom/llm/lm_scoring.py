"""LM scoring: masked pseudo-likelihood of a bidirectional window network trained in numpy."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.common import discard, materialize

#: Places of the context, left and right of the word that is predicted.
CONTEXT = (-2, -1, 1, 2)
#: The first ids: beyond a text's ends, then words outside the vocabulary by their length in bytes (BY_LENGTH and more are one).
EDGE, BY_LENGTH = 0, 16
#: Words of a share of the corpus that one task trains on, whatever the layout of the table.
SHARE_WORDS = 4_000_000
#: Stands for "nothing yet" ahead of a word's first byte, and what is added to each count of bytes.
BEGIN, ADDED = 256, 0.1


@dataclass(frozen=True)
class Shape:
    """Sizes of the network.  A word has a class (id // members) and a place in it."""

    classes: int = 32
    members: int = 64
    hidden: int = 24

    @property
    def vocabulary(self) -> int:
        return self.classes * self.members


class Network:
    """Predicts each word from the two on either side: embeddings by place, one tanh layer, softmax over classes and in a class."""

    def __init__(self, shape: Shape, weights: list[np.ndarray] | None = None, seed: int = 42):
        self.shape = shape
        c, m, h = shape.classes, shape.members, shape.hidden
        sizes = [(len(CONTEXT), c * m, h), (h,), (h, c), (c,), (c, h, m), (c, m)]
        if weights is None:
            random = np.random.default_rng(seed)
            weights = [random.normal(0, 0.1, s).astype(np.float32) if len(s) > 1 else np.zeros(s, np.float32) for s in sizes]
        self.weights = weights
        self.squares: list[np.ndarray] | None = None

    @classmethod
    def unpacked(cls, shape: Shape, flat: np.ndarray) -> Network:
        net = cls(shape)
        at, out = 0, []
        for w in net.weights:
            out.append(flat[at : at + w.size].reshape(w.shape).astype(np.float32))
            at += w.size
        net.weights = out
        return net

    def packed(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights]).astype(np.float32)

    def _order(self, ids: np.ndarray) -> np.ndarray:
        """The stable order of ids; those of two bytes or less are sorted digit by digit, much faster than longs."""
        return np.argsort(ids.astype(np.min_scalar_type(self.shape.vocabulary - 1)), kind="stable")

    def _hidden(self, context: np.ndarray) -> np.ndarray:
        table, bias = self.weights[:2]
        total = bias + np.take(table[0], context[:, 0], axis=0)
        for k in range(1, len(CONTEXT)):
            total += np.take(table[k], context[:, k], axis=0)
        return np.tanh(total, out=total)

    @staticmethod
    def _softmax(hid: np.ndarray, weight: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """Probabilities with a column for each row of ``hid``: a maximum or a sum down columns takes many of them at a time."""
        x = weight.T @ hid.T
        x += bias[:, None]
        x -= x.max(axis=0)
        np.exp(x, out=x)
        x /= x.sum(axis=0)
        return x

    def log_probs(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The natural log-probability of each target given both sides."""
        # In the order of targets each class is a slice.
        order = self._order(target)
        hid = self._hidden(np.take(context, order, axis=0))
        _, _, wc, bc, wm, bm = self.weights
        group, place = np.divmod(target[order], self.shape.members)
        found = np.log(self._softmax(hid, wc, bc)[group, np.arange(len(group))] + 1e-30)
        ends = np.searchsorted(group, np.arange(self.shape.classes + 1))
        for c in range(self.shape.classes):
            rows = slice(ends[c], ends[c + 1])
            if ends[c] < ends[c + 1]:
                p = self._softmax(hid[rows], wm[c], bm[c])
                found[rows] += np.log(p[place[rows], np.arange(p.shape[1])] + 1e-30)
        out = np.empty_like(found)
        out[order] = found
        return out

    def _descend(self, k: int, at, gradient: np.ndarray, rate: float) -> None:
        """An AdaGrad step of weight ``k`` at the index ``at``."""
        if self.squares is None:
            self.squares = [np.full(w.shape, 1e-6, np.float32) for w in self.weights]
        self.squares[k][at] += gradient * gradient
        self.weights[k][at] -= np.float32(rate) * gradient / np.sqrt(self.squares[k][at])

    def step(self, context: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One step on a batch."""
        table, bias, wc, bc, wm, bm = self.weights
        n = len(target)
        order = self._order(target)  # each class is a slice
        context, target = np.take(context, order, axis=0), target[order]
        hid = self._hidden(context)
        group, place = np.divmod(target, self.shape.members)
        error = self._softmax(hid, wc, bc)
        error[group, np.arange(n)] -= 1
        error *= np.float32(1 / n)
        back = error.T @ wc.T
        self._descend(2, ..., (error @ hid).T, rate)
        self._descend(3, ..., error.sum(axis=1), rate)
        ends = np.searchsorted(group, np.arange(self.shape.classes + 1))
        for c in range(self.shape.classes):
            rows = slice(ends[c], ends[c + 1])
            if ends[c] < ends[c + 1]:
                e = self._softmax(hid[rows], wm[c], bm[c])
                e[place[rows], np.arange(e.shape[1])] -= 1
                e *= np.float32(1 / n)
                back[rows] += e.T @ wm[c].T
                self._descend(4, c, (e @ hid[rows]).T, rate)
                self._descend(5, c, e.sum(axis=1), rate)
        hid *= hid
        back *= np.subtract(1, hid, out=hid)
        self._descend(1, ..., back.sum(axis=0), rate)
        sides = back.T.astype(np.float64)
        for k in range(len(CONTEXT)):
            # Sums by context word, one dimension at a time; a word that is not there has a gradient of 0, which changes nothing.
            words = np.ascontiguousarray(context[:, k])
            sums = np.stack([np.bincount(words, side, self.shape.vocabulary) for side in sides], axis=1)
            self._descend(0, k, sums.astype(np.float32), rate)


def _ids(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """Ids of words; outside the vocabulary a word goes by its length."""
    ids = np.fromiter(map(known.get, words, repeat(EDGE)), np.int64, len(words))
    rare = np.flatnonzero(ids == EDGE)
    ids[rare] = np.minimum(np.fromiter((len(words[i]) for i in rare.tolist()), np.int64, len(rare)), BY_LENGTH)
    return ids


def _contexts(ids: np.ndarray) -> np.ndarray:
    """The ids around each place, EDGE beyond the ends."""
    n, reach = len(ids), max(CONTEXT)
    wide = np.concatenate((np.full(reach, EDGE), ids, np.full(reach, EDGE)))
    return np.stack([wide[reach + k : reach + k + n] for k in CONTEXT], axis=1)


class Spelling:
    """The probability of a word outside the vocabulary, given its length class: each byte by the one ahead of it.

    ``counts`` has a row for each byte ahead (BEGIN for none).  Words of BY_LENGTH bytes or more stop after each further byte with
    one probability.  So the words of a class have probabilities that add up to 1.
    """

    def __init__(self, counts: np.ndarray, words: int, stops: int):
        self.log = np.log((counts + ADDED) / (counts + ADDED).sum(axis=1, keepdims=True))
        stop = (words + 1) / (words + stops + 2)
        self.stop, self.go_on = np.log(stop), np.log(1 - stop)

    @staticmethod
    def pairs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(byte ahead, byte, length of each word) of all words, one behind the other."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        ahead = np.concatenate(([BEGIN], flat[:-1])) if len(flat) else flat
        ahead[np.cumsum(size) - size] = BEGIN
        return ahead, flat, size

    def log_probs(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.empty(0)
        ahead, flat, size = self.pairs(words)
        out = np.add.reduceat(self.log[ahead, flat], np.cumsum(size) - size)
        return out + np.where(size >= BY_LENGTH, self.stop + (size - BY_LENGTH) * self.go_on, 0.0)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of all texts, written: tasks send their own counts and Spark adds them up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                found: Counter[bytes] = Counter()
                for text in batch.column(0).slice(at, 2048).cast(pa.binary()).to_pylist():
                    found.update((text or b"").split())
                yield pa.RecordBatch.from_arrays([pa.array(list(found.keys()), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

    counts = docs.select(F.col("text").cast("string")).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return materialize(counts, "word-counts")


def vocabulary(counts: DataFrame, size: int) -> dict[bytes, int]:
    """The ``size`` most frequent words of ``counts(word, n)``, ties by the word itself, as ids after the fixed ones.

    The top words of 64 shares of the words are found first, so that what reaches the driver doesn't
    grow with the number of tasks.
    """
    share = Window.partitionBy("share").orderBy(F.desc("n"), "word")
    best = counts.withColumn("share", F.pmod(F.xxhash64("word"), F.lit(64))).withColumn("place", F.row_number().over(share)).where(F.col("place") <= size)
    top = best.select("word", "n").orderBy(F.desc("n"), "word").limit(size).collect()
    return {bytes(r["word"]): 1 + BY_LENGTH + i for i, r in enumerate(top)}


def spelling(counts: DataFrame, known: dict[bytes, int]) -> Spelling:
    """How words outside the vocabulary are spelt, from every such word as often as it stands; a number for each pair of bytes reaches the driver."""
    shared = counts.sparkSession.sparkContext.broadcast(known)
    cells = (BEGIN + 1) * 256

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = shared.value, np.zeros(cells + 2, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 100_000):
                words, n = batch.column(0).slice(at, 100_000).to_pylist(), batch.column(1).slice(at, 100_000).to_numpy()
                left = [w not in known for w in words]
                ahead, flat, size = Spelling.pairs(list(compress(words, left)))
                n = n[np.array(left, bool)]
                np.add.at(sums, ahead * 256 + flat, np.repeat(n, size))
                long = size >= BY_LENGTH
                sums[cells] += n[long].sum()
                sums[cells + 1] += (n * (size - BY_LENGTH))[long].sum()
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["at", "n"])

    sums = np.zeros(cells + 2)
    for r in counts.mapInArrow(add, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        sums[r["at"]] = r["n"]
    return Spelling(sums[:cells].reshape(-1, 256), int(sums[cells]), int(sums[cells + 1]))


@dataclass
class Model:
    """A trained scorer."""

    shape: Shape
    known: dict[bytes, int]
    flat: np.ndarray
    spelling: Spelling = field(default_factory=lambda: Spelling(np.zeros((BEGIN + 1, 256)), 0, 0))
    #: Words of the corpus, and how many of them are outside the vocabulary.
    words: int = 0
    outside: int = 0


def train(docs: DataFrame, shape: Shape = Shape(), rounds: int = 1, batch: int = 16_384, rate: float = 0.1, seed: int = 42, share_words: int = SHARE_WORDS) -> Model:
    """Train on every document: each task descends on its own rows, and the weights are averaged by their targets.

    In a round every word of every text is a target once, predicted from both sides.  A task sends its
    weights in a few blocks; Spark adds the blocks up; the averaged network, whose size is fixed, starts the next round.

    Rows are dealt to shares of about ``share_words`` words by a hash of doc_id and text, and stand in each in the order of this hash; so
    the model, and with it every score, doesn't depend on how the table is split into files or tasks.

    Null and empty texts teach nothing; an empty table gives the network as it starts; very long
    texts are learnt in parts; rows with null or repeated doc_ids count like others, repeated rows as often as they stand; only
    ``doc_id`` and ``text`` are read.
    """
    counts = word_counts(docs)
    known = vocabulary(counts, shape.vocabulary - 1 - BY_LENGTH)
    spelt = spelling(counts, known)
    words = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    inside = counts.join(F.broadcast(docs.sparkSession.createDataFrame([(w,) for w in known], "word binary")), "word", "left_semi")  # one vocabulary
    outside = words - inside.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    discard(counts)
    context = docs.sparkSession.sparkContext
    flat = Network(shape, seed=seed).packed()
    block = 16_384
    place = F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    dealt = docs.select(F.col("text").cast("string").alias("text"), place.alias("place")).where("text IS NOT NULL")
    texts = dealt.repartition(max(1, -(-words // share_words)), "place").sortWithinPartitions("place", "text").select("text")
    for _ in range(rounds):
        shared = context.broadcast((known, flat))  # fixed size: the vocabulary and one network

        def descend(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            words, start = shared.value
            share = TaskContext.get().partitionId()
            net = Network.unpacked(shape, start)
            held: list[tuple[np.ndarray, np.ndarray]] = []
            size, total = 0, 0

            def learn() -> None:
                around = np.concatenate([h[0] for h in held])
                target = np.concatenate([h[1] for h in held])
                mixed = np.random.default_rng(seed).permutation(len(target))
                for at in range(0, len(target), batch):
                    pick = mixed[at : at + batch]
                    net.step(np.take(around, pick, axis=0), target[pick], rate)

            for rows in batches:
                for text in rows.column(0).cast(pa.binary()):
                    ids = _ids((text.as_py() or b"").split(), words)
                    if len(ids):
                        held.append((_contexts(ids), ids))
                        size += len(ids)
                    if size >= 8 * batch:
                        learn()
                        total, held, size = total + size, [], 0
            if size:
                learn()
                total += size
            if total:
                out = net.packed().astype(np.float64) * total
                for k in range(0, len(out), block):
                    yield pa.RecordBatch.from_arrays([pa.array([k // block], pa.int32()), pa.array([share], pa.int32()), pa.array([total], pa.int64()), pa.array([out[k : k + block].astype(np.float32).tobytes()], pa.binary())], ["block", "share", "n", "w"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, tuple[int, np.ndarray]] = {}
            for rows in batches:
                for k, _, n, w in zip(*(c.to_pylist() for c in rows.columns)):
                    w = np.frombuffer(w, np.float32).astype(np.float64)
                    before = sums.get(k, (0, 0.0))
                    sums[k] = (before[0] + n, before[1] + w)
            for k, (n, w) in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([n], pa.int64()), pa.array([(w / n).astype(np.float32).tobytes()], pa.binary())], ["block", "n", "w"])

        sent = texts.mapInArrow(descend, "block int, share int, n long, w binary")
        # Added up in the order of shares, as sums of floats depend on it.
        parts = sent.repartition("block").sortWithinPartitions("block", "share").mapInArrow(add, "block int, n long, w binary").collect()  # one network
        if parts:
            flat = np.concatenate([np.frombuffer(r["w"], np.float32) for r in sorted(parts, key=lambda r: r["block"])])
        shared.unpersist()
    return Model(shape, known, flat, spelt, words, outside)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, log_prob, mean_log_prob): the summed conditional log-probabilities of all words of each text.

    A word outside the vocabulary has the probability of its length class, given both sides, times that of its spelling in
    the class.  Null or wordless texts have 0 tokens, log_prob 0 and a null mean; rows with null and repeated doc_ids each have a
    row; an empty table gives an empty table; other columns are not read; very long texts are scored in parts.  A narrow map.
    """
    shape = model.shape
    shared = docs.sparkSession.sparkContext.broadcast((model.known, model.flat, model.spelling))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, flat, spelt = shared.value
        net = Network.unpacked(shape, flat)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            at = 0
            while at < len(texts):
                lists, size, begin, rare = [], 0, at, []
                while at < len(texts) and size < 1 << 15:
                    words = (texts[at].as_py() or b"").split()
                    lists.append(_ids(words, known))
                    rare += compress(words, (lists[-1] <= BY_LENGTH).tolist())
                    size += len(words)
                    at += 1
                around = np.concatenate([_contexts(x) for x in lists])
                target = np.concatenate(lists)
                probs = np.concatenate([net.log_probs(around[k : k + (1 << 15)], target[k : k + (1 << 15)]) for k in range(0, max(1, len(target)), 1 << 15)]).astype(np.float64)
                probs[target <= BY_LENGTH] += spelt.log_probs(rare)
                ends = np.cumsum([len(x) for x in lists])
                upto = np.concatenate(([0.0], np.cumsum(probs)))
                total = upto[ends] - upto[np.concatenate(([0], ends[:-1]))]
                n = [len(x) for x in lists]
                mean = [t / k if k else None for t, k in zip(total.tolist(), n)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, at - begin), pa.array(n, pa.int64()), pa.array(total), pa.array(mean, pa.float64())], ["doc_id", "n_tokens", "log_prob", "mean_log_prob"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, log_prob double, mean_log_prob double")
