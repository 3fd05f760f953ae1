"""Decontamination, centroid clustering and cross-tokenizer alignment against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seqloom.llm import decontamination, token_alignment, va_clusters

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# --- decontamination ---------------------------------------------------------------------------


def contaminated_by_hand(texts, items):
    windows = defaultdict(set)
    for item, text in items:
        words = WORD.findall(ascii_lower(text or ""))
        for i in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[i : i + 10])].add("" if item is None else str(item))
    out = []
    for t in texts:
        words = WORD.findall(ascii_lower(t or ""))
        hit, found = set(), set()
        for w, names in windows.items():
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i : i + len(w)]) == w:
                    hit |= set(range(i, i + len(w)))
                    found |= names
        out.append((len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def planted(seed=1):
    r = random.Random(seed)
    vocab = ["ab", "É", "c1", "the", "x", "中文", "ÀB", "zz"]
    sentence = lambda n: [r.choice(vocab) for _ in range(n)]
    items = [(i, r.choice([" ", "-", ".\n"]).join(sentence(r.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(30)]
    items += [(None, "only null item here"), (5, "a second text of item five with more than ten words in all"), (99, None), (100, "--- ...")]
    texts = [" ".join(sentence(r.randint(0, 60))) for _ in range(60)]
    for i in range(40):
        lead, tail = sentence(r.randint(0, 9)), sentence(r.randint(0, 9))
        texts.append(" ".join(lead).upper() + "! " + (r.choice(items)[1] or "") + " ?" + " ".join(tail))
    return texts + [None, "", "   ", "ONLY null_ITEM here"], items


def frames(spark, texts, items):
    docs = spark.createDataFrame([(i, t, len(t or ""), "x") for i, t in enumerate(texts)], "doc_id long, text string, n_chars long, _hit string").repartition(3)
    return docs, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("limit", [200_000, 60])
def test_contamination_equals_brute_force(spark, limit):
    texts, items = planted()
    docs, bench = frames(spark, texts, items)
    want = contaminated_by_hand(texts, items)
    got = {r["doc_id"]: tuple(r)[1:] for r in decontamination.contamination(docs, bench, limit=limit).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert 20 < sum(w[-1] for w in want) < len(want)


def test_contamination_edges(spark):
    docs, bench = frames(spark, ["one two", "one two", None], [(1, "one two")])
    twice = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert sorted(r["n_hit"] for r in decontamination.contamination(twice, bench).collect()) == [0, 2, 2]
    assert decontamination.contamination(docs.limit(0), bench).count() == 0
    none = decontamination.contamination(docs, bench.limit(0)).collect()
    assert len(none) == 3 and not any(r["contaminated"] for r in none) and none[0]["items_sha256"] == sha("")
    long = "filler words " * 200_000 + "one two"
    row = decontamination.contamination(frames(spark, [long], [])[0], bench).first()
    assert (row["n_words"], row["n_hit"]) == (400_002, 2)


def test_decontaminate_removes_spans_or_documents(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    texts = [f"Keep this. {item.upper()}; keep that, too.", "alpha beta alone", None, item]
    docs, bench = frames(spark, texts, [(1, item)])
    spans = {r["doc_id"]: r for r in decontamination.decontaminate(docs, bench).collect()}
    assert [spans[i]["text"] for i in range(4)] == ["Keep this. ; keep that, too.", "alpha beta alone", None, ""]
    assert spans[0]["n_chars"] == 28 and spans[1]["n_chars"] == 16 and spans[0]["_hit"] == "x"
    kept = decontamination.decontaminate(docs, bench, remove="documents")
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2]
    half = decontamination.decontaminate(docs, bench, remove="documents", max_share=0.8)
    assert sorted(r["doc_id"] for r in half.collect()) == [0, 1, 2]
    with pytest.raises(ValueError, match="remove"):
        decontamination.decontaminate(docs, bench, remove="all")


# --- clustering ---------------------------------------------------------------------------------


def clusters_by_hand(rows, k, rounds, dim):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    ranked = sorted(kept, key=lambda r: (sha(f"2:{'' if r[0] is None else r[0]}"), r[1]))
    centroids = [v for _, v in ranked[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda v: min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[nearest(v)].append(v)
        centroids = [[sum(x) // len(members[c]) for x in zip(*members[c])] if members[c] else centroids[c] for c in range(len(centroids))]
    out = [(i, c := nearest(v), far(v, centroids[c])) for i, v in kept]
    sums = Counter()
    for _, c, d in out:
        sums[c] += d
    return Counter((i, c, d, sums[c], sum(sums.values()), sha(",".join(map(str, centroids[c])))) for i, c, d in out)


@pytest.mark.parametrize(("dim", "k", "seed"), [(8, 5, 1), (7, 9, 2), (1, 3, 3)])
def test_clusters_equal_brute_force(spark, dim, k, seed):
    r = random.Random(seed)
    rows = [(i, [r.choice([-1, 0, 2]) + r.gauss(0, 0.3) for _ in range(dim)]) for i in range(400)]
    rows += [(i, [0.5] * dim) for i in range(400, 480)] + [(None, [0.25] * dim), (3, [1.0] * dim), (3, [1.0] * dim)]
    odd = [(900, None), (901, [1.0] * (dim + 1)), (902, [float("nan")] * dim), (903, [float("inf")] * dim), (904, [None] * dim), (905, [])]
    frame = spark.createDataFrame([(*x, "e") for x in rows + odd], "vec_id long, embedding array<float>, cluster string").repartition(3)
    got = Counter(tuple(x) for x in va_clusters.cluster(frame, k, 3, dim).collect())
    assert got == clusters_by_hand(rows, k, 3, dim)


def test_clusters_of_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert va_clusters.cluster(spark.createDataFrame([], schema), 4, 2, 3).count() == 0
    rows = [(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0])]
    out = va_clusters.cluster(spark.createDataFrame([*rows, (3, [1e30, 0.0, 0.0])], schema), 4, 2, 3).collect()
    assert {(r["vec_id"], r["cluster"], r["distance"]) for r in out} == {(1, 0, 0), (2, 0, 0)}


def test_bounds_leave_most_vectors_unread():
    r = np.random.default_rng(1)
    centres = r.integers(-4000, 4000, (6, 16))
    v = (centres[r.integers(0, 6, 3000)] + r.integers(-300, 300, (3000, 16))).astype(np.int64)
    bounds = np.array([[v[:, d].min(), *np.quantile(v[:, d], np.arange(1, 16) / 16).astype(np.int64), v[:, d].max() + 1] for d in range(16)])
    cell = np.stack([np.searchsorted(b[1:-1], v[:, d], "right") for d, b in enumerate(bounds)], axis=1).astype(np.uint8)
    got, fetched = va_clusters.Bounds(bounds, centres).assign(cell[:, ::2] | cell[:, 1::2] << 4, v)
    assert (got == ((v[:, None, :] - centres) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert fetched < 600


# --- alignment ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(token_alignment.default_vocabulary())
    a.encode_special_tokens = True
    a.no_truncation()
    a.no_padding()
    return a, sentencepiece.SentencePieceProcessor(model_file=token_alignment.default_pieces())


def alignment_by_hand(tokenizers, texts):
    ta, sb = tokenizers
    letters = {c: b for c, b in __import__("seqloom.llm.bpe", fromlist=["_"])._byte_letters().items()}
    docs = []
    for t in texts:
        raw = (" " + (t or "")).encode()
        a = ta.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sb.encode(t) if t else []
        ab = [bytes(letters[c] for c in ta.id_to_token(i)) for i in a]
        bb = [bytes([int(sb.id_to_piece(i)[3:5], 16)]) if sb.is_byte(i) else sb.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or b"".join(ab) != raw or b"".join(bb) != raw:
            docs.append(([], [], []))
            continue
        ends = lambda parts: np.cumsum([len(x) for x in parts]).tolist()
        ea, eb = ends(ab), ends(bb)
        groups, links = [], []
        for end in sorted(set(ea) & set(eb)):
            begin = groups[-1][2] if groups else 0
            groups.append(([i for i, e in zip(a, ea) if begin < e <= end], [i for i, e in zip(b, eb) if begin < e <= end], end))
        for i, e in enumerate(ea):
            for j, f in enumerate(eb):
                if e - len(ab[i]) < f and f - len(bb[j]) < e:
                    links.append((a[i], b[j]))
        docs.append((a, b, groups, links))
    counts = Counter(p for d in docs if d[0] for p in set(d[3]))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for d in docs:
        if not d[0]:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = d
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y, _ in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), sha(text)))
    return out


ODD = [None, "", " ", "  ", "a▁b", "<s>x</s> <|endoftext|>", "\x00\n\t", "naïve café 中文 😀", "é", "x  y   z ", "　a\x85b\x1c", "<0x41>", "don't stop", " lead", "tail\n\n"]


@pytest.mark.parametrize("hot", [1 << 18, 3])
def test_alignment_equals_brute_force(spark, tokenizers, hot):
    r = random.Random(4)
    bits = ["the ", "thing", "eran", " on", "ing", "é", "中", "\n", "  ", "'s", "123", "XY", "😀", "tion", "\t", "."]
    texts = ODD + ["".join(r.choice(bits) for _ in range(r.randint(1, 50))) for _ in range(60)] + ["the thing eran"] * 5
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, row int").repartition(3)
    got = {x["doc_id"]: tuple(x)[1:] for x in token_alignment.token_alignment(docs, size=40, hot=hot).collect()}
    want = alignment_by_hand(tokenizers, texts)
    assert [got[i] for i in range(len(texts))] == want
    assert sum(w[3] for w in want) > sum(w[0] for w in want) > sum(w[2] for w in want)


def test_alignment_edges(spark):
    docs = spark.createDataFrame([(None, "same words"), (1, "same words"), (1, "same words"), (2, None)], "doc_id long, text string")
    rows = token_alignment.token_alignment(docs).collect()
    assert len(rows) == 4 and len({r["count_sum"] for r in rows if r["n_a"]}) == 1
    assert {r["count_sum"] for r in rows if r["n_a"]} == {3 * rows[[bool(r["n_a"]) for r in rows].index(True)]["n_links"]}
    assert token_alignment.token_alignment(docs.limit(0)).count() == 0


def test_long_texts_are_cut_without_effect(tokenizers):
    al = token_alignment.aligner(token_alignment.default_vocabulary(), token_alignment.default_pieces())
    r = random.Random(6)
    text = "".join(r.choice(["ab", " ", "  ", "\n ", "the", " on", "中", ". "]) for _ in range(3000))
    whole, cut = (token_alignment._align_texts(al, [text], n)[0] for n in (1 << 30, 50))
    assert (whole.n_a, whole.n_b, whole.n_groups, whole.n_links, whole.digest.hexdigest()) == (cut.n_a, cut.n_b, cut.n_groups, cut.n_links, cut.digest.hexdigest())
    assert len(al.pieces(text, 50)) > 50
