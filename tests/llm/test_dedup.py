"""Exact, near, substring and byte dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from seqloom.llm import exact_dedup, fragments, rlz, similar, simhash, suffix_dedup
from seqloom.llm.common import ascii_lower, connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, texts, schema=SCHEMA):
    return spark.createDataFrame([(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)], schema).repartition(4)


def corpus(seed=1, n=60):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(80)]
    passage = " ".join(r.choice(words) for _ in range(40))
    out = []
    for k in range(n):
        t = [r.choice(words) for _ in range(r.randint(0, 120))]
        if k % 4 == 0:
            t[len(t) // 2 : len(t) // 2] = passage.split()[: r.randint(5, 40)]
        out.append((" " if k % 3 else "\n").join(t))
    out += [out[3], out[3].upper(), out[8] + " tail", out[8], "", None, "x", "ab" * 400, "-" * 350, "zz " * 90, passage * 2]
    return out


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def test_ascii_lower(spark):
    texts = ["ABC é É", "İstanbul Σ", "Ⅰ Ⓐ ǅ", "plain", ""]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(ascii_lower(F.col("t"))).collect()]
    assert got == [lower(t) for t in texts]


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("digest", [exact_dedup.sha256_of, lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 1).cast("string")) if False else F.encode(F.substring(F.sha2(t, 256), 1, 1), "UTF-8")])
def test_exact_dedup(spark, keep, digest):
    """Also with a digest of one character, where unlike texts collide."""
    texts = corpus()
    groups: dict[str, list[int]] = {}
    for i, t in enumerate(texts):
        groups.setdefault(lower(t or ""), []).append(i)
    want = {(i, (min if keep == "smallest" else max)(g), len(g)) for g in groups.values() for i in g}
    got = exact_dedup.exact_duplicates(frame(spark, texts), keep, digest).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in got} == want and len(got) == len(texts)
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got)


def test_drop_exact_keeps_columns(spark):
    docs = frame(spark, corpus()).withColumn("digest", F.lit(1)).withColumn("t", F.lit(2)).withColumn("kept", F.lit(3))
    out = exact_dedup.drop_exact_duplicates(docs)
    assert out.columns == docs.columns and out.count() == len({lower(t or "") for t in corpus()})


def brute_fingerprint(t):
    words = WORD.findall(lower(t or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_simhash_against_brute_force(spark):
    texts = corpus(2, 40)
    base = " ".join(f"word{i}" for i in range(300))
    texts += [base] + [base.replace(f"word{k} ", f"other{k} ") for k in range(0, 60, 3)]
    fps = [brute_fingerprint(t) for t in texts]
    want = brute_components(len(texts), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    got = simhash.near_duplicates(frame(spark, texts)).collect()
    assert {(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got} == set(zip(range(len(texts)), fps, want))
    assert len({w for w in want}) < len(texts)
    assert simhash.drop_near_duplicates(frame(spark, texts)).count() == len(set(want))


@pytest.mark.parametrize("most", [3, 4096])
def test_hot_buckets_lose_no_link(spark, most):
    r = random.Random(4)
    centre = r.getrandbits(64)
    fps = sorted({centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5))) for _ in range(150)} | {r.getrandbits(64) for _ in range(50)} | {0})
    rows = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)], "rep long, fp long")
    got = {r["node"]: r["component"] for r in connected_components(simhash.fingerprint_links(rows, 4, most)).collect()}
    want = brute_components(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    assert [got.get(i, i) for i in range(len(fps))] == want


def test_index_links_exactly():
    r = np.random.default_rng(0)
    for trial in range(30):
        fp = np.unique(r.integers(0, 1 << 64, 5, np.uint64)[r.integers(0, 5, 80)] ^ (np.uint64(1) << r.integers(0, 64, 80, np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 80, np.uint64)))
        fp = fp[np.argsort(simhash.gray_rank(fp))]
        got = simhash.linked(np.zeros(len(fp), np.int64), fp, trial % 5)
        want = brute_components(len(fp), [(i, j) for i in range(len(fp)) for j in range(i) if int(fp[i] ^ fp[j]).bit_count() <= trial % 5])
        assert got.tolist() == want


def brute_bytes(texts, length):
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            if w in seen:
                gone[i : i + length] = [True] * length
            seen.add(w)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return out


def brute_words(texts, length):
    seen, out = {}, []
    for t in texts:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        own = [tuple(w[i : i + length]) for i in range(len(w) - length + 1)]
        for i, g in enumerate(own):
            if g in seen:
                gone[i : i + length] = [True] * length
        seen.update(dict.fromkeys(own))
        out.append((len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return out


@pytest.mark.parametrize(("length", "wide"), [(100, 1000), (24, 2)])
def test_suffix_dedup(spark, monkeypatch, length, wide):
    monkeypatch.setattr(fragments, "WIDE", wide)
    texts = corpus(3)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.remove_repeated_bytes(frame(spark, texts), length).collect()}
    assert [got[i] for i in range(len(texts))] == brute_bytes(texts, length)
    assert sum(g[1] for g in got.values()) > 500


@pytest.mark.parametrize(("length", "wide"), [(13, 1000), (5, 2)])
def test_substring_dedup(spark, monkeypatch, length, wide):
    monkeypatch.setattr(fragments, "WIDE", wide)
    texts = corpus(5)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rlz.remove_repeated_words(frame(spark, texts), length).collect()}
    assert [got[i] for i in range(len(texts))] == brute_words(texts, length)


@pytest.mark.parametrize(("length", "wide"), [(13, 1000), (5, 2)])
def test_substring_dedup_beside_long_words(spark, monkeypatch, length, wide):
    """A very long word changes no other word's hash, so passages are found across documents with and without one."""
    monkeypatch.setattr(fragments, "WIDE", wide)
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    passage = [word() for _ in range(40)]
    texts = [" ".join([word() for _ in range(20)] + passage + [word() for _ in range(20)]) for _ in range(12)]
    texts[5] += " " + "x" * 4096
    texts[6] = "y" * 5000 + " " + texts[6]
    texts[7] = " ".join(passage[:20] + ["z" * 4095, "z" * 5000] + passage[20:])
    texts[8] = texts[7] + " tail"
    got = {x["doc_id"]: (x["n_words"], x["n_removed"], x["kept_sha256"]) for x in rlz.remove_repeated_words(frame(spark, texts), length).collect()}
    assert [got[i] for i in range(len(texts))] == brute_words(texts, length)


def test_word_hash_depends_on_the_word_alone():
    read = fragments.Units("words", 2, 1).read
    alone = fragments.word_hashes(*read(b"one two three"))
    beside = fragments.word_hashes(*read(b"one two three " + b"x" * 5000 + b" one"))
    assert beside[:3].tolist() == alone.tolist() and beside[4] == alone[0] and len(set(beside.tolist())) == 4


def test_bucket_indexes():
    r = random.Random(3)
    for _ in range(100):
        n = r.choice([3, 5, 8])
        parts = [bytes(r.choice(b"ab") for _ in range(r.randint(n, 25))) for _ in range(r.randint(1, 12))]
        ids, starts = np.array([r.randint(0, 5) for _ in parts]), np.array([100 * i for i in range(len(parts))])
        counts = np.array([len(p) - n + 1 for p in parts])
        places = [(ids[i], starts[i] + k, parts[i][k : k + n]) for i in range(len(parts)) for k in range(counts[i])]
        least: dict = {}
        for a, b, w in places:
            least[w] = min(least.get(w, (99, 0)), (a, b))
        assert suffix_dedup.earlier_windows(n)(parts, ids, starts, counts).tolist() == [(a, b) > least[w] for a, b, w in places]
        words = [" ".join(chr(c) for c in p) for p in parts]
        first: dict = {}
        for a, _, w in places:
            first[w] = min(first.get(w, 99), a)
        assert rlz.factored_windows(n, r.choice([3, 9, 32]))([w.encode() for w in words], ids, starts, counts).tolist() == [a > first[w] for a, _, w in places]


@pytest.mark.parametrize("wide", [1000, 2])
@pytest.mark.parametrize("kind", ["bytes", "words"])
def test_no_text_loses_what_another_lost(spark, monkeypatch, kind, wide):
    """Null ids, one id with several texts, repeated rows: kept bytes and words against brute force, row by row."""
    monkeypatch.setattr(fragments, "WIDE", wide)
    texts = corpus(9, 30)
    own = [" ".join(f"{tag}{i}" for i in range(60)) for tag in ("b", "c", "e")]
    rows = [(1, texts[0]), (None, texts[0]), (None, own[0]), (5, texts[0]), (5, own[1]), (5, own[2] + " " + texts[4]), (7, own[1]), (7, own[1]), (8, None), (None, None), (9, "")]
    rows += [(20 + i, t) for i, t in enumerate(texts)] + [(None, texts[8]), (None, texts[8]), (3, texts[8]), (3, texts[12])]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).repartition(4)
    twin = {(x["id"], x["text"] or ""): x["twin"] for x in fragments.rows_of(docs).collect()}
    order = sorted({(fragments.NO_ID if i is None else i, t or "") for i, t in rows}, key=lambda p: (p[0], twin[p]))
    if kind == "bytes":
        brute = brute_bytes([t for _, t in order], 100)
        got = [(x["doc_id"], (x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"])) for x in suffix_dedup.remove_repeated_bytes(docs).collect()]
    else:
        brute = brute_words([t for _, t in order], 13)
        got = [(x["doc_id"], (x["n_words"], x["n_removed"], x["kept_sha256"])) for x in rlz.remove_repeated_words(docs).collect()]
    want = dict(zip(order, brute))
    key = lambda p: (p[0] is None, p[0] or 0, p[1])
    assert sorted(got, key=key) == sorted([(i, want[fragments.NO_ID if i is None else i, t or ""]) for i, t in rows], key=key)
    assert any(g == (None, want[fragments.NO_ID, own[0]]) and g[1][1] == 0 for g in got)


@pytest.mark.parametrize("run", [lambda d: exact_dedup.exact_duplicates(d), lambda d: simhash.near_duplicates(d), lambda d: suffix_dedup.remove_repeated_bytes(d), lambda d: rlz.remove_repeated_words(d)])
def test_edges(spark, run):
    """Empty tables, null ids, repeated rows, extra columns with clashing names."""
    extra = {c: F.lit("x") for c in ("id", "h", "g", "fp", "start", "digest", "component_id", "ids")}
    assert run(spark.createDataFrame([], SCHEMA)).count() == 0
    long = "word " * 300
    rows = [(None, long, None, None, None), (7, long, "en", "s", 1), (7, long, "en", "s", 1), (8, None, None, None, None), (9, "", None, None, 0), (None, None, None, None, None)]
    assert run(spark.createDataFrame(rows, SCHEMA).withColumns(extra)).count() == len(rows)


def test_pipeline_drops_near_copies(spark):
    """Pairs at 0.8 and more go, unlike ones stay, also in a chain and with repeated and null ids."""
    import corpus_pipeline

    r = random.Random(14)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    texts = []
    for k in range(30):
        base = [word() for _ in range(150)]
        texts.append(" ".join(base))
        for step in range(k % 4):
            for at in r.sample(range(150), r.choice([1, 2, 3, 4])):
                base[at] = word()
            texts.append(" ".join(base))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(146)} for t in texts]
    fps = [simhash.fingerprint(t.encode(), 5) for t in texts]
    alike = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) or (fps[i] ^ fps[j]).bit_count() <= 4
    want = set(brute_components(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if alike(i, j)]))
    more = [(None, texts[0], None, None, 0), (0, " ".join(word() for _ in range(150)), None, None, 0)]
    docs = frame(spark, texts).unionByName(spark.createDataFrame(more, SCHEMA))
    got = sorted((x["doc_id"] is None, x["doc_id"] or 0, x["text"]) for x in corpus_pipeline.simhash_stage(spark, docs, "").collect())
    assert got == sorted([(False, i, texts[i]) for i in want] + [(x[0] is None, x[0] or 0, x[1]) for x in more])
    assert 30 <= len(want) < len(texts) - 20
    assert corpus_pipeline.simhash_stage(spark, frame(spark, []), "").count() == 0


def test_similar_families_against_all_pairs(spark):
    """A text with many copies that are unlike each other, copies too far from it with copies of their own, a family without such a text, chains: groups by brute force."""
    r = random.Random(41)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(5))

    def changed(words, n):
        out = list(words)
        for at in r.sample(range(0, len(words), 6), n):
            out[at] = word()
        return out

    base, lost, chain = ([word() for _ in range(150)] for _ in range(3))
    texts = [base] + [changed(base, 3) for _ in range(40)] + [changed(lost, r.choice([2, 3, 4])) for _ in range(40)]
    for _ in range(12):
        texts.append(chain)
        chain = changed(chain, 3)
    far = [changed(base, 8) for _ in range(12)]
    texts += far + [changed(t, n) for t in far[:8] for n in (1, 2, 2, 3)]
    texts += [[word() for _ in range(20)] for _ in range(10)]
    r.shuffle(texts)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    kept = {x["doc_id"] for x in similar.drop_similar(docs, bits=0).collect()}
    sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    unlike = 0
    for i in range(len(texts)):
        for j in range(i):
            share = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            unlike += 0.4 < share < 0.8
            if share >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert kept == {find(i) for i in range(len(texts))} and unlike > 500
