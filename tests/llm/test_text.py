"""BPE, counts, quality, lines, mixing, scoring and the pipeline."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seqloom.llm import bpe, fuzzy_lines, lm_scoring, mixing, quality, token_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ALPHABET = ["a", "b", "XYZ", " ", "  ", "\n", "\t", "'", "re", "s", "ve", "1", "é", "中", "😀", "　", "\x85", "\x1c", ".", "<|endoftext|>", "<|", " the", "ing", "²", "́"]


def frame(spark, texts, sources=None):
    return spark.createDataFrame([(i, t, "en", sources[i] if sources else "s", len(t or "")) for i, t in enumerate(texts)], SCHEMA).repartition(3)


def noise(seed, n, size=60):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, size))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(bpe.default_vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_equals_the_library(library):
    code = bpe.Coder(bpe.default_vocabulary())
    texts = noise(1, 3000) + ["", "a" * 5000, " " * 700, "<|endoftext|>", "é" * 200, "supercalifragilistic" * 9]
    for text, packed in zip(texts, code.encode_all(texts)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == ids
        assert code.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_trees_agree():
    code = bpe.Coder(bpe.default_vocabulary())
    words = ["".join(random.Random(i).choice("abcdefghij ") for _ in range(i % 60 + 2)) for i in range(300)]
    for word, packed in code.packed(words).items():
        assert np.frombuffer(packed, "<u4").tolist() == bpe.PairTree([int(code.first[b]) for b in word.encode()], code.rank).merge_all()


def test_bpe_frames(spark, library):
    texts = [*noise(2, 50), None, ""]
    docs = frame(spark, texts).withColumn("decoded", F.lit("x")).withColumn("ids", F.lit("y"))
    tokens = bpe.decode(bpe.encode(docs))
    for r in tokens.collect():
        want = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False)
    for r in bpe.digests(docs).collect():
        want = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(want) and r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
    assert bpe.digests(frame(spark, [])).count() == 0


def test_edits_equal_a_new_count():
    code, r = bpe.Coder(bpe.default_vocabulary()), random.Random(5)
    for text in noise(3, 800, 200):
        tokens = token_counts.pieces(code, text)
        tree = token_counts.CountTree(text, list(map(len, tokens)), token_counts.count_pieces(code, [tokens])[0])
        cuts = sorted(r.sample(range(len(text) + 1), min(len(text) + 1, 2 * r.randint(1, 4)) // 2 * 2))
        edits = [(cuts[i], cuts[i + 1], "".join(r.choice(ALPHABET) for _ in range(r.randint(0, 4)))) for i in range(0, len(cuts), 2)]
        tree.edit_all(edits, code)
        for a, b, new in reversed(edits):
            text = text[:a] + new + text[b:]
        assert tree.text == text and tree.total == len(code.encode(text)) // 4
        assert [x for leaf in tree.leaves for x in leaf[0]] == list(map(len, token_counts.pieces(code, text)))


def test_stored_trees_take_edits(spark, library):
    """Trees in a table, edited twice, equal new counts; an edit in a long text encodes its surroundings only."""
    r = random.Random(6)
    texts = {i: t for i, t in enumerate([*noise(7, 40, 300), "", "long words here " * 4000])}
    docs = spark.createDataFrame([*texts.items(), (None, "no id"), (7, texts[7])], "doc_id long, text string").withColumn("sizes", F.lit(1)).repartition(3)
    trees = token_counts.build_trees(docs)
    assert {(x["doc_id"], x["n_tokens"]) for x in trees.collect()} >= {(i, len(library.encode(t, add_special_tokens=False).ids)) for i, t in texts.items()}
    for _ in range(2):
        edits = []
        for i, t in texts.items():
            if i % 3 or i == 41:
                a = r.randint(0, len(t))
                two = sorted(r.sample(range(len(t) + 1), 2)) if len(t) > 1 else [0, 0]
                new = [(a, a + 3, "new piece "), (two[0], min(two[1], two[0] + 9), None)]
                edits += [(i, *x) for x in (new[:1] if two[0] < a + 3 and a < two[1] or len(t) < 20 else new)]
        frame_ = spark.createDataFrame([*edits, (999, 0, 1, "x"), (None, 0, 1, "x")], "doc_id long, start long, end long, new string")
        trees = token_counts.edit_trees(trees, frame_).drop("n_encoded_again")
        for i, a, b, new in sorted(edits, key=lambda e: (e[0], -e[1])):
            texts[i] = texts[i][:a] + (new or "") + texts[i][b:]
        got = {}
        for x in trees.collect():
            got.setdefault(x["doc_id"], []).append(x)
        assert len(got) == len(texts) + 1 and len(got[7]) == 2 and got[None][0]["text"] == "no id"
        for i, t in texts.items():
            for x in got[i]:
                assert x["text"] == t and x["n_tokens"] == sum(x["counts"]) == len(library.encode(t, add_special_tokens=False).ids) and sum(x["sizes"]) == len(t)
    one = spark.createDataFrame([(41, 30_000, 30_005, "changed")], "doc_id long, start long, end long, new string")
    assert [x["n_encoded_again"] for x in token_counts.edit_trees(trees.where("doc_id = 41"), one).collect()][0] < 200
    assert token_counts.edit_trees(trees.limit(0), one).count() == 0 and token_counts.build_trees(docs.limit(0)).count() == 0


def test_count_with_edits(spark, library):
    texts = ["mail me at some.one@example.org today, " * 3, None, "", "plain words only", "call +44 20 7946 0958 now"]
    got = {r["doc_id"]: r for r in token_counts.count_with_edits(frame(spark, texts), token_counts.pattern_edits(token_counts.PRIVATE, "<private>")).collect()}
    for i, t in enumerate(texts):
        after = re.sub(token_counts.PRIVATE, "<private>", t or "")
        assert got[i]["n_tokens_before"] == len(library.encode(t or "", add_special_tokens=False).ids)
        assert got[i]["n_tokens"] == len(library.encode(after, add_special_tokens=False).ids)
    long = "word " * 20_000 + "a@b.cc " + "word " * 20_000
    r = token_counts.count_with_edits(frame(spark, [long]), token_counts.pattern_edits(token_counts.PRIVATE, "x")).first()
    assert r["n_edits"] == 1 and r["n_encoded_again"] < 100 < r["n_pre_tokens"]


def brute_base(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    cover = {i + k for i, g in enumerate(wins) if wins.count(g) > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover), len(w) < 10 or 100 * len(cover) > 20 * len(w))


def test_quality(spark):
    r = random.Random(6)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(0, 80))).replace("w1 ", "w1\n").replace("w2 ", "#\t ") for _ in range(60)]
    texts += [None, "", "\n \x0b\n", "a b c d e " * 10, "same line\nsame line\nother é", "x" * 5000]
    texts += [f"shared boilerplate line of this host\nbody {i} " + " ".join(f"u{i}v{k}" for k in range(3 if i < 5 else 30)) for i in range(40)]
    copies = "\n".join(" ".join(f"c{k}d{j}" for j in range(9)) for k in range(6))
    texts += [copies] * 80
    got = {x["doc_id"]: x for x in quality.quality_rules(frame(spark, texts), least=10).collect()}
    for i, t in enumerate(texts):
        assert tuple(got[i])[1:7] == brute_base(t), t
    n = len(texts) - 120
    assert [got[n + i]["kept"] for i in range(40)] == [False] * 5 + [True] * 35
    assert all(got[i]["kept"] for i in range(n + 40, len(texts)))  # copies are no boilerplate
    out = quality.keep_good(frame(spark, texts), least=10)
    row = out.where(F.col("doc_id") == n + 20).first()
    assert "boilerplate" not in row["text"] and row["text"].startswith("body 20") and row["n_chars"] == len(row["text"])
    assert out.count() == sum(x["kept"] for x in got.values())
    assert quality.quality_rules(frame(spark, [])).count() == 0


CLASH = ["_id", "_kept", "_cut", "_copies", "_pass", "_host", "_source", "host", "h", "t", "digest", "_digest", "_own", "_hit", "_gone", "_row", "block", "key", "id", "ids"]


def odd_rows(clean):
    """Null and repeated ids beside unlike texts, repeated rows, nulls in every column."""
    return [(5, clean[0], "en", "s", 1)] * 3 + [(None, clean[1], "en", "s", 1), (None, "bad", "en", "s", 1), (5, clean[2], None, None, None), (5, "bad", "en", "s", 1), (None, None, None, None, None), (6, "", "en", "s", 0)]


def test_kept_rows_come_once(spark):
    """keep_good and drop_exact_duplicates by contents: a row is judged by its own text, whatever its id."""
    from seqloom.llm import exact_dedup

    r = random.Random(21)
    clean = [" ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(30)) for _ in range(3)]
    rows = odd_rows(clean)
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in CLASH})
    good = quality.keep_good(docs)
    assert good.columns == docs.columns
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    assert sorted(((x["doc_id"], x["text"]) for x in good.collect()), key=key) == sorted(((i, t) for i, t, *_ in rows if t in clean), key=key)
    once = exact_dedup.drop_exact_duplicates(docs)
    assert once.columns == docs.columns
    assert sorted(((x["doc_id"], x["text"] or "") for x in once.collect()), key=key) == sorted([(5, clean[0]), (None, clean[1]), (5, clean[2]), (5, "bad"), (6, "")], key=key)
    mixed = mixing.mix_sources(docs, max_repetition=1.0, cover=True)
    assert mixed.columns == docs.columns
    assert sorted(((x["doc_id"], x["text"]) for x in mixed.collect()), key=key) == sorted(((i, t) for i, t, *_ in rows), key=key)
    assert mixing.mix_sources(docs.limit(0)).count() == quality.keep_good(docs.limit(0)).count() == exact_dedup.drop_exact_duplicates(docs.limit(0)).count() == 0


def test_lines_go_from_rows_without_ids(spark):
    """Boilerplate is counted and cut in rows with null and repeated ids like in others; a hot host has no other limit."""
    line = "read all about our cookies here"
    body = lambda i: " ".join(f"u{i}v{k}" for k in range(20))
    rows = [(None if i % 2 else 7, f"{line}\n{body(i)}", "en", "a", 0) for i in range(30)] + [(100 + i, body(100 + i), "en", "a", 0) for i in range(400)] + [(i, f"{line}\n{body(i)}", "en", "b", 0) for i in range(500, 510)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted(x["text"] for x in quality.keep_good(docs).collect())
    assert got == sorted([body(i) for i in range(30)] + [body(100 + i) for i in range(400)] + [f"{line}\n{body(i)}" for i in range(500, 510)])
    assert quality.keep_good(docs, share=0.5).where("source = 'b' AND text LIKE 'read all%'").count() == 0


def alike_pairs(lines, similarity=0.8):
    """All pairs of different lines at this edit similarity, by DuckDB's edit distance; counts of characters bound it from below."""
    import duckdb
    import pyarrow as pa

    size = np.array([len(x) for x in lines])
    letters = np.zeros((len(lines), 64), np.int32)
    for i, x in enumerate(lines):
        np.add.at(letters[i], np.fromiter((ord(c) % 64 for c in x), np.int64, len(x)), 1)
    order = np.argsort(size, kind="stable")
    left, right = [], []
    for n, i in enumerate(order):
        rest = order[n + 1 : np.searchsorted(size[order], size[i] / similarity + 1, "right")]
        low = (np.abs(letters[rest] - letters[i]).sum(1) + size[rest] - size[i]) // 2
        fine = rest[low <= (1 - similarity) * size[rest] + 1e-9]
        left += [int(i)] * len(fine)
        right += fine.tolist()
    pairs = pa.table({"i": left, "j": right, "a": [lines[i] for i in left], "b": [lines[j] for j in right]})  # noqa: F841
    return duckdb.sql(f"SELECT i, j FROM pairs WHERE levenshtein(a, b) <= {1 - similarity} * greatest(length(a), length(b)) + 1e-9").fetchall()


def normal(x):
    return x.strip(" \t\n\x0b\f\r").lower()


def places(texts):
    return {(i, k): normal(x) for i, t in enumerate(texts) for k, x in enumerate((t or "").split("\n")) if normal(x)}


def test_fuzzy_lines(spark):
    """Against all pairs: links only between alike lines, nine in ten alike pairs linked, first occurrences kept."""
    r = random.Random(8)
    vocabulary = ["".join(r.choice("abcdefghklmnoprstuw") for _ in range(r.randint(2, 9))) for _ in range(300)]
    line = lambda n: [r.choice(vocabulary) for _ in range(n)]
    lines = []
    for size in (6, 12, 25, 40, 80):
        for _ in range(12):
            b = line(size)
            lines.append(" ".join(b))
            for _ in range(r.choice([0, 1, 4])):
                v = list(b)
                for _ in range(r.randint(1, max(1, size // 12))):
                    at = r.randrange(len(v))
                    v[at : at + 1] = r.choice([[], [r.choice(vocabulary)], [v[at], r.choice(vocabulary)], [v[at] + "x"]])
                lines.append(" ".join(v))
    lines += ["  " + lines[0].upper() + "\t", "", "short", "Short", "the", " ".join(line(900))]
    lines.append(lines[-1].replace(" ", "  ", 3) + " tail")  # a long line
    r.shuffle(lines)
    texts = ["\n".join(lines[i : i + 4]) for i in range(0, len(lines), 4)] + [None, "\n\n", lines[1]]
    rows = fuzzy_lines.fuzzy_line_groups(frame(spark, texts)).collect()
    got = {(x["doc_id"], x["line_no"]): x for x in rows}
    norm = places(texts)
    assert set(got) == set(norm) and len(rows) == len(norm)
    group = {x: got[p]["group_id"] for p, x in norm.items()}
    distinct = sorted(group)
    alike = alike_pairs(distinct)
    hits = sum(group[distinct[i]] == group[distinct[j]] for i, j in alike)
    assert len(alike) > 100 and hits >= 0.9 * len(alike)
    parent = {x: x for x in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in alike:
        parent[find(distinct[i])] = find(distinct[j])
    assert all(find(x) == find(y) for x in distinct for y in distinct if group[x] == group[y])  # nothing unlike is linked
    first: dict = {}
    for place, x in sorted(norm.items()):
        first.setdefault(group[x], place)
    assert all((got[p]["keep_doc_id"], got[p]["keep_line_no"]) == first[group[x]] and got[p]["kept"] == (first[group[x]] == p) for p, x in norm.items())
    assert fuzzy_lines.fuzzy_line_groups(frame(spark, [])).count() == 0


def distance(a, b):
    """Edit distance by columns of bits."""
    if len(a) < len(b):
        a, b = b, a
    full, peq = (1 << len(a)) - 1, {}
    for i, c in enumerate(a):
        peq[c] = peq.get(c, 0) | 1 << i
    up, down, score, last = full, 0, len(a), 1 << len(a) - 1
    for c in b:
        eq = peq.get(c, 0)
        x = eq | down
        h = (((eq & up) + up) ^ up) | eq
        plus, minus = down | ~(h | up) & full, up & h
        score += bool(plus & last) - bool(minus & last)
        plus, minus = (plus << 1 | 1) & full, minus << 1 & full
        up, down = minus | ~(x | plus) & full, plus & x
    return score


def test_fuzzy_lines_decide_by_characters_alone(spark):
    """Long words, scattered typos, lines without blanks, other scripts: linked just where the edit similarity is 0.8 or more."""
    r = random.Random(21)
    word = lambda n, letters="abcdefghijklmnopqrstuvwxyz": "".join(r.choice(letters) for _ in range(n))
    words = lambda n: [word(r.randint(3, 9)) for _ in range(n)]

    def typos(ws, n):
        out = list(ws)
        for i in r.sample(range(len(ws)), n):
            out[i] = out[i][:1] + "9" + out[i][2:]
        return " ".join(out)

    middle, twenty, big, long_line = " ".join(words(24)), words(20), word(1200), words(300)
    chinese = "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(60))
    arabic = word(80, "ابتثجحخدذرزسشصضطظعغ ").strip()
    thai = "".join(chr(0x0E01 + r.randrange(45)) for _ in range(50))
    pairs = [
        (f"{word(250)} {middle}", f"{middle} {word(250)}"), (" ".join(twenty), typos(twenty, 8)), (f"see {big} now", f"see {big[:600]}#{big[601:]} now"),
        (chinese, chinese[:30] + "國" + chinese[31:]), (arabic, arabic[:40] + "؟" + arabic[41:]), (thai, thai[:20] + thai[22:]), ("hello there wold", "hello there world"),
        (" ".join(long_line), typos(long_line, 90)), (" ".join(long_line[:150]) + " tail of it", " ".join(long_line[:150] + words(8))), (" ".join(long_line[50:]), " ".join(long_line[50:120] + words(120) + long_line[240:])),
        ("x" * 150 + " " + "y" * 30, "x" * 150), (" ".join(words(4)) + " " + middle, middle),
    ]
    got = {x["doc_id"]: x["group_id"] for x in fuzzy_lines.fuzzy_line_groups(frame(spark, [x for p in pairs for x in p])).collect()}
    alike = [1 - distance(a, b) / max(len(a), len(b)) >= 0.8 for a, b in pairs]
    assert [got[2 * i] == got[2 * i + 1] for i in range(len(pairs))] == alike
    assert alike.count(False) == 2


def test_judge_is_edit_distance(spark):
    """Random pairs around the limit, with common ends, blanks in a row and words that move: the verdict is that of all characters."""
    r = random.Random(22)
    vocabulary = ["a", "bb", "the", "of", "longer", "", "wordsandwords", "é", "中文字", "x" * 60]
    rows = []
    for i in range(700):
        a = [r.choice(vocabulary) for _ in range(r.choice([3, 20, 60, 150]))]
        b = list(a)
        for _ in range(r.randint(0, max(1, len(b) // 4))):
            at = r.randrange(len(b) + 1)
            b[at : at + r.randint(0, 2)] = r.choice([[], [r.choice(vocabulary)], [r.choice(vocabulary)] * 2])
        rows.append((2 * i, " ".join(a) or "-", 2 * i + 1, " ".join(b) or "-"))
    df = spark.createDataFrame(rows, "a long, ta string, b long, tb string")
    texts = df.selectExpr("a AS h", "ta AS line").unionByName(df.selectExpr("b AS h", "tb AS line"))
    got = {x["a"]: x["fine"] for x in fuzzy_lines.judge(df.select("a", "b"), texts, 0.8).collect()}
    want = {a: distance(x, y) <= math.floor(max(len(x), len(y)) * (1 - 0.8) + 1e-9) for a, x, _, y in rows}
    assert got == want and 100 < sum(want.values()) < 600


def test_judge_has_no_limit_of_work(spark):
    """Lines of 24,000 characters with edits all over them are judged by all of these: 4800 are alike, 4801 are not."""
    r = random.Random(23)
    a = [r.choice("abcdefghij") for _ in range(24_000)]
    rows = []
    for i, edits in enumerate((4500, 4800, 4801)):
        b = list(a)
        for at in r.sample(range(len(a)), edits):
            b[at] = "#"  # not in the other line, so that each is an edit
        rows.append((i, "".join(b)))
    texts = spark.createDataFrame([(9, "".join(a)), *rows], "h long, line string")
    pairs = spark.createDataFrame([(9, i) for i, _ in rows], "a long, b long")
    assert {x["b"]: x["fine"] for x in fuzzy_lines.judge(pairs, texts, 0.8).collect()} == {0: True, 1: True, 2: False}


def test_fuzzy_lines_recall(spark):
    """Nine in ten of all alike pairs of a given table are in one group."""
    path = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no given tables")
    texts = [x["text"] for x in spark.read.parquet(path).orderBy("doc_id").select("text").collect()]
    got = {(x["doc_id"], x["line_no"]): x["group_id"] for x in fuzzy_lines.fuzzy_line_groups(frame(spark, texts)).collect()}
    group = {x: got[p] for p, x in places(texts).items()}
    distinct = sorted(group)
    alike = alike_pairs(distinct)
    assert len(alike) > 20 and sum(group[distinct[i]] == group[distinct[j]] for i, j in alike) >= 0.9 * len(alike)


def test_no_alike_lines_of_one_bucket_stay_apart(spark, monkeypatch):
    """With one bucket for all lines, groups are those of all alike pairs, however many lines are unlike the smallest ones."""
    r = random.Random(5)
    letters = lambda n: "".join(r.choice("abcdefghij") for _ in range(n))
    texts = []
    for _ in range(12):
        line = letters(40)
        for _ in range(4):  # a chain, whose ends may be unlike
            texts.append(line)
            for at in r.sample(range(40), 5):
                line = line[:at] + r.choice("abcdefghij") + line[at + 1:]
    monkeypatch.setattr(fuzzy_lines, "block_keys", lambda lines: lines.select("h", F.length("line").alias("size"), F.lit(1).cast("long").alias("key")))
    monkeypatch.setattr(fuzzy_lines, "SHARE", 10)
    got = {texts[x["doc_id"]]: x["group_id"] for x in fuzzy_lines.fuzzy_line_groups(frame(spark, texts)).collect()}
    distinct = sorted(set(texts))
    root = {x: x for x in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in alike_pairs(distinct):
        root[find(distinct[i])] = find(distinct[j])
    assert len({find(x) for x in distinct}) < len(distinct)
    assert len({(find(x), got[x]) for x in distinct}) == len({find(x) for x in distinct}) == len(set(got.values()))


def test_unlike_lines_of_one_bucket_are_proven_unlike_ahead_of_edit_distances(spark, monkeypatch):
    """In a bucket of unlike lines, edit distances are worked out for a few pairs a line, not for all pairs; alike ones are found."""
    r = random.Random(31)
    syllables = ["".join(r.choice("abcdefghijklmnoprstu") for _ in range(r.randint(2, 4))) for _ in range(60)]
    line = lambda: " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(40))
    lines = [line() for _ in range(120)]
    lines += [x.replace(x[50:53], "#", 1) for x in lines[:10]]
    monkeypatch.setattr(fuzzy_lines, "block_keys", lambda lines: lines.select("h", F.length("line").alias("size"), F.lit(1).cast("long").alias("key")))
    seen, judge = [], fuzzy_lines.judge

    def counted(pairs, texts, similarity):
        seen.append(pairs.count())
        return judge(pairs, texts, similarity)

    monkeypatch.setattr(fuzzy_lines, "judge", counted)
    got = {x["doc_id"]: x["group_id"] for x in fuzzy_lines.fuzzy_line_groups(frame(spark, lines)).collect()}
    assert len(set(got.values())) == 120 and all(got[i] == got[120 + i] for i in range(10))
    assert sum(seen) < 5 * len(lines)


def test_pieces_prove_no_alike_lines_unlike(spark):
    """Around the limit, in several scripts and with characters beyond 16 bits: what is proven unlike is unlike."""
    r = random.Random(32)
    alphabets = ["abcdefgh ", "abcdefghijklmnopqrstuvwxyz  ", "ابتثجحخدذرزسش ", "".join(chr(0x4E00 + i) for i in range(400)), "ab😀😁😂é\u0161\u0261 ", "a"]
    pairs = []
    for _ in range(900):
        letters = r.choice(alphabets)
        a = "".join(r.choice(letters) for _ in range(r.choice([1, 2, 3, 7, 20, 80, 300])))
        b = list(a)
        for _ in range(int(len(a) * r.choice([0, 0.1, 0.18, 0.2, 0.22, 0.3, 1, 4, 4])) + r.randint(0, 1)):
            at = r.randrange(len(b) + 1)
            b[at : at + r.randint(0, 1)] = r.choice([[], [r.choice(letters)]])
        pairs.append((a, "".join(b) or "-"))
    rows = [(2 * i + j, x) for i, p in enumerate(pairs) for j, x in enumerate(p)]
    filters = fuzzy_lines.piece_filters(spark.createDataFrame(rows, "h long, line string"))
    left = filters.where("h % 2 = 0").select("h", "letters", F.col("filter").alias("own"))
    right = filters.where("h % 2 = 1").select((F.col("h") - 1).alias("h"), F.col("letters").alias("other"), "filter")
    most = fuzzy_lines._most(F.length("letters"), F.length("other"), 0.8)
    proof = fuzzy_lines._unlike(F.col("letters"), F.col("filter"), most), fuzzy_lines._unlike(F.col("other"), F.col("own"), most)
    got = {x["h"] // 2: x["p"] or x["q"] for x in left.join(right, "h").select("h", proof[0].alias("p"), proof[1].alias("q")).collect()}
    alike = [distance(a, b) <= math.floor(max(len(a), len(b)) * (1 - 0.8) + 1e-9) for a, b in pairs]
    assert len(got) == len(pairs) and 200 < sum(alike) < 800
    assert not any(got[i] for i in range(len(pairs)) if alike[i])
    assert sum(got.values()) > 50


def test_tiles_prove_no_alike_lines_unlike(spark, monkeypatch):
    """Around the limit, in several scripts, with common pieces and letters moved: what tiles prove unlike is unlike, and most unlike lines are proven."""
    monkeypatch.setattr(fuzzy_lines, "EACH", 1)
    monkeypatch.setattr(fuzzy_lines, "COMMON", 200)
    r = random.Random(33)
    syllables = ["the ", "and ", "ing ", *("".join(r.choice("abcdefghiklmnoprstu ") for _ in range(3)) for _ in range(80))]
    sources = [syllables, ["ابت", "ثج ", "حخد", "ذرز", "سشص"], [chr(0x4E00 + i) for i in range(400)], ["a😀", "b😁", "é\u0161", "\u0261 "], ["a"]]
    pairs = []
    for _ in range(700):
        source = r.choice(sources[:1] * 6 + sources)
        a = "".join(r.choice(source) for _ in range(r.choice([1, 2, 7, 20, 80, 200, 200])))
        b = list(a)
        at = r.randrange(len(a))
        for _ in range(int(len(a) * r.choice([0, 0.05, 0.1, 0.18, 0.2, 0.22, 0.3])) + r.randint(0, 1)):
            at = r.randrange(len(b) + 1) if r.random() < 0.5 else min(at, len(b))  # scattered, or many at one place
            b[at : at + r.randint(0, 1)] = r.choice([[], list(r.choice(source))[:1]])
        pairs.append((a, "".join(b) or "-"))
    for _ in range(100):
        pairs.append(tuple("".join(r.choice(syllables) for _ in range(120)) for _ in "ab"))
    pairs = [(a, b) for a, b in pairs if min(len(a), len(b)) >= 0.8 * max(len(a), len(b))]
    rows = [(2 * i + j, x, len(x)) for i, p in enumerate(pairs) for j, x in enumerate(p)]
    tables = fuzzy_lines.piece_tables(spark.createDataFrame(rows, "h long, line string, size int").select("h", "line"))
    sizes = spark.createDataFrame([(h, n) for h, _, n in rows], "h long, size int")
    full = tables.join(sizes, "h")
    left = full.select(F.col("h").alias("a"), F.col("size").alias("sa"), "tiles")
    right = full.select(F.col("h").alias("b"), F.col("size").alias("sb"), "held")
    most = fuzzy_lines._most(F.col("sa"), F.col("sb"), 0.8)
    left_over = {(x["a"], x["b"]) for turn in (0, 1) for x in fuzzy_lines.unproven(left.join(right, (F.col("a").bitwiseXOR(F.lit(1)) == F.col("b")) & (F.col("a") % 2 == turn)).withColumn("most", most)).collect()}
    alike = [distance(a, b) <= math.floor(max(len(a), len(b)) * (1 - 0.8) + 1e-9) for a, b in pairs]
    assert 200 < sum(alike) < len(pairs) - 100
    assert all({(2 * i, 2 * i + 1), (2 * i + 1, 2 * i)} <= left_over for i in range(len(pairs)) if alike[i])
    assert sum((2 * i, 2 * i + 1) not in left_over for i in range(len(pairs) - 100, len(pairs))) > 80


def test_pieces_are_looked_up_for_few_pairs_of_unlike_lines(spark, monkeypatch):
    """Of a bucket of unlike lines, tiles leave few for the filters of all pieces."""
    r = random.Random(31)
    syllables = ["".join(r.choice("abcdefghijklmnoprstu") for _ in range(r.randint(2, 4))) for _ in range(60)]
    lines = [" ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(40)) for _ in range(60)]
    monkeypatch.setattr(fuzzy_lines, "block_keys", lambda lines: lines.select("h", F.length("line").alias("size"), F.lit(1).cast("long").alias("key")))
    seen, filters = [], fuzzy_lines.piece_filters

    def counted(texts):
        seen.append(texts.count())
        return filters(texts)

    monkeypatch.setattr(fuzzy_lines, "piece_filters", counted)
    got = fuzzy_lines.fuzzy_line_groups(frame(spark, lines)).collect()
    assert len({x["group_id"] for x in got}) == 60 and sum(seen) < 20


def test_fuzzy_lines_edges(spark):
    """Null and repeated ids, repeated rows, clashing columns, hot buckets."""
    base = "one common line of ten words that stands in rows"
    rows = [(None, base + " here", "en", "s", 0), (None, base + " there", "en", "s", 0), (3, base + " now", "en", "s", 0), (3, base + " now", "en", "s", 0), (3, "another text, same id", "en", "s", 0), (4, None, None, None, 0)]
    extra = {c: F.lit("x") for c in ("h", "key", "line", "at", "src", "node", "least", "size", "keep")}
    got = fuzzy_lines.fuzzy_line_groups(spark.createDataFrame(rows, SCHEMA).withColumns(extra)).collect()
    assert len(got) == 5 and len({x["group_id"] for x in got}) == 2
    assert sorted((x["doc_id"] is None, x["kept"]) for x in got) == [(False, True)] * 3 + [(True, False)] * 2
    assert all(x["keep_doc_id"] == 3 for x in got)
    # Unlike lines with a common block, in one bucket, and two alike ones among them.
    r = random.Random(3)
    word = lambda: "".join(r.choice("abdefhijlm") for _ in range(6))
    lines = ["kilo kind word group " + " ".join(("c" if i % 3 == 0 else "") + word() for i in range(12)) for _ in range(30)]
    lines.append(lines[17] + " end")
    got = {x["doc_id"]: x["group_id"] for x in fuzzy_lines.fuzzy_line_groups(frame(spark, lines)).collect()}
    assert got[30] == got[17] and len(set(got.values())) == 30


def test_temperature():
    tokens = {"a": 9000, "b": 900, "c": 100, "none": 0}
    w = mixing.temperature_weights(tokens, max_repetition=2.0)
    share = {s: n / 10000 for s, n in tokens.items()}
    assert abs(max(w[s] / share[s] for s in "abc") - 2.0) < 1e-6 and w["none"] == 0 and abs(sum(w.values()) - 1) < 1e-9
    w = mixing.temperature_weights(tokens, target_entropy=0.8)
    assert abs(-sum(p * math.log(p) for p in w.values() if p) - 0.8) < 1e-6
    assert mixing.temperature_weights({}) == {} and set(mixing.temperature_weights({"a": 0}).values()) == {0.0}
    assert max(abs(v - 1 / 3) for s, v in mixing.temperature_weights(tokens).items() if tokens[s]) < 1e-9


def test_mixing_meets_its_budget(spark):
    r = random.Random(9)
    sources = ["big" if r.random() < 0.6 else r.choice(["x", "y", "z"]) for _ in range(400)]
    texts = [" ".join(["w"] * r.randint(0, 30)) for _ in sources] + [None]
    docs = frame(spark, texts, [*sources, None])
    rows = mixing.mixing_plan(docs, max_repetition=1.5, block_tokens=200).collect()
    assert len(rows) == len(texts)
    total: dict[str, int] = {}
    got: dict[str, int] = {}
    for x in rows:
        total[x["source"]] = total.get(x["source"], 0) + x["tokens"]
        got[x["source"]] = got.get(x["source"], 0) + x["tokens"] * x["copies"]
    w = mixing.temperature_weights(total, max_repetition=1.5)
    for s, n in total.items():
        goal = w[s] * sum(total.values())
        assert goal - 31 <= got[s] <= goal + 1e-6
    cover = mixing.mixing_plan(docs, max_repetition=1.5, cover=True, block_tokens=200).where("tokens > 0").agg(F.min("copies"), F.max("copies")).first()
    assert cover[0] == 1 and cover[1] == 2
    mixed = mixing.mix_sources(docs.withColumn("copies", F.lit(1)), max_repetition=1.5, cover=True)
    assert mixed.columns == [*docs.columns, "copies"]
    assert mixing.mixing_plan(frame(spark, [])).count() == 0


@pytest.mark.parametrize("options", [{"max_repetition": 1.5}, {"max_repetition": 1.5, "cover": True}, {"target_entropy": 0.9}, {"budget_tokens": 3000, "max_repetition": 4.0}])
def test_many_sources_never_reach_the_driver(spark, options):
    """Targets from aggregations over a table of sources equal those from the driver; groups of few blocks change nothing."""
    r = random.Random(10)
    sources = [r.choice(["big"] * 6 + ["x", "y", "z", "z2"]) for _ in range(500)] + ["empty", "x"]
    docs = frame(spark, [" ".join(["w"] * r.randint(0, 30)) for _ in sources[:-2]] + ["", None], sources)
    few = mixing.mixing_plan(docs, block_tokens=40, **options)
    before, mixing.GROUP = mixing.GROUP, 8
    try:
        many = mixing.mixing_plan(docs, block_tokens=40, max_sources=0, **options)
        assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))
    finally:
        mixing.GROUP = before
    assert mixing.mixing_plan(frame(spark, []), max_sources=-1).count() == 0


def test_gradient():
    net = lm_scoring.Network(lm_scoring.Shape(4, 5, 3), seed=1)
    r = np.random.default_rng(0)
    context, target = r.integers(0, 20, (400, 4)), r.integers(0, 20, 400)
    target = context[:, 1]  # the word before decides
    before = net.log_probs(context, target).mean()
    for _ in range(300):
        net.step(context, target, 0.1)
    assert net.log_probs(context, target).mean() > before + 1.0
    every = np.stack([np.exp(net.log_probs(context[:1].repeat(20, 0), np.arange(20)))]).sum()
    assert abs(every - 1) < 1e-4


def test_steps_are_those_of_each_word(monkeypatch):
    """A step by hand, word by word, gives the same weights, and ids are never sorted as longs."""
    shape = lm_scoring.Shape(4, 5, 3)
    net = lm_scoring.Network(shape, seed=1)
    r = np.random.default_rng(0)
    net.weights = [r.normal(0, 0.5, w.shape).astype(np.float32) for w in net.weights]
    context, target = r.integers(0, 20, (60, 4)), r.integers(0, 20, 60)
    table, bias, wc, bc, wm, bm = before = [w.astype(np.float64) for w in net.weights]
    grads = [np.zeros_like(w) for w in before]
    softmax = lambda x: np.exp(x) / np.exp(x).sum()
    for around, x in zip(context, target):
        hid = np.tanh(bias + sum(table[k][c] for k, c in enumerate(around)))
        group, place = divmod(int(x), shape.members)
        e = softmax(hid @ wc + bc) - np.eye(shape.classes)[group]
        f = softmax(hid @ wm[group] + bm[group]) - np.eye(shape.members)[place]
        back = (wc @ e + wm[group] @ f) * (1 - hid * hid)
        for k, c in enumerate(around):
            grads[0][k, c] += back / 60
        for k, at, g in ((1, ..., back), (2, ..., np.outer(hid, e)), (3, ..., e), (4, group, np.outer(hid, f)), (5, group, f)):
            grads[k][at] += g / 60
    sorted_as = []
    argsort = np.argsort
    monkeypatch.setattr(lm_scoring.np, "argsort", lambda a, **kw: sorted_as.append(a.dtype.itemsize) or argsort(a, **kw))
    net.step(context, target, 0.1)
    net.log_probs(context, target)
    for w, b, g in zip(net.weights, before, grads):
        np.testing.assert_allclose(w, b - 0.1 * g / np.sqrt(1e-6 + g * g), atol=2e-4)
    assert sorted_as and max(sorted_as) <= 2


def test_lm_tells_text_from_noise(spark):
    r = random.Random(10)
    pairs = {f"a{i}": f"b{i}" for i in range(20)}
    make = lambda: " ".join(x for _ in range(40) for x in (lambda k: (k, pairs[k]))(r.choice(list(pairs))))
    model = lm_scoring.train(frame(spark, [make() for _ in range(400)]), lm_scoring.Shape(8, 8, 16), rounds=2, batch=256)
    held = [make() for _ in range(20)]
    mixed = [" ".join(r.sample(t.split(), 80)) for t in held]
    got = {x["doc_id"]: x for x in lm_scoring.score(frame(spark, [*held, *mixed, None, "unseen"]), model).collect()}
    assert min(got[i]["mean_log_prob"] for i in range(20)) > max(got[i]["mean_log_prob"] for i in range(20, 40))
    assert got[40]["n_tokens"] == 0 and got[40]["log_prob"] == 0.0 and got[40]["mean_log_prob"] is None
    assert lm_scoring.score(frame(spark, []), model).count() == 0
    assert lm_scoring.train(frame(spark, []), lm_scoring.Shape(2, 40, 4)).known == {}


def test_scores_against_brute_force(spark):
    """Scores from given weights, word by word, in plain Python; also of null, empty, long and repeated texts."""
    shape = lm_scoring.Shape(3, 9, 4)
    r = np.random.default_rng(5)
    net = lm_scoring.Network(shape, seed=3)
    net.weights = [r.normal(0, 0.5, w.shape).astype(np.float32) for w in net.weights]
    known = {f"w{k}".encode(): 17 + k for k in range(10)}
    rare = ["unseen", "zz", "a-very-long-unseen-word", "quite-another-long-one"]
    frequent = {w: 50 - k for k, w in enumerate(known)}
    counts = spark.createDataFrame([*[(w.encode(), 3 + k) for k, w in enumerate(rare)], *frequent.items()], "word binary, n long").repartition(3)
    model = lm_scoring.Model(shape, known, net.packed(), lm_scoring.spelling(counts, known))
    pairs, ahead, stops = {}, {}, [0, 0]
    for k, w in enumerate(x.encode() for x in rare):
        for a, b in zip([256, *w], w):
            pairs[a, b] = pairs.get((a, b), 0) + 3 + k
            ahead[a] = ahead.get(a, 0) + 3 + k
        if len(w) >= 16:
            stops = [stops[0] + 3 + k, stops[1] + (3 + k) * (len(w) - 16)]
    stop = (stops[0] + 1) / (sum(stops) + 2)

    def spelt(w):
        p = sum(math.log((pairs.get(x, 0) + 0.1) / (ahead.get(x[0], 0) + 25.6)) for x in zip([256, *w], w))
        return p + (math.log(stop) + (len(w) - 16) * math.log(1 - stop) if len(w) >= 16 else 0.0)

    texts = ["w1 w2 unseen w3", "w9", "w4 " * 300 + "w5", None, "", "w1 w2 unseen w3", "a bb ccc \n\t w0", "a-very-long-unseen-word w2 é" + "x" * 40]
    extra = {c: F.lit("x") for c in ("n_tokens", "log_prob", "word")}
    got = {x["doc_id"]: x for x in lm_scoring.score(frame(spark, texts).withColumns(extra), model).collect()}
    table, bias, wc, bc, wm, bm = [w.astype(np.float64) for w in net.weights]
    softmax = lambda x: np.exp(x) / np.exp(x).sum()
    for i, t in enumerate(texts):
        ids = [known.get(w.encode(), min(len(w), 16)) for w in (t or "").split()]
        total = sum(spelt(w.encode()) for w in (t or "").split() if w.encode() not in known)
        for k, x in enumerate(ids):
            around = [ids[k + d] if 0 <= k + d < len(ids) else 0 for d in (-2, -1, 1, 2)]
            hid = np.tanh(bias + sum(table[j][c] for j, c in enumerate(around)))
            group, place = divmod(x, shape.members)
            total += math.log(softmax(hid @ wc + bc)[group]) + math.log(softmax(hid @ wm[group] + bm[group])[place])
        assert got[i]["n_tokens"] == len(ids) and abs(got[i]["log_prob"] - total) < 1e-3 * (1 + abs(total))
    words = {w.encode(): n for w, n in {"b": 3, "a": 3, "c": 1}.items()}
    assert list(lm_scoring.vocabulary(lm_scoring.word_counts(frame(spark, ["a b a b c", "a b", None])), 2)) == sorted(words, key=lambda w: (-words[w], w))[:2]


def test_spellings_of_a_length_add_up_to_one():
    r = np.random.default_rng(4)
    model = lm_scoring.Spelling(r.integers(0, 9, (257, 256)).astype(float), 5, 20)
    assert abs(np.exp(model.log_probs([bytes([a]) for a in range(256)])).sum() - 1) < 1e-9
    assert abs(np.exp(model.log_probs([bytes([a, b]) for a in range(256) for b in range(256)])).sum() - 1) < 1e-9
    # Of words of 16 bytes and more only the length is left to add up.
    assert abs(sum(math.exp(model.stop + k * model.go_on) for k in range(4000)) - 1) < 1e-9


def test_scores_do_not_depend_on_the_layout(spark):
    r = random.Random(12)
    words = ["".join(r.choice("abcdef") for _ in range(r.randint(1, 6))) for _ in range(300)]
    rows = [(r.choice([None, i, 7]), r.choice([None, ""] + [" ".join(r.choice(words) for _ in range(r.randint(1, 40)))] * 8)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("place", F.lit(1))
    shape = lm_scoring.Shape(4, 16, 8)
    models = [lm_scoring.train(docs.repartition(n), shape, batch=64, share_words=1500) for n in (2, 7)]
    assert (models[0].flat == models[1].flat).all() and models[0].known == models[1].known
    total = sum(len((t or "").split()) for _, t in rows)
    assert models[0].words == total and models[0].outside == sum(w.encode() not in models[0].known for _, t in rows for w in (t or "").split()) > 0
    scores = [sorted((str(x["doc_id"]), x["n_tokens"], x["log_prob"]) for x in lm_scoring.score(docs.repartition(n), m).collect()) for n, m in zip((3, 5), models)]
    assert len(scores[0]) == 300
    for a, b in zip(*scores):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-4 * (1 + abs(a[2]))  # sums in batches of other texts


def test_bpe_and_counts_of_odd_rows(spark, library):
    """Null and repeated ids, repeated rows, an empty table, clashing columns."""
    text = "Some text, mail me@example.org or +1 234 567 8901."
    rows = [(None, text), (None, text), (3, text), (3, "other"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("n_tokens", "ids_sha256", "n_edits", "ids")})
    want = sorted((str(i), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    digests = bpe.digests(docs, with_ids=True).collect()
    assert sorted((str(x["doc_id"]), x["n_tokens"]) for x in digests) == want and all(len(x["ids"]) == x["n_tokens"] for x in digests)
    edits = token_counts.pattern_edits(token_counts.PRIVATE, "<private>")
    counts = token_counts.count_with_edits(docs, edits).collect()
    assert sorted((str(x["doc_id"]), x["n_tokens_before"]) for x in counts) == want
    assert sorted(x["n_edits"] for x in counts) == [0, 0, 0, 2, 2, 2]
    assert token_counts.count_with_edits(docs.limit(0), edits).count() == 0 and bpe.digests(docs.limit(0)).count() == 0


def test_pipeline_against_brute_force(spark, tmp_path, library):
    """Every stage by hand: base rules and boilerplate, equal texts, near copies, whole passes, ids."""
    import corpus_pipeline as P

    r = random.Random(31)
    make = lambda n: [("".join(r.choice("abcdefghijklmnop") for _ in range(5))) for _ in range(n)]
    texts, sources = [], []
    for k in range(40):
        words = make(80)
        texts.append(" ".join(words))
        if k % 5 == 0:
            near = list(words)
            near[40] = "changed"
            texts += [" ".join(near), " ".join(words).upper(), " ".join(words)]
        if k % 8 == 0:
            texts.append("subscribe to our letter today\n" + " ".join(make(30)))
    texts += ["subscribe to our letter today\n" + " ".join(make(30)) for _ in range(25)] + ["two words", None, "", "again and again " * 20]
    sources = [f"s{i % 2}" if i < 60 else "s0" for i in range(len(texts))]
    frame(spark, texts, sources).write.parquet(str(tmp_path / "documents.parquet"))
    rows = P.run(spark, str(tmp_path)).collect()
    kept = {}
    norm = {i: [(sources[i], normal(x)) for x in (t or "").split("\n") if normal(x)] for i, t in enumerate(texts)}
    hosts: dict = {}
    for i, t in enumerate(texts):
        for x in norm[i]:
            hosts.setdefault(x, set()).add(t)
    for i, t in enumerate(texts):
        words = len((t or "").split())
        gone = [x for x in norm[i] if len(hosts[x]) >= 25]
        if brute_base(t)[-1] or sum(len(x[1].split()) for x in gone) > 0.5 * words:
            continue
        kept[i] = "\n".join(x for x in t.split("\n") if (sources[i], normal(x)) not in gone)
    assert any(kept[i] != texts[i] for i in kept)
    first: dict = {}
    for i, t in kept.items():
        first.setdefault(t.lower(), i)
    left = sorted(first.values())
    sets = {i: {tuple(kept[i].lower().split()[k : k + 5]) for k in range(len(kept[i].split()) - 4)} for i in left}
    root = {i: i for i in left}
    for n, i in enumerate(left):
        for j in left[:n]:
            if root[j] == j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root[i] = j
                break
    left = [i for i in left if root[i] == i]
    got: dict[int, int] = {}
    for x in rows:
        got[x["doc_id"]] = got.get(x["doc_id"], 0) + 1
        ids = library.encode(kept[x["doc_id"]], add_special_tokens=False).ids
        assert x["n_tokens"] == len(ids) and x["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert x["decoded_sha256"] == hashlib.sha256(kept[x["doc_id"]].encode()).hexdigest()
    assert sorted(got) == left and set(got.values()) <= {1, 2}
    total: dict = {}
    read: dict = {}
    for i in left:
        n = len(kept[i].split())
        total[sources[i]] = total.get(sources[i], 0) + n
        read[sources[i]] = read.get(sources[i], 0) + n * got[i]
    w = mixing.temperature_weights(total, max_repetition=1.5, cover=True)
    budget = max(total[s] / w[s] for s in total)
    assert all(w[s] * budget - 81 <= read[s] <= w[s] * budget + 1e-3 for s in total)


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline as P

    frame(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_pipeline(spark, tmp_path, library):
    import corpus_pipeline as P

    r = random.Random(11)
    make = lambda n: " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(n))
    clean = [make(60) for _ in range(30)]
    near = clean[0].split()
    texts = [*clean, "too short", clean[1].upper(), clean[2], " ".join(near[:59])]
    frame(spark, texts, [f"s{i % 3}" for i in range(len(texts))]).write.parquet(str(tmp_path / "documents.parquet"))
    rows = P.run(spark, str(tmp_path)).collect()
    kept = {x["doc_id"] for x in rows}
    assert kept >= set(range(30)) and not kept & {30, 31, 32}
    left = os.listdir(spark.conf.get("spark.checkpoint.dir"))
    assert not [x for x in left if x.startswith("work-")] and not [x for x in left if x.startswith("stage-mixing")]
    for x in rows:
        ids = library.encode(texts[x["doc_id"]], add_special_tokens=False).ids
        assert x["ids"] == ids
        assert x["n_tokens"] == len(ids) and x["decoded_sha256"] == hashlib.sha256(texts[x["doc_id"]].encode()).hexdigest()
