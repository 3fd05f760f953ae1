"""Operators whose plans must hold for hot keys and long files: seeds by runs, targets, quantiles, ranges, closures, digests."""

from __future__ import annotations

import gzip
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.operators import align as A
from seqloom.operators import catalogue as L
from seqloom.operators import chunking as K
from seqloom.operators import features as X
from seqloom.operators import merge as M
from seqloom.operators import runlog as R
from seqloom.operators import taxonomy as T
from seqloom.sources import fasta as FA
from seqloom.sources import layout
from seqloom.sources import tables as TB
from seqloom.sources.scratch import scratch_path
from seqloom.streaming import runs as ST


# --- targets and seeds ----------------------------------------------------------------------------


def _hits(spark, rows):
    return spark.createDataFrame(rows, "query_id string, ref_chunk_id string, subject_id string, evalue double, bitscore double, query_start int")


def test_many_hits_of_a_subject_displace_no_other(spark):
    rows = [("q", "r", "s1", 1e-9, 80.0, i) for i in range(50)] + [("q", "r", "s2", 1e-5, 50.0, 0), ("q", "r", "s3", 1e-5, 60.0, 0), ("q", "r", "s3", None, 900.0, 1)]
    count = lambda n, r=rows: Counter(x["subject_id"] for x in M.limit_targets(_hits(spark, r), n).collect())
    assert count(50) == {"s1": 50, "s2": 1, "s3": 2}
    assert count(2) == {"s1": 50, "s3": 2}
    assert count(1) == {"s1": 50}


def test_targets_with_nulls_and_ties(spark):
    rows = [("q", None, "b", None, None, 1), ("q", None, "a", None, None, 1), ("q", None, "c", 5.0, None, 1), (None, "r", None, 1.0, 1.0, 1)]
    got = M.limit_targets(_hits(spark, rows), 2).collect()
    assert sorted((r["query_id"] or "", r["subject_id"] or "") for r in got) == [("", ""), ("q", "a"), ("q", "c")]
    assert M.limit_targets(_hits(spark, []), 2).count() == 0


def _naive(queries, refs, k):
    index = {}
    for s, seq in refs:
        for j in range(len(seq) - k + 1):
            index.setdefault(seq[j : j + k], []).append((s, j))
    out = Counter()
    for q, seq in queries:
        for i in range(len(seq) - k + 1):
            for s, j in index.get(seq[i : i + k], ()):
                out[q, s, i - j] += 1
    return out


@pytest.mark.parametrize(("often", "share"), [(1, 2), (3, 5), (6, 4096), (10**9, 1)])
def test_seeds_by_runs_equal_seeds_one_by_one(spark, often, share):
    r = random.Random(often)
    word = lambda n, letters="ACD": "".join(r.choice(letters) for _ in range(n))
    shared = word(60, "ACDEFGHIK")
    make = lambda p: [(f"{p}{i}", word(r.randint(0, 20)) + r.choice(["", shared, shared[:30], "AAAAAAAAAAAA"]) + word(r.randint(0, 20))) for i in range(12)]
    queries, refs = make("q"), [*make("s"), ("s99", "CDCDCDCDCDCD"), ("s98", "")]
    frame = lambda x: spark.createDataFrame(x, "id string, sequence string").repartition(3)
    matches = A.seed_matches(frame(queries), A.seeds(frame(refs), 4), 4, often=often, share=share)
    got = {(x["query_id"], x["subject_id"], x["diagonal"]): x["n"] for x in matches.groupBy("query_id", "subject_id", "diagonal").agg(F.sum("n").alias("n")).where("n <> 0").collect()}
    assert got == dict(_naive(queries, refs, 4))


def test_a_common_repeat_costs_rows_by_pairs_not_letters(spark):
    r = random.Random(8)
    repeat = "".join(r.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(400))
    frame = lambda p, n: spark.createDataFrame([(f"{p}{i}", repeat) for i in range(n)], "id string, sequence string")
    rows = A.seed_matches(frame("q", 15), A.seeds(frame("s", 15), 8), 8, often=4)
    assert rows.count() == 2 * 15 * 15  # one by one: 393 for each pair
    assert {x["n_seeds"] for x in A.seed_join(frame("q", 15), A.seeds(frame("s", 15), 8), 8, 2, often=4).collect()} == {393}


def test_seeds_that_no_reference_has_are_left_out_early(spark, monkeypatch):
    written, write = {}, A.materialize
    monkeypatch.setattr(A, "materialize", lambda df, name: written.setdefault(name, write(df, name)))
    queries = spark.createDataFrame([("q1", "MKVLAAG"), ("q2", "WWWWWWWWWWWW")], "id string, sequence string")
    refs = spark.createDataFrame([(f"r{i}", "MKVLAAG") for i in range(5)], "id string, sequence string")
    got = A.seed_join(queries, A.seeds(refs, 4), 4, 1, often=3).collect()
    assert sorted((r["query_id"], r["subject_id"], r["diagonal"], r["n_seeds"]) for r in got) == [("q1", f"r{i}", 0, 4) for i in range(5)]
    assert {r["query_id"] for r in written["query-places"].collect()} == {"q1"} and written["reference-places"].count() == 20


def test_masked_seeds_break_runs(spark):
    frame = lambda x: spark.createDataFrame(x, "id string, sequence string")
    refs = frame([("a", "ACDEFACDEF"), ("b", "ACDEF"), ("c", "XACDEX")])
    index = A.mask_frequent_seeds(A.seeds(refs, 3), 2)  # without ACD and CDE, which three sequences have
    got = {(x["subject_id"], x["diagonal"]): x["n_seeds"] for x in A.seed_join(frame([("q", "ACDEF")]), index, 3, 1, often=1).collect()}
    assert got == {("a", 0): 1, ("a", -5): 1, ("b", 0): 1}


# --- quantiles -----------------------------------------------------------------------------------------


def test_quantiles_are_exact(spark):
    r = random.Random(3)
    groups = {
        "many": [r.choice([-1, 1]) * 10 ** r.uniform(-30, 30) for _ in range(500)],
        "equal": [7.25] * 90,
        "close": [1.0 + i * 1e-13 for i in range(101)],
        "one": [-3.5],
        "zero": [0.0, -0.0, 0.0, 5e-324, -5e-324],
        "odd": [math.inf, -math.inf, 1.0, 2.0],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("many", None), ("none", None), (None, 4.0), (None, 8.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    q = [0.0, 0.5, 0.95, 1.0]
    got = {x["g"]: x["p"] for x in R.exact_quantiles(df, ["g"], "v", q).collect()}
    want = {x["g"]: x["p"] for x in df.where("v IS NOT NULL").groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, q))).alias("p")).collect()}
    assert got.pop("none") is None and set(got) == set(want)
    for g in want:
        np.testing.assert_allclose(got[g], want[g], rtol=1e-12, atol=0)
    nan = spark.createDataFrame([(1, math.nan), (1, 1.0)], "g int, v double")
    low, high = R.exact_quantiles(nan, ["g"], "v", [0.0, 1.0]).first()["p"]
    assert low == 1.0 and math.isnan(high)


def test_windows_without_durations_have_nulls(spark):
    df = spark.createDataFrame([("2026-01-01 00:00:01", 2.0), ("2026-01-01 00:00:02", 4.0), ("2026-01-01 00:07:00", None)], "t string, duration_s double").withColumn("ts", F.col("t").cast("timestamp"))
    rows = sorted((str(x["window_start"]), x["p50"], x["p95"]) for x in R.duration_quantiles(df).collect())
    assert rows == [("2026-01-01 00:00:00", 3.0, 3.9), ("2026-01-01 00:05:00", None, None)]


# --- ranges, chunks, files -----------------------------------------------------------------------------------


def test_numbers_have_no_hot_range(spark):
    rows = [("hot" if i % 3 else f"k{i:04d}", i) for i in range(3000)]
    out = layout.numbered(spark.createDataFrame(rows, "k string, v int").repartition(6), ["k"], "no", rows=200).withColumn("t", F.spark_partition_id())
    got = out.collect()
    assert sorted(r["no"] for r in got) == list(range(3000)) and {(r["k"], r["v"]) for r in got} == set(rows)
    ordered = [r["k"] for r in sorted(got, key=lambda r: r["no"])]
    assert ordered == sorted(ordered)
    again = layout.ranged(spark.createDataFrame(rows, "k string, v int").repartition(6), ["k"], 15).withColumn("t", F.spark_partition_id())
    assert max(Counter(r["t"] for r in again.collect()).values()) < 600
    assert layout.numbered(spark.createDataFrame([], "k string"), ["k"], "no").count() == 0


def test_sequential_chunks_with_one_id(spark):
    seqs = spark.createDataFrame([("same", f"M{i}", "MK", 2) for i in range(100)], "id string, description string, sequence string, length int")
    sizes = K.chunk_sequential(seqs, 30, ["id"], rows_per_task=10).groupBy("chunk_id").count().orderBy("chunk_id").collect()
    assert [(r[0], r[1]) for r in sizes] == [("chunk_000", 30), ("chunk_001", 30), ("chunk_002", 30), ("chunk_003", 10)]


def test_ranges_of_wide_rows_are_small_by_default(spark, monkeypatch):
    written, write = {}, layout.materialize
    monkeypatch.setattr(layout, "materialize", lambda df, name: written.setdefault(name, write(df, name)))
    got = layout.numbered(spark.range(120_000).select(F.col("id").cast("string").alias("id"), F.lit("M" * 50).alias("sequence")), ["id"], "n")
    sizes = [r["count"] for r in written["ranged"].groupBy("n_part").count().collect()]
    assert sum(sizes) == 120_000 and max(sizes) < 100_000
    assert tuple(got.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()) == (0, 119_999, 120_000)


def test_a_hot_chunk_is_written_by_many_tasks(spark):
    path = scratch_path(spark, "hot-chunk")
    seqs = spark.createDataFrame([("chunk_000" if i % 10 else "chunk_001", f"s{i:05d}", "d", "MK" * 50, 100, str(i)) for i in range(4000)], "chunk_id string, sequence_id string, description string, sequence string, length int, content_hash string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        TB.write_chunks(seqs, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    back = TB.scan_chunks(spark, path)
    files = back.where("chunk_id = 'chunk_000'").groupBy(F.input_file_name().alias("f")).agg(F.min("sequence_id").alias("a"), F.max("sequence_id").alias("b"), F.count("*").alias("n")).orderBy("a").collect()
    assert len(files) >= 3 and max(f["n"] for f in files) < 2500
    assert all(x["b"] < y["a"] for x, y in zip(files, files[1:]))  # ranges of ids don't overlap
    assert back.select(*seqs.columns).exceptAll(seqs).count() == 0 and back.count() == 4000


def test_long_files_are_digested_by_lines(spark, tmp_path):
    r = random.Random(2)
    texts = {"a": "short\n", "b": "\n".join("x" * r.randint(0, 90) for _ in range(5000)) + "\n", "c": "no end\r\n" * 3000 + "last", "d": "\n" * 2000, "e": "é中\x00" * 900, "f": ""}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        got = {x["path"].rsplit("/", 1)[1]: (x["n_bytes"], x["checksum"]) for x in TB.file_checksums(spark, str(tmp_path), whole=100).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {n: (len(t.encode()), "sha256:" + hashlib.sha256(t.encode()).hexdigest()) for n, t in texts.items() if t}
    (tmp_path / "z.gz").write_bytes(gzip.compress(b"line\n" * 100_000))
    with pytest.raises(Exception, match="not read as it lies"):
        TB.file_checksums(spark, str(tmp_path / "z.gz"), whole=10).collect()


def test_a_hot_id_is_compared_without_a_list(spark):
    rows = [("hot", f"M{i % 400}") for i in range(2000)] + [("x", "MK"), ("y", "MK")]
    seqs = spark.createDataFrame(rows, "id string, sequence string").withColumn("description", F.lit("d")).withColumn("length", F.length("sequence"))
    same = K.chunk_sequences(seqs.repartition(7), 3)
    assert K.verify_round_trip(seqs, same).count() == 0
    less = seqs.where("sequence <> 'M7'").unionByName(seqs.where("id = 'x'")).unionByName(seqs.where("id = 'y'").withColumn("id", F.lit("z")))
    got = {tuple(r) for r in K.verify_round_trip(seqs, K.chunk_sequences(less, 3)).collect()}
    assert got == {("hot", "changed"), ("x", "copies"), ("z", "added")}


# --- lineage -------------------------------------------------------------------------------------------------


def test_use_is_transitive_and_cycles_end(spark):
    edges = spark.createDataFrame([("a", "ref", "from"), ("b", "a", "from"), ("c", "b", "from"), ("a", "c", "from"), ("b", "ref", "from"), ("x", "other", "from"), ("ref", "ref", "self")], "child_id string, parent_id string, relationship string")
    datasets = spark.createDataFrame([(d, f"run_{d}") for d in "abcx"], "dataset_id string, created_by_run string")
    runs = spark.createDataFrame([(f"run_{d}", "done", 1) for d in "abcx"] + [("run_c", "late", 2)], "run_id string, status string, updated_at int")
    got = {(r["run_id"], r["status"]) for r in L.runs_using(runs, datasets, edges, "ref").collect()}
    assert got == {("run_a", "done"), ("run_b", "done"), ("run_c", "late")}
    assert {r[0] for r in L.all_descendants(edges, "b").collect()} == {"c", "a", "b"}
    assert L.all_descendants(edges, "nobody").count() == 0
    twice = edges.unionByName(edges.withColumn("relationship", F.lit("a_first")))
    assert {tuple(r) for r in L.lineage_edges(twice).collect()} == {(r[0], r[1], "a_first") for r in edges.collect()}


# --- FASTA: located failures and the stream's two outputs -----------------------------------------------------


def test_failures_name_file_and_line_in_split_files(spark, tmp_path):
    lines = [x for i in range(400) for x in (f">s{i} d", "MKV", "LAA")]
    lines[902] = "MK9"  # the last line of record 300, which ends at line 903
    lines[1052] = "M-K"
    (tmp_path / "big.fasta").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        records = FA.scan_records(spark, str(tmp_path / "big.fasta"))
        assert records.rdd.getNumPartitions() > 3
        with pytest.raises(Exception, match=r"big\.fasta, line 903, record 's300 d': invalid amino acid characters: 9"):
            FA.validate_sequences(records)[0].collect()
        with pytest.raises(Exception, match=r"block at byte \d+, record"):
            FA.validate_sequences(records, locate=False)[0].collect()
        good, bad = FA.validate_sequences(records, "quarantine")
        assert sorted(r["last_line"] for r in bad.collect()) == [903, 1053] and good.count() == 398
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


FILES = {"a.fasta": "junk line\nMKVL\n>s1 one\nMKV\n>s2 two\nM1\n", "b.fasta": "\n\n>s3\nACD\nEF\n>\nMM\n>s4\n", "c.fasta": ">s5\r\nMK\r\n>>s6\nAC\n"}


def test_stream_has_the_rejects_of_a_scan(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    log = str(tmp_path / "log")
    assert [d.count() for d in ST.ingest_fasta(spark, str(source), 3, out, log)] == [0, 0]
    for name, text in FILES.items():
        (source / name).write_text(text, newline="")
    chunks, rejects = ST.ingest_fasta(spark, str(source), 3, out, log, files_per_trigger=1)
    good, bad = FA.validate_sequences(FA.scan_records(spark, str(source)), "quarantine")
    assert sorted(map(tuple, chunks.select("sequence_id", "sequence").collect())) == sorted(map(tuple, good.select("id", "sequence").collect()))
    key = lambda df: sorted((r["path"].rsplit("/", 1)[1], r["last_line"], r["description"] or "", r["reason"]) for r in df.collect())
    assert key(rejects) == key(bad) and len(key(bad)) == 4
    assert {r["sequence_id"] for r in chunks.collect()} == {"s1", "s3", "s5", ">s6"}
    (source / "d.fasta").write_text(">s7\nMKK\n")
    chunks, rejects = ST.ingest_fasta(spark, str(source), 3, out, log)
    assert chunks.count() == 5 and rejects.count() == 4


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(FILES["a.fasta"])
    batch = FA.with_place(spark.read.option("lineSep", FA.RECORD_END).text(str(tmp_path / "a.fasta")))
    sink = ST.fasta_sinks(3, str(tmp_path / "out"))
    for number in (0, 0, 1):
        sink(batch, number)
    assert [spark.read.parquet(str(tmp_path / "out" / d)).count() for d in ("chunks", "rejects")] == [2, 4]


# --- clusters of features --------------------------------------------------------------------------------------


def test_points_sit_with_their_nearest_centre(spark):
    r = random.Random(9)
    rows = [(f"s{i}", c * 10 + r.random(), c * -5 + r.random(), r.random()) for i, c in enumerate([0, 1, 2] * 40)]
    got = X.cluster_features(spark.createDataFrame(rows, "sequence_id string, a double, b double, c double"), ["a", "b", "c"], 3).collect()
    x = np.array([[g["a"], g["b"], g["c"]] for g in got])
    x = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    cluster = np.array([g["cluster"] for g in got])
    centres = np.array([x[cluster == k].mean(axis=0) for k in range(3)])
    assert (((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1) == cluster).all()
    assert len({(g["cluster"], int(g["sequence_id"][1:]) % 3) for g in got}) == 3
    # The components are the directions of most variance.
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    np.testing.assert_allclose([np.var([g[p] for g in got], ddof=1) for p in ("pc1", "pc2")], values[:2], rtol=1e-6)


# --- lineages and features of hits -------------------------------------------------------------------------------


def _plan(df):
    df.collect()  # adaptive plans are final once they have run
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def enriched_parts(spark):
    rows = [(f"q{i % 40}", f"s{i % 7}.1" if i % 11 else None, i % 90 + 1.0, 5 + i % 13, 0, 0, i, i, i, i, float(i), 1.0, "q", "r") for i in range(600)]
    names = "query_id string, subject_id string, percent_identity double, alignment_length int, mismatches int, gap_opens int, query_start int, query_end int, subject_start int, subject_end int, evalue double, bitscore double, query_chunk_id string, ref_chunk_id string"
    # An accession of two taxa, one of a taxon without a lineage, one that no hit has, a subject without an accession.
    accessions = spark.createDataFrame([("s0", 5), ("s1", 6), ("s1", 5), ("s2", 99), ("s9", 5), ("s4", None), (None, 6)], "accession string, taxon_id long")
    nodes = spark.createDataFrame([(1, 1, "no rank"), (2, 1, "kingdom"), (3, 1, "kingdom"), (5, 2, "phylum"), (6, 3, "phylum")], "taxon_id long, parent_id long, rank string")
    lineage = T.resolve_lineage(nodes, nodes.select("taxon_id", F.concat(F.lit("n"), "taxon_id").alias("name")))
    return M.merge_hits(spark.createDataFrame(rows, names), 10), accessions, lineage


def test_hits_are_not_dealt_out_for_their_lineages(spark, enriched_parts, monkeypatch):
    """Two shuffles of hits, those of the merge: joins and both aggregations behind it add none; sent or dealt out, the rows are the same."""
    merged, accessions, lineage = enriched_parts
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sent = T.enrich_hits(merged, accessions, lineage)
        assert _plan(X.hit_features(sent)).split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 2
        monkeypatch.setattr(T, "SENT", 0)
        dealt = T.enrich_hits(merged, accessions, lineage)
        assert "BroadcastHashJoin" not in _plan(dealt) and sent.columns == dealt.columns
        got = Counter(map(tuple, sent.collect()))
        assert got == Counter(map(tuple, dealt.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    taxa, lines = {}, {x["taxon_id"]: x for x in lineage.collect()}
    for x in accessions.collect():
        taxa.setdefault(x["accession"], []).append(x["taxon_id"])
    want = Counter()
    for x in merged.collect():
        for t in taxa.get(x["subject_id"] and x["subject_id"][:-2], [None]) if x["subject_id"] else [None]:
            want[(*x, t, *(lines[t][1:] if t in lines else [None] * 7))] += 1
    assert got == want


def test_features_of_a_phylum_in_two_kingdoms(spark):
    """Sums are held in hash tables of numbers, and are those by hand: nulls, a phylum in two kingdoms, ranks and lengths missing or below 0."""
    r = random.Random(4)
    rows = [(r.choice(["a", "b", "c", None]), r.choice(["p1", "p2", "p3", None]), r.choice(["k1", "k2", None]), r.choice([None, 1.5, 90.0]), r.choice([0.0, 1e-9, None]), r.choice([None, -7, 0, 3, 2**31 - 1]), r.choice([None, -2, 5, 9]))
            for _ in range(80)] + [("none", None, None, None, None, None, None), ("ranked", "p1", "k1", 1.0, 1.0, -4, 2), ("ranked", "p1", "k1", 1.0, 1.0, 9, -3), ("ranked", "p1", "k2", 1.0, 1.0, 8, 1)]
    df = spark.createDataFrame(rows, "query_id string, phylum string, kingdom string, percent_identity double, evalue double, alignment_length int, global_rank int").repartition(3)
    out = X.hit_features(df)
    assert not {"ObjectHashAggregate", "SortAggregate"} & set(_plan(out).replace("(", " ").split())
    got = {x["sequence_id"]: x for x in out.collect()}
    assert set(got) == {x[0] for x in rows}
    for q, x in got.items():
        mine = [row for row in rows if row[0] == q]
        phyla = Counter(row[1] for row in mine if row[1])
        assert (x["hit_count"], x["num_phyla"], x["num_kingdoms"]) == (len(mine), len(phyla), len({row[2] for row in mine} - {None}))
        entropy = -sum(n / phyla.total() * math.log2(n / phyla.total()) for n in phyla.values())
        assert abs(x["taxonomic_entropy"] - entropy) < 1e-9
        low = lambda v: -math.inf if v is None else v
        assert x["_best_length"] == min(mine, key=lambda row: (low(row[6]), low(row[5])))[5]
        known = [row[3] for row in mine if row[3] is not None]
        assert x["max_percent_identity"] == max(known, default=None) and (not known or abs(x["mean_percent_identity"] - sum(known) / len(mine)) < 1e-9)
        lengths = [row[5] for row in mine if row[5] is not None]
        assert not lengths or math.isclose(x["mean_alignment_length"], sum(lengths) / len(mine), rel_tol=1e-12, abs_tol=1e-12)
