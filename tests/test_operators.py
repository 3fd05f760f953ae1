from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from seqloom.contracts import HITS_MERGED
from seqloom.functions import scalar as S
from seqloom.operators import align as A
from seqloom.operators import catalogue as L
from seqloom.operators import chunking as K
from seqloom.operators import features as X
from seqloom.operators import merge as M
from seqloom.operators import runlog as R
from seqloom.operators import taxonomy as T
from seqloom.sources import fasta as FA
from seqloom.sources import tables as TB

RAW = "qseqid string, sseqid string, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue double, bitscore double, query_chunk_id string, ref_chunk_id string"


def hits(spark, *rows):
    full = [(q, s, 85.0, 100, 15, 0, 1, 100, 1, 100, e, b, "q0", ref) for q, s, e, b, ref in rows]
    return spark.createDataFrame(full, RAW)


def test_assign_chunk_is_the_whole_digest(spark):
    ids = [f"seq{i}é" for i in range(200)]
    for n in (1, 7, 1000, 2**31 - 1):
        rows = spark.createDataFrame([(i,) for i in ids], "id string").select("id", S.assign_chunk(F.col("id"), n).alias("c")).collect()
        assert all(r["c"] == int(hashlib.sha256(r["id"].encode()).hexdigest(), 16) % n for r in rows)
    with pytest.raises(ValueError, match="positive"):
        S.assign_chunk(F.col("id"), 0)


def test_names_and_codes(spark):
    df = spark.createDataFrame([(5, 137, "sp|P12345.2|N"), (1234, -1, "A1.1")], "i int, code int, s string")
    rows = df.select(S.chunk_name(F.col("i"), "c"), S.classify_exit(F.col("code")), S.exit_label(F.col("code")), S.extract_accession(F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [("c005", "out_of_memory", "oom", "P12345"), ("c1234", "timeout", "diamond_error", "A1")]


def test_merge_ranks_across_chunks(spark):
    out = M.ordered(M.merge_raw(hits(spark, ("q", "A", 1e-20, 200.0, "r1"), ("q", "B", 1e-40, 200.0, "r2"), ("q", "C", 1e-10, 200.0, "r3"))))
    assert out.schema.names == HITS_MERGED.names
    assert [(r["subject_id"], r["global_rank"]) for r in out.collect()] == [("B", 1), ("A", 2), ("C", 3)]


def test_merge_ties_and_duplicates(spark):
    out = M.merge_raw(hits(spark, ("q", "A", 1e-20, 200.0, "r1"), ("q", "B", 1e-20, 250.0, "r1"), ("q", "A", 1e-40, 100.0, "r2"), ("q", "C", None, 1.0, "r2")))
    assert [(r["subject_id"], r["evalue"]) for r in M.ordered(out).collect()] == [("A", 1e-40), ("B", 1e-20), ("C", None)]


def test_top_n_is_per_query_and_after_dedup(spark):
    rows = [(q, f"s{i // 2}", 10.0**-i, 1.0, f"r{i % 2}") for q in ("q1", "q2") for i in range(8)]
    out = M.merge_raw(hits(spark, *rows), top_n=3)
    assert {(r["query_id"], r["global_rank"]) for r in out.collect()} == {(q, k) for q in ("q1", "q2") for k in (1, 2, 3)}
    stats = M.merge_stats(M.rename_raw(hits(spark, *rows)), 3).first()
    assert (stats["rows_raw"], stats["rows_deduped"], stats["rows_merged"]) == (16, 8, 6)


def test_merge_empty(spark):
    out = M.merge_raw(spark.createDataFrame([], RAW))
    assert out.count() == 0 and out.schema.names == HITS_MERGED.names


def test_chunks_do_not_depend_on_order(spark):
    seqs = FA.generate_sequences(spark, 200, "s", 10, 30)
    a, b = K.chunk_sequences(seqs, 7), K.chunk_sequences(seqs.orderBy(F.desc("id")), 7)
    assert a.exceptAll(b).count() == 0
    assert {tuple(r) for r in K.chunk_entries(a).collect()} == {tuple(r) for r in K.chunk_entries(b.repartition(5)).collect()}
    assert K.verify_round_trip(seqs, a).count() == 0
    broken = a.where("sequence_id <> 's_00003'").withColumn("content_hash", F.when(F.col("sequence_id") == "s_00004", "x").otherwise(F.col("content_hash")))
    assert {tuple(r) for r in K.verify_round_trip(seqs, broken).collect()} == {("s_00003", "lost"), ("s_00004", "changed")}
    sizes = [r["n"] for r in K.chunk_sequential(seqs, 30, ["id"]).groupBy("chunk_id").agg(F.count("*").alias("n")).orderBy("chunk_id").collect()]
    assert sizes == [30] * 6 + [20]


def test_pairs(spark):
    q, r = (spark.createDataFrame([(c, h) for c, h in x], "chunk_id string, content_checksum string") for x in ([("q0", "a"), ("q1", "b"), ("q2", "c")], [("r0", "x"), ("r1", "y")]))
    pairs = K.generate_pairs(q, r)
    assert pairs.count() == 6 and pairs.where("package_id = 'wp_q1_r0' AND state = 'PENDING' AND attempt = 0").count() == 1
    old = spark.createDataFrame([("q0", "a"), ("q1", "z"), ("q9", "c")], "chunk_id string, content_checksum string")
    assert {tuple(x) for x in K.diff_manifests(old, q).collect()} == {("q0", "unchanged"), ("q1", "modified"), ("q2", "added"), ("q9", "removed")}
    assert K.generate_pairs_incremental(old, q, r).count() == 4
    with pytest.raises(ValueError, match="q2 x r1"):
        K.require_pairs(pairs, pairs.where("package_id <> 'wp_q2_r1'"))
    K.require_pairs(pairs, pairs)


def test_alignment_finds_mutated_copies(spark):
    refs = FA.generate_sequences(spark, 30, "ref", 120, 160, seed=1)
    changed = F.expr("concat(substring(sequence, 11, 40), 'W', substring(sequence, 52, 50))")
    queries = refs.select(F.regexp_replace("id", "ref", "query").alias("id"), changed.alias("sequence"))
    out = A.align(queries, refs, "fast").collect()
    best = {r["query_id"]: r for r in sorted(out, key=lambda r: r["evalue"], reverse=True)}
    assert len(best) == 30 and all(best[q]["subject_id"] == q.replace("query", "ref") for q in best)
    r = best["query_00000"]
    assert r["subject_start"] - r["query_start"] == 10 and r["alignment_length"] >= 80 and r["percent_identity"] >= 95 and r["gap_opens"] == 0


def test_ungapped_extension_golden(spark):
    q = spark.createDataFrame([("q", "WWACDEFWW")], "id string, sequence string")
    s = spark.createDataFrame([("s", "KACDEFK")], "id string, sequence string")
    c = spark.createDataFrame([("q", "s", 1, 3)], "query_id string, subject_id string, diagonal int, n_seeds int")
    r = A.extend_ungapped(c, q, s).first()
    assert (r["query_start"], r["query_end"], r["subject_start"], r["subject_end"], r["score"], r["mismatches"]) == (3, 7, 2, 6, 25, 0)
    e = A.score_evalue(A.extend_ungapped(c, q, s), q, s).first()
    assert abs(e["bitscore"] - (0.3176 * 25 - -2.0099154790312257) / 0.6931471805599453) < 1e-6 and abs(e["evalue"] - 9 * 7 * 2 ** -e["bitscore"]) < 1e-9


def test_masking(spark):
    refs = spark.createDataFrame([(str(i), "AAAAAA" + c * 4) for i, c in enumerate("CDEF")], "id string, sequence string")
    index = A.seeds(refs, 4)
    assert A.mask_frequent_seeds(index, 3).where("seed = 'AAAA'").count() == 0 and A.mask_frequent_seeds(index, 4).count() == index.count()


def test_lineage_and_features(spark):
    nodes = spark.createDataFrame([(1, 1, "no rank"), (2, 1, "superkingdom"), (3, 2, "phylum"), (4, 3, "clade"), (5, 4, "genus"), (6, 5, "species")], "taxon_id long, parent_id long, rank string")
    names = nodes.select("taxon_id", F.concat(F.lit("n"), "taxon_id").alias("name"))
    lineage = T.resolve_lineage(nodes, names)
    r = lineage.where("taxon_id = 6").first()
    assert (r["species"], r["genus"], r["family"], r["phylum"], r["kingdom"]) == ("n6", "n5", None, "n3", "n2")
    merged = M.merge_raw(hits(spark, ("q1", "sp|A.1|x", 0.0, 9.0, "r"), ("q1", "B", 1e-10, 9.0, "r"), ("q2", "B", 1e-5, 9.0, "r")))
    acc = spark.createDataFrame([("A", 6)], "accession string, taxon_id long")
    enriched = T.enrich_hits(merged, acc, lineage)
    assert enriched.count() == 3 and enriched.where("phylum = 'n3'").count() == 1
    seqs = spark.createDataFrame([("q1", 200), ("q2", 50), ("q3", 10)], "id string, length int")
    f = {r["sequence_id"]: r for r in X.build_features(seqs, enriched).collect()}
    assert f["q1"]["hit_count"] == 2 and f["q1"]["mean_evalue_log10"] == -155.0 and f["q1"]["best_hit_query_coverage"] == 0.5 and f["q1"]["num_phyla"] == 1
    assert f["q2"]["std_alignment_length"] == 0.0 and f["q2"]["taxonomic_entropy"] == 0.0 and f["q2"]["best_hit_query_coverage"] == 2.0
    assert f["q3"]["hit_count"] == 0 and f["q3"]["mean_percent_identity"] is None
    assert X.build_features(seqs, enriched, keep_without_hits=False).count() == 2
    assert X.build_features(seqs, enriched, max_evalue=1e-8).where("sequence_id = 'q2' AND hit_count = 0").count() == 1


def test_entropy_in_bits(spark):
    merged = M.merge_raw(hits(spark, *[("q", f"s{i}", 1.0, 1.0, "r") for i in range(4)])).withColumn("phylum", F.col("subject_id")).withColumn("kingdom", F.lit("k"))
    assert abs(X.hit_features(merged).first()["taxonomic_entropy"] - 2.0) < 1e-9


def test_catalogue(spark):
    edges = spark.createDataFrame([("d", "b", "x"), ("d", "c", "x"), ("b", "a", "y"), ("c", "a", "y")], "child_id string, parent_id string, relationship string")
    up = sorted((r["dataset_id"], r["depth"]) for r in L.ancestry(edges, "d").collect())
    assert up == [("a", 2), ("a", 2), ("b", 1), ("c", 1)]
    edges.createOrReplaceTempView("edges_view")
    assert sorted((r["dataset_id"], r["depth"]) for r in L.ancestry_sql(spark, "edges_view", "d").collect()) == up
    assert {r["dataset_id"] for r in L.descendants(edges, "a").collect()} == {"b", "c", "d"}
    a = L.dataset_entry(edges, "e", "t", "p", "1", "r").first()
    b = L.dataset_entry(edges.orderBy("parent_id"), "e", "t", "p", "1", "r").first()
    assert a["checksum"] == b["checksum"] and a["row_count"] == 4


def test_run_log(spark):
    now = F.expr("TIMESTAMP '2026-01-01 00:10:00'")
    df = spark.sql("""SELECT * FROM VALUES ('p1', 'RUNNING', TIMESTAMP '2026-01-01 00:07:59', 0), ('p2', 'RUNNING', TIMESTAMP '2026-01-01 00:08:00', 1), ('p3', 'RUNNING', NULL, 2), ('p4', 'COMPLETED', NULL, 0)
      AS t(package_id, state, heartbeat_at, attempt)""").withColumns({"max_attempts": F.lit(3), "error_history": F.array().cast("array<string>"), "claimed_by": F.lit("w")})
    stale = R.stale_packages(df, now, 120)
    assert {r["package_id"] for r in stale.collect()} == {"p1", "p3"}
    after = {r["package_id"]: r for r in R.retry_or_poison(stale).collect()}
    assert after["p1"]["state"] == "PENDING" and after["p3"]["state"] == "POISONED" and after["p3"]["attempt"] == 3 and after["p1"]["claimed_by"] is None
    assert "never started" in after["p3"]["error_history"][0]
    assert {tuple(r) for r in R.state_counts(df).collect()} == {("PENDING", 0), ("RUNNING", 3), ("COMPLETED", 1), ("POISONED", 0)}
    assert R.progress_pct(df).first()[0] == 25.0 and R.progress_pct(df.limit(0)).first()[0] is None
    d = spark.createDataFrame([(0.5,), (1.0,), (7.0,), (700.0,)], "duration_s double")
    assert [r["n"] for r in R.duration_histogram(d).orderBy("le").collect()] == [2, 2, 3, 3, 3, 3, 3, 3, 4]
    lines = spark.createDataFrame([('{"package_id": "a", "state": "x"}',), ("{oops",), ('{"state": "x"}',)], "value string")
    good, bad = R.quarantine_corrupt(lines, "package_id string, state string", ["package_id"])
    assert [r["package_id"] for r in good.collect()] == ["a"] and bad.count() == 2


def test_merged_tables(spark, tmp_path):
    merged = M.merge_raw(hits(spark, ("q", "A", 1e-20, 200.0, "r1")))
    path = str(tmp_path / "merged")
    TB.write_merged(merged, path)
    TB.write_merged(merged, path)
    assert TB.read_merged(spark, path, "mm").count() == 1 and spark.sql("SELECT count(*) FROM mm WHERE global_rank = 1").first()[0] == 1


def test_merge_invariants(spark):
    """Dedup is idempotent, ranks are dense, and the best N are among the best N + 1."""
    import random

    r = random.Random(12)
    rows = [(f"q{r.randint(0, 4)}", f"s{r.randint(0, 9)}", 10.0 ** -r.randint(0, 6), float(r.randint(0, 5)), f"r{r.randint(0, 3)}") for _ in range(400)]
    renamed = M.rename_raw(hits(spark, *rows))
    once = M.dedup_best(renamed)
    assert M.dedup_best(once).exceptAll(once).count() == 0 and once.count() == len({x[:2] for x in rows})
    three, four = M.merge_hits(renamed, 3), M.merge_hits(renamed.repartition(7), 4)
    assert three.exceptAll(four).count() == 0
    ranks: dict[str, list[int]] = {}
    for x in four.collect():
        ranks.setdefault(x["query_id"], []).append(x["global_rank"])
    assert all(sorted(v) == [1, 2, 3, 4] for v in ranks.values())
    targets = M.limit_targets(renamed, 2).groupBy("query_id", "ref_chunk_id").agg(F.countDistinct("subject_id").alias("n"))
    assert targets.agg(F.max("n")).first()[0] <= 2


def test_histogram_and_correlations(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, -float(i)) for i in range(10)] + [(None, 1.0, 1.0)], "a double, b double, c double")
    assert {tuple(x) for x in X.feature_histogram(df, "a", 5, 0.0, 10.0).collect()} == {(k, 2) for k in range(1, 6)}
    got = {(x["a"], x["b"]): round(x["correlation"], 6) for x in X.feature_correlations(df.where("a IS NOT NULL"), ["a", "b", "c"]).collect()}
    assert got == {("a", "b"): 1.0, ("a", "c"): -1.0, ("b", "c"): -1.0}
    out = X.cluster_features(df, ["a", "b", "c"], 2)
    assert out.count() == 11 and out.select("cluster").distinct().count() == 2 and {"pc1", "pc2"} <= set(out.columns)


def test_taxdump(spark, tmp_path):
    for name, text in (("nodes", "1\t|\t1\t|\tno rank\t|\n2\t|\t1\t|\tphylum\t|\n"), ("names", "1\t|\troot\t|\t\t|\tscientific name\t|\n2\t|\tP\t|\t\t|\tscientific name\t|\n2\t|\tq\t|\t\t|\tsynonym\t|\n"), ("acc", "accession\taccession.version\ttaxid\tgi\nA1\tA1.1\t2\t0\n")):
        (tmp_path / name).write_text(text)
    nodes, names, acc = TB.scan_taxdump(spark, *[str(tmp_path / n) for n in ("nodes", "names", "acc")])
    assert {tuple(r) for r in nodes.collect()} == {(1, 1, "no rank"), (2, 1, "phylum")} and {tuple(r) for r in names.collect()} == {(1, "root"), (2, "P")}
    assert [tuple(r) for r in acc.collect()] == [("A1", 2)]
