"""Registered queries of the sequence-similarity operators, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.contracts import HITS_ENRICHED, HITS_MERGED, HITS_RAW, enforce_contract
from seqloom.functions import scalar as S
from seqloom.operators import align as A
from seqloom.operators import catalogue as L
from seqloom.operators import chunking as K
from seqloom.operators import features as X
from seqloom.operators import merge as M
from seqloom.operators import runlog as R
from seqloom.operators import taxonomy as T
from seqloom.plans import bindings as B
from seqloom.plans.views import register_views
from seqloom.sources import fasta as FA
from seqloom.sources import tables as TB
from seqloom.sources.scratch import scratch_path
from seqloom.streaming import runs as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _sixth(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with floating columns rounded to six places."""
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})


# --- merge -----------------------------------------------------------------------------------

def _hits_sql(query: str = "l_suppkey", subject: str = "l_partkey") -> str:
    return f"""SELECT {query}::VARCHAR AS query_id, {subject}::VARCHAR AS subject_id, 100 * (1 - l_discount) AS percent_identity, l_quantity::INT AS alignment_length,
    0 AS mismatches, 0 AS gap_opens, l_orderkey::INT AS query_start, (l_orderkey + l_quantity)::INT AS query_end, l_linenumber AS subject_start,
    (l_linenumber + l_quantity)::INT AS subject_end, l_extendedprice AS evalue, l_tax AS bitscore, 'q' || ({query} % 4) AS query_chunk_id, 'r' || l_linenumber AS ref_chunk_id FROM lineitem"""


_ORDER = "evalue NULLS LAST, bitscore DESC NULLS LAST"


def _merged_sql(top_n: int = 50, **kw: str) -> str:
    return f"""SELECT * EXCLUDE (d) FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {_ORDER}, subject_id, ref_chunk_id, query_start, subject_start)::INT AS global_rank FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id, subject_id ORDER BY {_ORDER}, ref_chunk_id, query_start, subject_start) AS d FROM ({_hits_sql(**kw)})) WHERE d = 1)
    WHERE global_rank <= {top_n}"""


@query(_merged_sql())
def m1_m6_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.ordered(M.merge_hits(B.hits(spark, sf_dir), 50))


@query(f"SELECT query_chunk_id, sum(n)::BIGINT AS rows_raw, sum(d)::BIGINT AS rows_deduped, sum(least(d, 50))::BIGINT AS rows_merged FROM (SELECT query_chunk_id, query_id, count(*) AS n, count(DISTINCT subject_id) AS d FROM ({_hits_sql()}) GROUP BY ALL) GROUP BY ALL")
def m7_merge_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.merge_stats(B.hits(spark, sf_dir), 50)


@query(f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {_ORDER}, subject_id, ref_chunk_id, query_start, subject_start)::INT AS global_rank FROM ({_hits_sql()})) WHERE global_rank <= 50")
def m9_rank_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.rank_only(B.hits(spark, sf_dir), 50)


@query(f"SELECT * FROM ({_hits_sql()}) WHERE evalue <= 20000")
def c13_significant_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.significant(B.hits(spark, sf_dir), 20000)


def _limited_sql(hits: str, n: int) -> str:
    """All hits of the best ``n`` subjects of each query and reference chunk."""
    return f"""SELECT h.* FROM ({hits}) h SEMI JOIN (
      SELECT query_id, ref_chunk_id, subject_id FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id, ref_chunk_id ORDER BY {_ORDER}, subject_id) AS n FROM (
          SELECT * FROM (SELECT query_id, ref_chunk_id, subject_id, evalue, bitscore, row_number() OVER (PARTITION BY query_id, ref_chunk_id, subject_id ORDER BY {_ORDER}) AS k FROM ({hits})) WHERE k = 1)) WHERE n <= {n}) b
    USING (query_id, ref_chunk_id, subject_id)"""


@query(_limited_sql(_hits_sql(subject="(l_partkey % 7)"), 3))
def a6_limit_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven subjects with many hits each, of which three stay with all their hits."""
    return M.limit_targets(B.hits(spark, sf_dir, subject="(l_partkey % 7)"), 3)


@query(f"SELECT query_id, subject_id, evalue FROM ({_merged_sql()}) WHERE global_rank = 1 ORDER BY evalue, query_id LIMIT 5")
def s11_s12_q1_merged_table_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged hits are written by query chunk, and the best five first hits are asked for in SQL."""
    path = scratch_path(spark, "merged")
    TB.write_merged(M.merge_hits(B.hits(spark, sf_dir), 50), path)
    TB.read_merged(spark, path, "merged_hits")
    return spark.sql("SELECT query_id, subject_id, evalue FROM merged_hits WHERE global_rank = 1 ORDER BY evalue, query_id LIMIT 5")


@query(f"SELECT query_chunk_id, ref_chunk_id, count(*) AS n, round(sum(evalue), 2) AS total FROM ({_hits_sql()}) GROUP BY ALL")
def s10_m1_hits_by_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits are written by pair of chunks; reading them all is the union over pairs."""
    path = scratch_path(spark, "hits")
    TB.write_hits(B.hits(spark, sf_dir), path)
    return TB.scan_hits_parquet(spark, path).groupBy("query_chunk_id", "ref_chunk_id").agg(F.count("*").alias("n"), F.round(F.sum("evalue"), 2).alias("total"))


@query(f"SELECT query_id, subject_id, round(percent_identity, 6) AS percent_identity, alignment_length, query_start, evalue, bitscore FROM ({_hits_sql()})")
def s4_c7_scan_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits are written as tabular text with a comment line's mark ahead of none, then scanned and renamed."""
    back = {b: a for a, b in S.RAW_TO_MERGED.items()}
    raw = B.hits(spark, sf_dir).select(*[F.col(c).alias(back[c]) for c in back])
    path = scratch_path(spark, "hits-text")
    raw.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in HITS_RAW.names])).write.text(path)
    hits = M.rename_raw(enforce_contract(TB.scan_hits(spark, path), HITS_RAW))
    return _sixth(hits.select("query_id", "subject_id", "percent_identity", "alignment_length", "query_start", "evalue", "bitscore"), "percent_identity")


# --- sequences, chunks, manifests, pairs -------------------------------------------------------

_SEQ = "SELECT {k}::VARCHAR AS id, {k} || ' text' AS description, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS sequence FROM {t}"
_DOCS, _BENCH = _SEQ.format(k="doc_id", t="documents"), _SEQ.format(k="item_id", t="benchmark")


def _limbs(column: str, n: int) -> str:
    parts = ", ".join(f"('0x' || substr(sha256({column}), {8 * k + 1}, 8))::BIGINT" for k in range(8))
    return f"list_reduce([0::BIGINT, {parts}], lambda a, x: (a * 4294967296 + x) % {n})"


def _chunks_sql(source: str = _DOCS, n: int = 7, prefix: str = "chunk_") -> str:
    return f"SELECT format('{prefix}{{:03d}}', {_limbs('id', n)}) AS chunk_id, id AS sequence_id, description, sequence, length(sequence)::INT AS length, sha256(sequence) AS content_hash FROM ({source})"


def _entries_sql(source: str = _DOCS, n: int = 7, prefix: str = "chunk_") -> str:
    row = "sha256(sequence_id || ':' || content_hash)"
    sums = ", ".join(f"sum(('0x' || substr({row}, {8 * k + 1}, 8))::BIGINT)::VARCHAR" for k in range(4))
    return f"SELECT chunk_id, count(*) AS num_sequences, sha256(concat_ws(':', {sums})) AS content_checksum FROM ({_chunks_sql(source, n, prefix)}) GROUP BY chunk_id"


#: The older version of the documents: those that nobody had labelled yet.
_OLD = f"SELECT * FROM ({_DOCS}) WHERE id NOT IN (SELECT doc_id::VARCHAR FROM labels)"


def _old(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = B.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id")).distinct()
    return B.documents(spark, sf_dir).join(labelled, "id", "left_anti")


def _entries(df: DataFrame, n: int = 7, prefix: str = "chunk_") -> DataFrame:
    return K.chunk_entries(K.chunk_sequences(df, n, prefix))


@query(_chunks_sql())
def k1_c1_c2_c4_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.chunk_sequences(B.documents(spark, sf_dir), 7)


@query(_entries_sql())
def k2_manifest_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entries(B.documents(spark, sf_dir))


@query(f"SELECT sum(num_sequences)::INT AS total_sequences, 7 AS num_chunks, greatest(1, sum(num_sequences) // 7)::INT AS chunk_size_target, count(*) AS n_entries, 'deterministic_hash' AS chunking_strategy FROM ({_entries_sql()})")
def s7_k2_manifest_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "manifest")
    TB.write_manifest(K.build_manifest(K.chunk_sequences(B.documents(spark, sf_dir), 7), 7, "run_1", ["documents"], "2026-01-01 00:00:00"), path)
    manifest = TB.read_manifest(spark, path)
    n = TB.manifest_entries(manifest).groupBy("run_id").agg(F.count("*").alias("n_entries"))
    return manifest.join(n, "run_id").select("total_sequences", "num_chunks", "chunk_size_target", "n_entries", "chunking_strategy")


@query("SELECT id, format('chunk_{:03d}', (row_number() OVER (ORDER BY id) - 1) // 100) AS chunk_id FROM (" + _DOCS + ")")
def k3_sequential_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.chunk_sequential(B.documents(spark, sf_dir), 100, ["id"]).select("id", "chunk_id")


@query(
    f"SELECT id, CASE WHEN id IN (SELECT doc_id::VARCHAR FROM labels) THEN 'lost' WHEN id::BIGINT % 7 = 3 THEN 'changed' ELSE 'copies' END AS problem FROM ({_DOCS}) "
    f"WHERE id IN (SELECT doc_id::VARCHAR FROM labels) OR id::BIGINT % 7 = 3 OR id::BIGINT % 11 = 5 UNION ALL SELECT 'b' || id, 'added' FROM ({_BENCH})"
)
def k4_round_trip_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against chunks of an older version, with some sequences changed, some doubled, and the benchmark among them."""
    n = F.col("id").cast("long")
    old = _old(spark, sf_dir).withColumn("sequence", F.when(n % 7 == 3, F.concat("sequence", F.lit("A"))).otherwise(F.col("sequence")))
    other = B.benchmark(spark, sf_dir).withColumn("id", F.concat(F.lit("b"), "id"))
    return K.verify_round_trip(B.documents(spark, sf_dir), K.chunk_sequences(old.unionByName(old.where(n % 11 == 5)).unionByName(other), 7))


@query(f"SELECT count(*) AS chunks, min(num_sequences) AS min_rows, max(num_sequences) AS max_rows, round(avg(num_sequences), 6) AS mean_rows, round(stddev_pop(num_sequences), 6) AS std_rows FROM ({_entries_sql()})")
def k5_chunk_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sixth(K.chunk_balance(_entries(B.documents(spark, sf_dir))), "mean_rows", "std_rows")


_PAIRS = "SELECT 'wp_' || q.chunk_id || '_' || r.chunk_id AS package_id, q.chunk_id AS query_chunk_id, r.chunk_id AS ref_chunk_id, 'PENDING' AS state, 0 AS attempt, 3 AS max_attempts FROM ({q}) q CROSS JOIN ({r}) r"
_DIFF = f"SELECT chunk_id, CASE WHEN a.chunk_id IS NULL THEN 'added' WHEN b.chunk_id IS NULL THEN 'removed' WHEN a.content_checksum <> b.content_checksum THEN 'modified' ELSE 'unchanged' END AS change FROM ({_entries_sql(_OLD, 97)}) a FULL JOIN ({_entries_sql(n=97)}) b USING (chunk_id)"
_REFS = _entries_sql(_BENCH, 3, "ref_")


@query(_PAIRS.format(q=_entries_sql(), r=_REFS))
def k6_c6_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.generate_pairs(_entries(B.documents(spark, sf_dir)), _entries(B.benchmark(spark, sf_dir), 3, "ref_"))


@query(_DIFF)
def k7_diff_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.diff_manifests(_entries(_old(spark, sf_dir), 97), _entries(B.documents(spark, sf_dir), 97))


@query(_PAIRS.format(q=f"SELECT chunk_id FROM ({_DIFF}) WHERE change IN ('added', 'modified')", r=_REFS))
def k8_incremental_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = _entries(B.benchmark(spark, sf_dir), 3, "ref_")
    return K.generate_pairs_incremental(_entries(_old(spark, sf_dir), 97), _entries(B.documents(spark, sf_dir), 97), refs)


_PACKAGES = f"""SELECT 'wp_' || event_id AS package_id, 'q' || (user_id % 10) AS query_chunk_id, 'r' || (event_id % 50) AS ref_chunk_id, {B.STATE_SQL} AS state, 'w' || user_id AS claimed_by,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END AS heartbeat_at, (event_id % 3)::INT AS attempt, 3 AS max_attempts, event_type, value AS duration_s, ts FROM events"""


#: Packages with a query chunk for each user, so that many pairs have none that is completed.
_FINE = _PACKAGES.replace("'q' || (user_id % 10)", "'q' || user_id")


@query(f"SELECT package_id, query_chunk_id, ref_chunk_id, 'PENDING' AS state, 0 AS attempt FROM ({_FINE}) p WHERE state <> 'COMPLETED' AND NOT EXISTS (SELECT 1 FROM ({_FINE}) d WHERE d.state = 'COMPLETED' AND d.query_chunk_id = p.query_chunk_id AND d.ref_chunk_id = p.ref_chunk_id)")
def k9_pairs_to_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = B.packages(spark, sf_dir).withColumn("query_chunk_id", F.expr("concat('q', substring(claimed_by, 2))"))
    return K.pairs_to_resume(packages).select("package_id", "query_chunk_id", "ref_chunk_id", "state", "attempt")


@query(f"SELECT DISTINCT q.query_chunk_id, r.ref_chunk_id FROM (SELECT DISTINCT 'q' || l_suppkey % 4 AS query_chunk_id FROM lineitem) q CROSS JOIN (SELECT DISTINCT 'r' || o_custkey % 9 AS ref_chunk_id FROM orders) r WHERE (q.query_chunk_id, r.ref_chunk_id) NOT IN (SELECT (query_chunk_id, ref_chunk_id) FROM ({_hits_sql()}))")
def k10_missing_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected: every query chunk against chunks r0 to r8; hits only come from r1 to r7."""
    hits = B.hits(spark, sf_dir)
    q = hits.select(F.col("query_chunk_id").alias("chunk_id")).distinct()
    r = B.table(spark, sf_dir, "orders").selectExpr("concat('r', o_custkey % 9) AS chunk_id").distinct()
    return K.missing_pairs(K.generate_pairs(q, r), hits)


@query(f"SELECT id, description, length(sequence)::INT AS length, sha256(sequence) AS content_hash, length(sequence) > 1000 AS too_long FROM ({_DOCS}) WHERE sequence <> ''")
def s1_s2_s3_s9_fasta_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' letters as FASTA lines of 80, scanned again; those without letters are set aside."""
    path = scratch_path(spark, "fasta")
    docs = B.documents(spark, sf_dir)
    docs.select(FA.fasta_text(F.col("description"), F.col("sequence"))).write.text(path)
    good, _ = FA.validate_sequences(FA.scan_records(spark, path), "quarantine")
    return FA.flag_long_sequences(good, 1000).select("id", "description", "length", S.content_hash(F.col("sequence")).alias("content_hash"), "too_long")


@query(f"SELECT chunk_id, sequence_id, length, content_hash FROM ({_chunks_sql()}) WHERE chunk_id IN ('chunk_001', 'chunk_004')")
def s6_s8_chunk_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks are written by chunk and two of them read: other partitions are pruned."""
    path = scratch_path(spark, "chunks")
    TB.write_chunks(K.chunk_sequences(B.documents(spark, sf_dir), 7), path)
    return TB.scan_chunks(spark, path, ["chunk_001", "chunk_004"]).select("chunk_id", "sequence_id", "length", "content_hash")


@query(f"SELECT greatest(1, ceil(count(*) / 64))::INT AS num_chunks FROM ({_DOCS})")
def c5_num_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.documents(spark, sf_dir).agg(S.num_chunks(F.count("*"), 64).alias("num_chunks"))


@query("SELECT s_suppkey, 'P' || s_suppkey AS accession FROM supplier")
def c10_accessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = B.table(spark, sf_dir, "supplier").withColumn("subject_id", F.expr("concat('sp|P', s_suppkey, '.2|', s_name)"))
    return ids.select("s_suppkey", S.extract_accession(F.col("subject_id")).alias("accession"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(log10(greatest(l_tax, 1e-300)), 6) AS log_e FROM lineitem")
def c11_log10_evalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(S.log10_evalue(F.col("l_tax")), 6).alias("log_e"))


@query(f"SELECT event_id, CASE {B.EXIT_SQL} WHEN 0 THEN 'ok' WHEN 137 THEN 'out_of_memory' WHEN -1 THEN 'timeout' ELSE 'error' END AS outcome FROM events")
def c9_exit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "events").select("event_id", S.classify_exit(F.expr(B.EXIT_SQL)).alias("outcome"))


# --- alignment --------------------------------------------------------------------------------

def _seeds_sql(source: str, k: int) -> str:
    return f"SELECT id, pos, substr(sequence, pos, {k}) AS seed FROM (SELECT id, sequence, unnest(range(1, length(sequence) - {k - 2})) AS pos FROM ({source}))"


@query(f"SELECT id, pos::INT AS pos, seed FROM ({_seeds_sql(_BENCH, 12)}) WHERE seed NOT IN (SELECT seed FROM ({_seeds_sql(_BENCH, 12)}) GROUP BY seed HAVING count(DISTINCT id) > 3)")
def a1_a2_seed_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = A.build_seed_index(B.benchmark(spark, sf_dir), 12, path=scratch_path(spark, "seeds"))
    return A.mask_frequent_seeds(index, 3).select("id", "pos", "seed")


@query(f"SELECT q.id AS query_id, s.id AS subject_id, (q.pos - s.pos)::INT AS diagonal, count(*) AS n_seeds FROM ({_seeds_sql(_DOCS, 12)}) q JOIN ({_seeds_sql(_BENCH, 12)}) s USING (seed) GROUP BY ALL HAVING count(*) >= 8")
def a3_seed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.seed_join(B.documents(spark, sf_dir), A.seeds(B.benchmark(spark, sf_dir), 12), 12, 8)


@query(f"SELECT q.id AS query_id, s.id AS subject_id, (q.pos - s.pos)::INT AS diagonal, count(*) AS n_seeds FROM ({_seeds_sql(_DOCS, 8)}) q JOIN ({_seeds_sql(_BENCH, 8)}) s USING (seed) GROUP BY ALL HAVING count(*) >= 6")
def a3_frequent_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short seeds, of which those at four or more places of the references are met by runs."""
    return A.seed_join(B.documents(spark, sf_dir), A.seeds(B.benchmark(spark, sf_dir), 8), 8, 6, often=4)


#: Letters of one group as its first one.
_REDUCED = "translate(sequence, 'AGPSTCDENQFWYHKRILMV', 'AAAAACDDDDFFFHHHIIII')"
#: Two letters score 5 if equal, 1 if in one group, else -2; letters that are no residue -2.
_POINTS = "CASE WHEN NOT contains('ACDEFGHIKLMNPQRSTVWY', a) OR NOT contains('ACDEFGHIKLMNPQRSTVWY', b) THEN -2 WHEN a = b THEN 5 WHEN translate(a, 'AGPSTCDENQFWYHKRILMV', 'AAAAACDDDDFFFHHHIIII') = translate(b, 'AGPSTCDENQFWYHKRILMV', 'AAAAACDDDDFFFHHHIIII') THEN 1 ELSE -2 END"


def _align_sql(queries: str, k: int, min_seeds: int, reduced: bool = False, limit: int = 50) -> str:
    """Hits of sequences against the benchmark: diagonals with enough seeds, the best stretch of each, and the best subjects."""
    letters = lambda source: f"SELECT id, {_REDUCED} AS sequence FROM ({source})" if reduced else source
    seeded = f"SELECT q.id AS query_id, s.id AS subject_id, (q.pos - s.pos)::INT AS diagonal FROM ({_seeds_sql(letters(queries), k)}) q JOIN ({_seeds_sql(letters(_BENCH), k)}) s USING (seed) GROUP BY ALL HAVING count(*) >= {min_seeds}"
    return f"""WITH c AS (SELECT c.*, q.sequence AS qs, s.sequence AS ss, greatest(0, -diagonal) AS b0 FROM ({seeded}) c JOIN ({queries}) q ON q.id = query_id JOIN ({_BENCH}) s ON s.id = subject_id),
col AS (SELECT query_id, subject_id, diagonal, b0, length(qs) AS m, unnest(range(1, least(length(ss) - b0, length(qs) - b0 - diagonal) + 1)) AS i, qs, ss FROM c),
pt AS (SELECT query_id, subject_id, diagonal, b0, m, i, a = b AS same, {_POINTS} AS p FROM (SELECT *, qs[b0 + diagonal + i] AS a, ss[b0 + i] AS b FROM col)),
pre AS (SELECT *, sum(p) OVER w AS total FROM pt WINDOW w AS (PARTITION BY query_id, subject_id, diagonal ORDER BY i)),
low AS (SELECT *, arg_min(i - 1, (total - p, -i)) OVER w AS begun, min(total - p) OVER w AS least FROM pre WINDOW w AS (PARTITION BY query_id, subject_id, diagonal ORDER BY i)),
best AS (SELECT query_id, subject_id, diagonal, any_value(b0) AS b0, any_value(m) AS m, max(total - least) AS score, arg_min(i, (least - total, i)) AS hi, arg_min(begun, (least - total, i)) AS lo FROM low GROUP BY ALL HAVING max(total - least) > 0),
same AS (SELECT query_id, subject_id, diagonal, count(*) FILTER (WHERE same) AS n FROM pt JOIN best b USING (query_id, subject_id, diagonal) WHERE i > lo AND i <= hi GROUP BY ALL),
bits AS (SELECT *, (0.3176 * score - ln(0.134)) / ln(2.0) AS bitscore FROM best JOIN same USING (query_id, subject_id, diagonal)),
hit AS (SELECT * FROM (SELECT *, m * (SELECT sum(length(sequence)) FROM ({_BENCH})) * pow(2.0, -bitscore) AS evalue FROM bits) WHERE evalue <= 10),
top AS (SELECT query_id, subject_id, row_number() OVER (PARTITION BY query_id ORDER BY e, b DESC, subject_id) AS place FROM (SELECT query_id, subject_id, min(evalue) AS e, max(bitscore) AS b FROM hit GROUP BY ALL))
SELECT query_id, subject_id, (hi - lo)::INT AS alignment_length, (hi - lo - n)::INT AS mismatches, (b0 + diagonal + lo + 1)::INT AS query_start, (b0 + lo + 1)::INT AS subject_start, score::INT AS score,
  round(100.0 * n / (hi - lo), 6) AS percent_identity, round(bitscore, 4) AS bitscore, round(log10(evalue + 1e-300), 4) AS log_evalue FROM hit JOIN top USING (query_id, subject_id) WHERE place <= {limit}"""


def _aligned(hits: DataFrame) -> DataFrame:
    return hits.select(
        "query_id", "subject_id", "alignment_length", "mismatches", "query_start", "subject_start", "score", F.round("percent_identity", 6).alias("percent_identity"),
        F.round("bitscore", 4).alias("bitscore"), F.round(F.log10(F.col("evalue") + 1e-300), 4).alias("log_evalue"),
    )


def _register_presets() -> None:
    """A query for each preset of sensitivity: all benchmark items against each other, ten subjects each."""
    for name, p in A.PRESETS.items():

        def preset(spark: SparkSession, sf_dir: str, name: str = name) -> DataFrame:
            items = B.benchmark(spark, sf_dir)
            return _aligned(A.align(items, items, name, max_target_seqs=10))

        preset.__name__ = f"a7_{name.replace('-', '_')}"
        query(_align_sql(_BENCH, p.k, p.min_seeds, p.reduced, 10))(preset)


_register_presets()


@query(_align_sql(_DOCS, 16, 8))
def a3_a7_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items, with seeds of 16 letters and eight of them on a diagonal."""
    return _aligned(A.align(B.documents(spark, sf_dir), B.benchmark(spark, sf_dir), A.Sensitivity(16, False, 8)))


# --- taxonomy and features ----------------------------------------------------------------------

_KEY = {"query": "l_partkey", "subject": "l_suppkey"}
_LINEAGE = """SELECT 1000 + s_suppkey AS taxon_id, s_name AS species, n_name AS phylum, r_name AS kingdom FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
  UNION ALL SELECT 100 + n_nationkey, NULL, n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey
  UNION ALL SELECT 10 + r_regionkey, NULL, NULL, r_name FROM region UNION ALL SELECT 1, NULL, NULL, NULL"""
_ENRICHED = f"SELECT h.*, l.taxon_id, species, phylum, kingdom FROM ({_merged_sql(50, **_KEY)}) h LEFT JOIN ({_LINEAGE}) l ON l.taxon_id = 1000 + h.subject_id::BIGINT"


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, names, accessions = B.taxonomy(spark, sf_dir)
    merged = M.merge_hits(B.hits(spark, sf_dir, **_KEY), 50)
    return enforce_contract(T.enrich_hits(merged, accessions, T.resolve_lineage(nodes, names)), HITS_ENRICHED)


@query(_LINEAGE)
def t1_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, names, _ = B.taxonomy(spark, sf_dir)
    return T.resolve_lineage(nodes, names).select("taxon_id", "species", "phylum", "kingdom")


@query(_ENRICHED)
def t2_enriched_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir).select(*HITS_MERGED.names, "taxon_id", "species", "phylum", "kingdom")


@query(f"SELECT query_id, phylum, count(*) AS hit_count, round(avg(percent_identity), 6) AS mean_identity, min(evalue) AS best_evalue FROM ({_ENRICHED}) GROUP BY ALL")
def t3_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sixth(T.taxonomic_profile(_enriched(spark, sf_dir)), "mean_identity")


@query(f"SELECT query_id, count(DISTINCT phylum) AS num_phyla FROM ({_ENRICHED}) GROUP BY ALL HAVING count(DISTINCT phylum) > 5")
def t4_broad_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.broad_reach(_enriched(spark, sf_dir), 5)


_FEATURES = f"""WITH e AS ({_ENRICHED}),
p AS (SELECT query_id, phylum, count(*) AS n FROM e WHERE phylum IS NOT NULL GROUP BY ALL),
h AS (SELECT query_id, -sum(f * log2(f)) AS entropy FROM (SELECT query_id, n / sum(n) OVER (PARTITION BY query_id) AS f FROM p) GROUP BY ALL),
g AS (SELECT query_id, count(*)::INT AS hit_count, avg(percent_identity) AS a, max(percent_identity) AS b, avg(log10(greatest(evalue, 1e-300))) AS c, avg(alignment_length) AS d, stddev_pop(alignment_length) AS s,
  arg_min(alignment_length, global_rank) AS best, count(DISTINCT phylum)::INT AS num_phyla, count(DISTINCT kingdom)::INT AS num_kingdoms FROM e GROUP BY ALL)
SELECT p_partkey::VARCHAR AS sequence_id, coalesce(hit_count, 0) AS hit_count, round(a, 5) AS mean_percent_identity, round(b, 5) AS max_percent_identity, round(c, 5) AS mean_evalue_log10,
  round(d, 5) AS mean_alignment_length, round(s, 5) AS std_alignment_length, round(best / p_size, 5) AS best_hit_query_coverage, abs(round(coalesce(entropy, 0), 5)) AS taxonomic_entropy,
  coalesce(num_phyla, 0) AS num_phyla, coalesce(num_kingdoms, 0) AS num_kingdoms
FROM part LEFT JOIN g ON g.query_id = p_partkey::VARCHAR LEFT JOIN h ON h.query_id = g.query_id"""


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = B.table(spark, sf_dir, "part").selectExpr("cast(p_partkey AS string) AS id", "p_size AS length")
    return X.build_features(parts, _enriched(spark, sf_dir))


_DOUBLES = ["mean_percent_identity", "max_percent_identity", "mean_evalue_log10", "mean_alignment_length", "std_alignment_length", "best_hit_query_coverage", "taxonomic_entropy"]


@query(_FEATURES)
def f1_f11_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir).withColumns({c: F.round(c, 5) for c in _DOUBLES})


@query("SELECT doc_id::VARCHAR AS sequence_id, vec_id IS NOT NULL AS has_vector, list_aggregate(list_transform(embedding, lambda x: floor(x::DOUBLE * 1000)::INT::VARCHAR), 'string_agg', ' ') AS vector FROM documents LEFT JOIN embeddings ON vec_id = doc_id")
def f12_s17_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's vector, its values in thousandths."""
    vectors = TB.scan_embeddings(spark, f"{sf_dir}/embeddings.parquet", 64, "vec_id")
    docs = B.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("sequence_id"))
    values = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000).cast("string"))
    return X.join_embeddings(docs, vectors, 64).select("sequence_id", F.col("embedding").isNotNull().alias("has_vector"), F.array_join(values, " ").alias("vector"))


@query(f"SELECT sequence_id, hit_count, 'v1' AS feature_version, 'run_1' AS run_id FROM ({_FEATURES})")
def f13_s18_versioned_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "features")
    TB.write_features(X.stamp_version(_features(spark, sf_dir), "v1", "run_1", "2026-01-01 00:00:00"), path)
    return spark.read.parquet(path).select("sequence_id", "hit_count", "feature_version", "run_id")


@query(f"SELECT CASE WHEN hit_count < 0 THEN 0 WHEN hit_count >= 50 THEN 11 ELSE hit_count // 5 + 1 END::BIGINT AS bin, count(*) AS n FROM ({_FEATURES}) GROUP BY ALL")
def f14_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.feature_histogram(_features(spark, sf_dir), "hit_count", 10, 0, 50)


@query(f"SELECT 'hit_count' AS a, 'num_phyla' AS b, round(corr(hit_count, num_phyla), 5) AS correlation FROM ({_FEATURES}) UNION ALL SELECT 'hit_count', 'mean_alignment_length', round(corr(hit_count, mean_alignment_length), 5) FROM ({_FEATURES}) UNION ALL SELECT 'num_phyla', 'mean_alignment_length', round(corr(num_phyla, mean_alignment_length), 5) FROM ({_FEATURES})")
def f15_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _features(spark, sf_dir).withColumns({c: F.round(c, 5) for c in _DOUBLES})
    return X.feature_correlations(base, ["hit_count", "num_phyla", "mean_alignment_length"]).withColumn("correlation", F.round("correlation", 5))


@query()
def f16_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "features")
    _features(spark, sf_dir).write.parquet(path)
    return X.cluster_features(spark.read.parquet(path), ["hit_count", "num_phyla", "mean_alignment_length"], 4).select("sequence_id", "cluster", "pc1", "pc2")


@query("SELECT taxon_id, parent_id, rank, name FROM (SELECT 1000 + s_suppkey AS taxon_id, 100 + s_nationkey AS parent_id, 'species' AS rank, s_name AS name FROM supplier UNION ALL SELECT 100 + n_nationkey, 10 + n_regionkey, 'phylum', n_name FROM nation UNION ALL SELECT 10 + r_regionkey, 1, 'kingdom', r_name FROM region UNION ALL SELECT 1, 1, 'no rank', 'root')")
def s16_taxdump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The taxonomy is written in dump format and scanned again."""
    tree, named, _ = _scanned_dump(spark, sf_dir)
    return tree.join(named, "taxon_id")


@query("SELECT s_suppkey::VARCHAR AS accession, 1000 + s_suppkey AS taxon_id FROM supplier")
def s16_accessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dump's accession map, from a gzip file."""
    return _scanned_dump(spark, sf_dir)[2]


def _scanned_dump(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    nodes, names, accessions = B.taxonomy(spark, sf_dir)
    paths = [scratch_path(spark, n) for n in ("nodes", "names", "accessions")]
    nodes.selectExpr("concat(taxon_id, '\t|\t', parent_id, '\t|\t', rank, '\t|')").write.text(paths[0])
    names.selectExpr("concat(taxon_id, '\t|\t', name, '\t|\t\t|\tscientific name\t|')").write.text(paths[1])
    accessions.selectExpr("accession", "concat(accession, '.1') AS `accession.version`", "taxon_id AS taxid", "'0' AS gi").write.option("sep", "\t").option("header", True).option("compression", "gzip").csv(paths[2])
    return TB.scan_taxdump(spark, *paths)


# --- catalogue ------------------------------------------------------------------------------------

_EDGES = "SELECT 'o' || o_orderkey AS child_id, 'c' || o_custkey AS parent_id, 'ordered_by' AS relationship FROM orders UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 'lives_in' FROM customer UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'part_of' FROM nation"
_RUNS = "SELECT 'run' || user_id AS run_id, event_type AS status, ts AS updated_at FROM events"


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "events").selectExpr("concat('run', user_id) AS run_id", "event_type AS status", "ts AS updated_at", "ts AS started_at", "ts + make_interval(0, 0, 0, 0, 0, 0, floor(value)) AS completed_at")


def _datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "customer").selectExpr("concat('c', c_custkey) AS dataset_id", "concat('run', c_custkey % 200) AS created_by_run", "cast(c_custkey AS long) AS row_count")


@query("SELECT dataset_id, row_count FROM (SELECT 'lineitem' AS dataset_id, count(*) AS row_count FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders)")
def l1_register_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "datasets")
    for name in ("lineitem", "orders"):
        L.register(L.dataset_entry(B.table(spark, sf_dir, name), name, "table", f"{sf_dir}/{name}.parquet", "1", "run_1"), path)
    return spark.read.parquet(path).select("dataset_id", "row_count")


@query(f"SELECT child_id, parent_id, CASE WHEN child_id LIKE 'c%' THEN 'a_' || relationship ELSE relationship END AS relationship FROM ({_EDGES}) GROUP BY ALL")
def l2_lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges twice, the second time under another name: before the first one for customers, behind it for others."""
    edges = B.lineage_edges(spark, sf_dir)
    again = edges.withColumn("relationship", F.concat(F.when(F.col("child_id").startswith("c"), "a_").otherwise("z_"), "relationship"))
    return L.lineage_edges(edges.unionByName(again))


@query(f"SELECT run_id, arg_max(status, updated_at) AS status FROM ({_RUNS}) GROUP BY ALL")
def l3_latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.latest_runs(_runs(spark, sf_dir)).select("run_id", "status")


_UP = f"""WITH RECURSIVE edge AS ({_EDGES}), up AS (
  SELECT parent_id AS dataset_id, relationship, 1 AS depth FROM edge WHERE child_id = 'o5'
  UNION ALL SELECT e.parent_id, e.relationship, up.depth + 1 FROM edge e JOIN up ON e.child_id = up.dataset_id WHERE up.depth < 10) SELECT * FROM up"""


@query(_UP)
def l4_ancestry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.ancestry(B.lineage_edges(spark, sf_dir), "o5")


@query(_UP)
def l4_ancestry_recursive_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    B.lineage_edges(spark, sf_dir).createOrReplaceTempView("lineage_edges")
    return L.ancestry_sql(spark, "lineage_edges", "o5")


@query(f"""WITH RECURSIVE edge AS ({_EDGES}), down AS (
  SELECT child_id AS dataset_id, relationship, 1 AS depth FROM edge WHERE parent_id = 'r0'
  UNION ALL SELECT e.child_id, e.relationship, down.depth + 1 FROM edge e JOIN down ON e.parent_id = down.dataset_id WHERE down.depth < 10) SELECT * FROM down""")
def l5_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.descendants(B.lineage_edges(spark, sf_dir), "r0")


@query(f"SELECT query_id AS sequence_id, query_chunk_id AS chunk_id, count(*) AS n_hits, TRUE AS has_features FROM ({_merged_sql()}) GROUP BY ALL")
def l5_row_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = M.merge_hits(B.hits(spark, sf_dir), 50)
    chunks = merged.select(F.col("query_id").alias("sequence_id"), F.col("query_chunk_id").alias("chunk_id")).distinct()
    return L.row_provenance(chunks, merged, chunks).drop("ref_chunks")


@query(f"""WITH RECURSIVE edge AS ({_EDGES}), down AS (SELECT child_id AS id FROM edge WHERE parent_id = 'r0' UNION SELECT e.child_id FROM edge e JOIN down ON e.parent_id = down.id)
  SELECT run_id, arg_max(status, updated_at) AS status FROM ({_RUNS}) WHERE run_id IN (SELECT 'run' || c_custkey % 200 FROM customer WHERE 'c' || c_custkey IN (SELECT id FROM down)) GROUP BY ALL""")
def l6_runs_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that made customers of a region, two steps away from it."""
    return L.runs_using(_runs(spark, sf_dir), _datasets(spark, sf_dir), B.lineage_edges(spark, sf_dir), "r0").select("run_id", "status")


@query(f"SELECT r.run_id, r.status, coalesce(n, 0) AS n_datasets, coalesce(s, 0)::BIGINT AS rows_written FROM (SELECT run_id, arg_max(status, updated_at) AS status FROM ({_RUNS}) GROUP BY ALL) r LEFT JOIN (SELECT 'run' || c_custkey % 200 AS run_id, count(*) AS n, sum(c_custkey) AS s FROM customer GROUP BY ALL) d USING (run_id)")
def l7_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.run_summary(_runs(spark, sf_dir), _datasets(spark, sf_dir)).drop("seconds")


@query(f"SELECT 'sha256:' || sha256(string_agg(sequence || chr(10), '' ORDER BY id)) AS checksum, sum(length(sequence) + 1)::BIGINT AS n_bytes FROM ({_DOCS}) JOIN (SELECT doc_id::VARCHAR AS id, lang FROM documents) USING (id) GROUP BY lang")
def c3_file_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' letters, a text file for each language, and the files' checksums; those of over 100 kB are read by lines."""
    path = scratch_path(spark, "letters")
    lang = B.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "lang")
    lines = B.documents(spark, sf_dir).join(lang, "id").repartition("lang").sortWithinPartitions("lang", "id")
    lines.select("lang", "sequence").write.partitionBy("lang").text(path)
    return TB.file_checksums(spark, f"{path}/*/*.txt", whole=100_000).select("checksum", "n_bytes")


@query(f"SELECT query_id, subject_id, evalue, 0 AS global_rank FROM ({_hits_sql()}) WHERE evalue < 0")
def m8_merge_of_no_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits below an impossible e-value: none, merged, keep the merged columns."""
    return M.merge_hits(B.hits(spark, sf_dir).where("evalue < 0"), 50).select("query_id", "subject_id", "evalue", "global_rank")


@query("SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL")
def q1_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(spark, {t: f"{sf_dir}/{t}.parquet" for t in ("customer", "nation")})
    return spark.sql("SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name")


# --- run log -----------------------------------------------------------------------------------------

_NOW = "TIMESTAMP '2024-01-31 00:00:00'"
_WORK = f"SELECT 'w' || user_id AS worker_id, ts, value AS duration_s, {B.EXIT_SQL} AS exit_code, floor(value)::BIGINT AS hits, event_id % 7 AS sequences FROM events"


@query(f"SELECT s.state, count(p.state) AS n FROM (VALUES ('PENDING'), ('RUNNING'), ('COMPLETED'), ('POISONED')) s(state) LEFT JOIN ({_PACKAGES}) p USING (state) GROUP BY ALL")
def r1_state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.state_counts(B.packages(spark, sf_dir))


@query(f"SELECT 'wp_' || user_id AS package_id, arg_max({B.STATE_SQL}, (ts, event_id)) AS state, max(ts) AS since FROM events GROUP BY ALL")
def r2_s15_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transitions are written as JSON lines and scanned; each package's last one counts."""
    path = scratch_path(spark, "audit")
    B.audit_events(spark, sf_dir).write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    return R.latest_state(TB.scan_audit_log(spark, path))


@query(f"SELECT round(100.0 * count(*) FILTER (WHERE state = 'COMPLETED') / count(*), 6) AS progress_pct FROM ({_PACKAGES})")
def r3_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sixth(R.progress_pct(B.packages(spark, sf_dir)), "progress_pct")


@query(f"SELECT package_id, CASE WHEN heartbeat_at IS NULL THEN 'heartbeat never started, timeout 86400s' ELSE 'heartbeat stale: last seen ' || strftime(heartbeat_at, '%Y-%m-%dT%H:%M:%S') || ', timeout 86400s' END AS reason FROM ({_PACKAGES}) WHERE state = 'RUNNING' AND (heartbeat_at IS NULL OR epoch({_NOW}) - epoch(heartbeat_at) > 86400)")
def r4_stale_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.stale_packages(B.packages(spark, sf_dir), F.expr(_NOW), 86400).select("package_id", "reason")


@query(f"SELECT package_id, CASE WHEN attempt + 1 >= 3 THEN 'POISONED' ELSE 'PENDING' END AS state, attempt + 1 AS attempt, 2::BIGINT AS n_errors FROM ({_PACKAGES}) WHERE state = 'RUNNING'")
def r5_retry_or_poison(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = B.packages(spark, sf_dir).where("state = 'RUNNING'").withColumn("reason", F.lit("heartbeat stale"))
    return R.retry_or_poison(failed).select("package_id", "state", "attempt", F.size("error_history").cast("long").alias("n_errors"))


@query("SELECT event_type, le, count(*) FILTER (WHERE value <= le) AS n FROM events CROSS JOIN (VALUES (1.0::DOUBLE), (5), (10), (30), (60), (120), (300), (600), ('inf'::DOUBLE)) b(le) GROUP BY ALL")
def r6_duration_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.duration_histogram(B.table(spark, sf_dir, "events").selectExpr("event_type", "value AS duration_s"), ["event_type"])


@query("SELECT time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '2000-01-01') AS window_start, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY ALL")
def r7_duration_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sixth(R.duration_quantiles(B.runs(spark, sf_dir)), "p50", "p95", "p99")


@query(f"SELECT date_trunc('minute', ts) AS window_start, round(sum(hits) / 60, 6) AS hits_per_s, round(sum(sequences) / 60, 6) AS sequences_per_s FROM ({_WORK}) GROUP BY ALL")
def r8_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sixth(R.throughput(B.runs(spark, sf_dir)), "hits_per_s", "sequences_per_s")


@query(f"SELECT CASE WHEN exit_code = 137 THEN 'oom' ELSE 'diamond_error' END AS error_type, count(*) AS n FROM ({_WORK}) WHERE exit_code <> 0 GROUP BY ALL")
def r9_errors_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.errors_by_type(B.runs(spark, sf_dir))


@query(f"SELECT date_trunc('minute', ts) AS window_start, exit_code, count(*) AS n, round(count(*) / 60, 6) AS per_s FROM ({_WORK}) GROUP BY ALL")
def r9_exit_code_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sixth(R.exit_codes(B.runs(spark, sf_dir)), "per_s")


@query(f"SELECT round(sum(duration_s) * 0.0464 / 3600, 6) AS cost, round(sum(duration_s) * 0.0464 / 3600 * 1e6 / sum(sequences), 4) AS cost_per_million FROM ({_WORK})")
def r10_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.cost_estimate(B.runs(spark, sf_dir)).select(F.round("cost", 6).alias("cost"), F.round("cost_per_million", 4).alias("cost_per_million"))


@query(f"SELECT remaining, workers, round(remaining * m / greatest(workers, 1), 4) AS eta_s, round(remaining * m * 0.0464 / 3600, 6) AS cost_left FROM (SELECT count(*) FILTER (WHERE state IN ('PENDING', 'RUNNING')) AS remaining, avg(duration_s) FILTER (WHERE state = 'COMPLETED') AS m, count(DISTINCT claimed_by) FILTER (WHERE state = 'RUNNING') AS workers FROM ({_PACKAGES}))")
def r11_eta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.eta(B.packages(spark, sf_dir)).select("remaining", "workers", F.round("eta_s", 4).alias("eta_s"), F.round("cost_left", 6).alias("cost_left"))


@query(f"SELECT ts AS timestamp, event_id::INT AS attempt, {B.STATE_SQL} AS to_state, event_type AS reason FROM events WHERE user_id = 8")
def r12_package_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.package_history(B.audit_events(spark, sf_dir), "wp_8").select("timestamp", "attempt", "to_state", "reason")


@query("SELECT 'wp_' || event_id AS package_id, 0 AS attempt, event_type AS reason FROM events")
def r12_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.attempts(B.packages(spark, sf_dir))


@query(f"SELECT worker_id, count(*) AS packages, count(*) FILTER (WHERE exit_code <> 0) AS errors, round(sum(duration_s), 4) AS seconds FROM ({_WORK}) GROUP BY ALL")
def r13_worker_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.worker_summary(B.runs(spark, sf_dir)).withColumn("seconds", F.round("seconds", 4))


@query(f"SELECT date_trunc('hour', ts) AS window_start, count(DISTINCT worker_id) AS workers FROM ({_WORK}) GROUP BY ALL")
def r13_active_workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.active_workers(B.runs(spark, sf_dir))


@query(f"SELECT claimed_by AS worker_id, round(epoch({_NOW}) - epoch(max(heartbeat_at)), 3) AS age_s FROM ({_PACKAGES}) GROUP BY ALL")
def r14_heartbeat_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.heartbeat_age(B.packages(spark, sf_dir), F.expr(_NOW)).withColumn("age_s", F.round("age_s", 3))


@query("SELECT event_id FROM events WHERE event_type <> 'error'")
def r15_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines, of which those of errors are cut off in the middle; the whole ones come back."""
    line = F.to_json(F.struct("event_id", "event_type"))
    path = scratch_path(spark, "packages")
    events = B.table(spark, sf_dir, "events")
    events.select(F.when(F.col("event_type") == "error", F.expr("substring(to_json(struct(event_id, event_type)), 1, 9)")).otherwise(line)).write.text(path)
    good, _ = R.quarantine_corrupt(spark.read.text(path), "event_id long, event_type string", ["event_id", "event_type"])
    return good.select("event_id")


# --- streams ------------------------------------------------------------------------------------------

def _run_to_table(spark: SparkSession, stream: DataFrame, name: str, mode: str) -> DataFrame:
    """Run a stream until all input is read; ``complete`` results replace the table, others are appended."""
    path = scratch_path(spark, name)
    # A batch that is run again after a failure replaces what it wrote before.
    place = (lambda _: f"{path}/last") if mode == "complete" else (lambda batch: f"{path}/batch-{batch}")
    q = (
        stream.writeStream.outputMode(mode).foreachBatch(lambda df, batch: df.write.mode("overwrite").parquet(place(batch)))
        .option("checkpointLocation", scratch_path(spark, f"{name}-log")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.schema(stream.schema).option("recursiveFileLookup", True).parquet(path)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return B.utc(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]"))  # a pattern may also match a single file


@query(f"SELECT date_trunc('minute', ts) AS window_start, count(*) AS packages, count(*) FILTER (WHERE exit_code = 0) AS completed, round(100.0 * count(*) FILTER (WHERE exit_code = 0) / count(*), 6) AS progress_pct, round(sum(hits) / 60, 6) AS hits_per_s, count(*) FILTER (WHERE exit_code <> 0) AS errors FROM ({_WORK}) GROUP BY ALL")
def st1_stream_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _event_stream(spark, sf_dir).selectExpr("ts", f"{B.EXIT_SQL} AS exit_code", "cast(floor(value) AS long) AS hits")
    return _sixth(_run_to_table(spark, ST.stream_run_metrics(runs), "metrics", "complete"), "progress_pct", "hits_per_s")


#: Documents as records of a stream: some have a digit in the sequence, some no header, some stand behind a line of junk in a file of their own.
_STREAMED = f"""SELECT id, CASE WHEN id::BIGINT % 9 = 1 THEN '' ELSE description END AS description, CASE WHEN id::BIGINT % 9 = 2 THEN sequence || '1' ELSE sequence END AS sequence, id::BIGINT % 9 AS kind
  FROM ({_DOCS})"""


def _ingested(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    path = scratch_path(spark, "fasta")
    n = F.col("id").cast("long") % 9
    docs = B.documents(spark, sf_dir).withColumn("description", F.when(n == 1, "").otherwise(F.col("description"))).withColumn("sequence", F.when(n == 2, F.concat("sequence", F.lit("1"))).otherwise(F.col("sequence")))
    text = FA.fasta_text(F.col("description"), F.col("sequence"))
    docs.where(n != 3).select(text).write.text(path)
    # A file of its own for each of these, in packs: so many files one by one are what a store is slowest at.
    packs = scratch_path(spark, "fasta-packs")
    docs.where(n == 3).select(F.concat(F.lit("junk-"), "id").alias("path"), F.concat(F.lit("junk ahead of "), "id", F.lit("\n"), text, F.lit("\n")).alias("content")).write.parquet(packs)
    return ST.ingest_fasta(spark, path, 7, scratch_path(spark, "ingested"), scratch_path(spark, "ingested-log"), packs=packs)


@query(_chunks_sql(f"SELECT * FROM ({_STREAMED}) WHERE sequence <> '' AND kind NOT IN (1, 2)"))
def st3_stream_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir)[0]


@query(f"""SELECT nullif(description, '') AS description, CASE WHEN kind = 1 THEN 'empty header' WHEN sequence = '' THEN 'header without sequence' ELSE 'invalid amino acid characters: 1' END AS reason FROM ({_STREAMED}) WHERE kind IN (1, 2) OR sequence = ''
  UNION ALL SELECT NULL, 'data before any FASTA header' FROM ({_STREAMED}) WHERE kind = 3""")
def st3_stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir)[1].select(F.nullif("description", F.lit("")).alias("description"), "reason")


@query(f"SELECT id, description, length(sequence)::INT AS length FROM ({_DOCS}) WHERE sequence <> '' ORDER BY id LIMIT 10")
def s14_head_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten records of a FASTA folder whose files are in order of id."""
    path = scratch_path(spark, "fasta")
    docs = B.documents(spark, sf_dir).where("sequence <> ''").orderBy("id")
    docs.select(FA.fasta_text(F.col("description"), F.col("sequence"))).write.text(path)
    return FA.head_fasta(spark, path, 10).select("id", "description", "length")


@query("SELECT 'wp_' || user_id AS package_id, date_trunc('millisecond', max(ts)) AS last_seen, 120::BIGINT AS timeout_s FROM events GROUP BY user_id HAVING epoch_ms(max(ts)) + 120001 <= (SELECT epoch_ms(max(ts)) - 10000 FROM events)")
def st2_stream_stale_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as heartbeats, a user being a package: those not heard of for 120 seconds when the stream ends."""
    key, provider = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(key)
    spark.conf.set(key, provider)  # keyed state with timers needs it
    try:
        beats = _event_stream(spark, sf_dir).selectExpr("concat('wp_', user_id) AS package_id", "'RUNNING' AS state", "ts")
        return _run_to_table(spark, ST.stream_stale_packages(beats, 120), "stale", "append")
    finally:
        spark.conf.set(key, before)
