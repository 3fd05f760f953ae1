"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm import bpe, decontamination, exact_dedup, fuzzy_lines, lm_scoring, mixing, quality, rlz, simhash, suffix_dedup, token_alignment, token_counts, va_clusters

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(_documents(spark, sf_dir))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.remove_repeated_bytes(_documents(spark, sf_dir))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_plan(_documents(spark, sf_dir), max_repetition=1.25).drop("text_hash")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts before and after private data is replaced."""
    return token_counts.count_with_edits(_documents(spark, sf_dir), token_counts.pattern_edits(token_counts.PRIVATE, "<private>"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rlz.remove_repeated_words(_documents(spark, sf_dir))
    return rows.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_documents(spark, sf_dir))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_duplicates(_documents(spark, sf_dir), keep="largest")
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.fuzzy_line_groups(_documents(spark, sf_dir))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return lm_scoring.score(docs, lm_scoring.train(docs))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_va_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_clusters.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=40, rounds=5, dim=64)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.token_alignment(_documents(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {
        "op1_simhash_near_dedup": op1_simhash_near_dedup,
        "op2_suffix_array_dedup": op2_suffix_array_dedup,
        "op3_mixing": op3_mixing,
        "op4_bpe": op4_bpe,
        "op5_token_counts": op5_token_counts,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_quality_rules": op7_quality_rules,
        "op8_fuzzy_lines": op8_fuzzy_lines,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_lm_scoring": op10_lm_scoring,
        "op11_decontamination": op11_decontamination,
        "op12_va_clusters": op12_va_clusters,
        "op13_token_alignment": op13_token_alignment,
    }


#: A text's words in DuckDB.
_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The exponent is bisected 50 times; B is all tokens, so a source is repeated weight / share times.
OP3_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS source, len({_WORDS})::BIGINT AS tokens FROM documents),
src AS (SELECT source, sum(tokens)::BIGINT AS n FROM d GROUP BY source),
tot AS (SELECT sum(n)::BIGINT AS total FROM src),
p AS (SELECT list(n / total ORDER BY source) AS share FROM src, tot WHERE n > 0),
b AS (
  SELECT 0 AS it, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high, share FROM p
  UNION ALL
  SELECT it + 1, CASE WHEN met THEN low ELSE (low + high) / 2 END, CASE WHEN met THEN (low + high) / 2 ELSE high END, share
  FROM (SELECT *, list_max(list_transform(share, lambda s: pow(s, (low + high) / 2) / norm / s)) <= 1.25 AS met
        FROM (SELECT *, list_sum(list_transform(share, lambda s: pow(s, (low + high) / 2))) AS norm FROM b WHERE it < 50))),
x AS (SELECT high, list_sum(list_transform(share, lambda s: pow(s, high))) AS norm FROM b WHERE it = 50),
goal AS (
  SELECT source, n, CASE WHEN n > 0 THEN floor(pow(n / total, high) / norm * total)::BIGINT ELSE 0 END AS g,
    greatest(1, (n + 262143) // 262144) AS blocks
  FROM src, tot, x),
dealt AS (
  SELECT d.*, CASE WHEN n > 0 THEN g // n ELSE 0 END AS passes, CASE WHEN n > 0 THEN g % n ELSE 0 END AS rest,
    ('0x' || substr(md5('42:' || doc_id), 1, 15))::BIGINT AS key, blocks FROM d JOIN goal USING (source)),
placed AS (SELECT *, key % blocks AS block FROM dealt),
blk AS (
  SELECT source, block, sum(tokens)::BIGINT AS size, any_value(rest) AS rest,
    ('0x' || substr(md5('42:block:' || source || ':' || block), 1, 15))::BIGINT AS turn FROM placed GROUP BY source, block),
r1 AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY turn, block ROWS UNBOUNDED PRECEDING) AS upto FROM blk),
r2 AS (
  SELECT *, sum(CASE WHEN upto > rest THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY turn, block ROWS UNBOUNDED PRECEDING) AS over_ FROM r1),
inner_ AS (
  SELECT placed.*, over_, rest - upto + size AS room,
    sum(tokens) OVER (PARTITION BY source, block ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS run
  FROM (SELECT source, block, over_, upto, size FROM r2) JOIN placed USING (source, block))
SELECT doc_id, source, tokens, block, passes + CASE
  WHEN tokens > 0 AND (over_ = 0 OR (over_ = 1 AND run <= room)) THEN 1 ELSE 0 END AS copies
FROM inner_
"""

#: Windows of 100 bytes as hex; kept bytes are put together from the text's hex.
OP2_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
win AS (
  SELECT doc_id, i, md5(x[2 * i + 1 : 2 * i + 200]) AS w
  FROM (SELECT doc_id, x, unnest(range(0, greatest(length(x) // 2 - 99, 0))) AS i FROM d)),
hit AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
edge AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM hit),
run AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT doc_id, i, count(*) FILTER (WHERE gap IS NULL OR gap > 100) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM edge)
  GROUP BY doc_id, k),
piece AS (
  SELECT doc_id, coalesce(lag(b) OVER o, 0) AS a, a AS b FROM run WINDOW o AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT doc_id, max(b), (SELECT length(x) // 2 FROM d WHERE d.doc_id = run.doc_id) FROM run GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(x[2 * a + 1 : 2 * b], '' ORDER BY a) AS x
  FROM piece JOIN d USING (doc_id) GROUP BY doc_id),
count_ AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM run GROUP BY doc_id)
SELECT doc_id, (length(d.x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.x, d.x))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN count_ USING (doc_id)
"""

OP6_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(list_aggregate(list_slice(w, i, i + 12), 'string_agg', ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS m FROM win) WHERE doc_id > m),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM hit, range(13) AS r(k)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t
  FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

OP7_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, i, list_slice(w, i, i + 4) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM rep, range(5) AS r(k) GROUP BY doc_id),
raw AS (SELECT doc_id, host, t, unnest(string_split(t, chr(10))) AS line FROM d),
full_lines AS (SELECT * FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM full_lines GROUP BY doc_id),
norm AS (
  SELECT doc_id, host, t, lower(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS line FROM full_lines),
freq AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT t) AS df FROM norm GROUP BY ALL) WHERE df >= 25),
gone AS (
  SELECT doc_id, sum(len(string_split_regex(line, '[\x20\x09-\x0D]+')))::BIGINT AS n_removed_words
  FROM norm JOIN freq USING (host, line) GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_removed_words, 0)::BIGINT AS n_removed_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN gone USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_removed_words <= 0.5 * n_words AS kept, n_removed_words
FROM judged
"""

OP9_SQL = f"""
WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""


#: Windows of ten words of the items, and of all words of shorter ones, against windows of as many words of the documents.
OP11_SQL = r"""
WITH item AS (
  SELECT item_id::VARCHAR AS item, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, list_aggregate(list_slice(w, i, i + 9), 'string_agg', ' ') AS g, least(len(w), 10) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM item WHERE len(w) > 0)),
doc AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
spot AS (
  SELECT doc_id, i, n, list_aggregate(list_slice(w, i, i + n - 1), 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win))),
hit AS (SELECT doc_id, i, n, item FROM spot JOIN win USING (g, n)),
place AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, range(10) AS r(k) WHERE k < n GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS t FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(t, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN place USING (doc_id) LEFT JOIN names USING (doc_id)
"""


def _op12_sql(rounds: int = 5) -> str:
    """Each round is a step of its own, as a recursive one may not hold the aggregations."""
    steps = [
        """WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1)::INT AS cluster, v AS c FROM kept ORDER BY sha256('2:' || vec_id) LIMIT 40)"""
    ]
    far = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, v, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
  FROM (SELECT vec_id, v, cluster, {far} AS d FROM kept, c{i}) GROUP BY vec_id, v)""")
        if i < rounds:
            mean = "((s - ((s % n) + n) % n) // n)"
            steps.append(f"""m{i} AS (
  SELECT cluster, list({mean}::BIGINT ORDER BY d) AS c
  FROM (SELECT cluster, d, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS d FROM a{i}) GROUP BY ALL) GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))""")
    last = f"a{rounds}"
    return ",\n".join(steps) + f"""
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(list_aggregate(c, 'string_agg', ',')) AS centroid_sha256
FROM {last} JOIN c{rounds} USING (cluster)"""


OP12_SQL = _op12_sql()


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": OP3_SQL, "op2_suffix_array_dedup": OP2_SQL, "op6_substring_dedup": OP6_SQL, "op7_quality_rules": OP7_SQL, "op9_exact_dedup": OP9_SQL, "op11_decontamination": OP11_SQL, "op12_va_clusters": OP12_SQL}
