"""The given tables as hits, sequences, taxonomy, lineage and run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, times without a zone taken as UTC."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return utc(df)


def utc(df: DataFrame) -> DataFrame:
    bare = [c for c, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in bare}) if bare else df


def hits(spark: SparkSession, sf_dir: str, query: str = "l_suppkey", subject: str = "l_partkey") -> DataFrame:
    """Line items as hits with merged names: a part is a subject of a supplier (or the other way)."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"cast({query} AS string) AS query_id", f"cast({subject} AS string) AS subject_id", "100 * (1 - l_discount) AS percent_identity", "cast(l_quantity AS int) AS alignment_length",
        "0 AS mismatches", "0 AS gap_opens", "cast(l_orderkey AS int) AS query_start", "cast(l_orderkey + l_quantity AS int) AS query_end", "l_linenumber AS subject_start",
        "cast(l_linenumber + l_quantity AS int) AS subject_end", "l_extendedprice AS evalue", "l_tax AS bitscore", f"concat('q', {query} % 4) AS query_chunk_id", "concat('r', l_linenumber) AS ref_chunk_id",
    )


def letters(df: DataFrame, key: str) -> DataFrame:
    """Texts as sequences of their letters."""
    return df.select(
        F.col(key).cast("string").alias("id"), F.concat(F.col(key).cast("string"), F.lit(" text")).alias("description"), F.upper(F.regexp_replace("text", "[^A-Za-z]", "")).alias("sequence")
    ).withColumn("length", F.length("sequence"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return letters(table(spark, sf_dir, "documents"), "doc_id")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return letters(table(spark, sf_dir, "benchmark"), "item_id")


def taxonomy(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, names, accessions): suppliers are species, nations phyla, regions kingdoms."""
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    nodes = (
        s.selectExpr("1000 + s_suppkey AS taxon_id", "cast(100 + s_nationkey AS long) AS parent_id", "'species' AS rank", "s_name AS name")
        .unionByName(n.selectExpr("cast(100 + n_nationkey AS long) AS taxon_id", "cast(10 + n_regionkey AS long) AS parent_id", "'phylum' AS rank", "n_name AS name"))
        .unionByName(r.selectExpr("cast(10 + r_regionkey AS long) AS taxon_id", "1L AS parent_id", "'kingdom' AS rank", "r_name AS name"))
    )
    root = r.agg(F.count("*").alias("c")).selectExpr("1L AS taxon_id", "1L AS parent_id", "'no rank' AS rank", "'root' AS name")
    nodes = nodes.unionByName(root)
    return nodes.select("taxon_id", "parent_id", "rank"), nodes.select("taxon_id", "name"), s.selectExpr("cast(s_suppkey AS string) AS accession", "1000 + s_suppkey AS taxon_id")


def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders come from customers, customers from nations, nations from regions."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return (
        o.selectExpr("concat('o', o_orderkey) AS child_id", "concat('c', o_custkey) AS parent_id", "'ordered_by' AS relationship")
        .unionByName(c.selectExpr("concat('c', c_custkey) AS child_id", "concat('n', c_nationkey) AS parent_id", "'lives_in' AS relationship"))
        .unionByName(n.selectExpr("concat('n', n_nationkey) AS child_id", "concat('r', n_regionkey) AS parent_id", "'part_of' AS relationship"))
    )


#: Event types as exit codes and states.
EXIT_SQL = "CASE event_type WHEN 'error' THEN 137 WHEN 'signup' THEN 1 WHEN 'purchase' THEN -1 ELSE 0 END"
STATE_SQL = "CASE event_type WHEN 'error' THEN 'POISONED' WHEN 'signup' THEN 'RUNNING' WHEN 'purchase' THEN 'PENDING' ELSE 'COMPLETED' END"


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as finished work: a user is a worker, the value a duration."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('wp_', event_id) AS package_id", "concat('w', user_id) AS worker_id", "ts", "value AS duration_s", f"{EXIT_SQL} AS exit_code", "cast(floor(value) AS long) AS hits", "event_id % 7 AS sequences"
    )


def packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as work packages."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('wp_', event_id) AS package_id", "concat('q', user_id % 10) AS query_chunk_id", "concat('r', event_id % 50) AS ref_chunk_id", f"{STATE_SQL} AS state", "concat('w', user_id) AS claimed_by",
        "ts AS claimed_at", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END AS heartbeat_at", "ts AS started_at", "cast(event_id % 3 AS int) AS attempt", "3 AS max_attempts", "array(event_type) AS error_history", "value AS duration_s",
    )


def audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as state transitions: a user's events are one package's."""
    return table(spark, sf_dir, "events").selectExpr(
        "'state_transition' AS event", "concat('wp_', user_id) AS package_id", "'PENDING' AS from_state", f"{STATE_SQL} AS to_state", "concat('w', user_id % 8) AS worker_id", "cast(event_id AS int) AS attempt",
        "event_type AS reason", "ts AS timestamp", "'run_1' AS run_id",
    )
