"""Merging hits: the best hit of each pair, ranked within each query."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.contracts import HITS_MERGED, HITS_RAW, enforce_contract
from seqloom.functions.scalar import RAW_TO_MERGED

#: The order of hits is total: ties after e-value and score go by these.
_TIES = ["ref_chunk_id", "query_start", "subject_start", "subject_id"]


def _best(*ties: str) -> list:
    return [F.asc_nulls_last("evalue"), F.desc_nulls_last("bitscore"), *[F.asc_nulls_last(t) for t in ties]]


def union_hits(*frames: DataFrame) -> DataFrame:
    """All hits of several frames, by column name; no frames give no hits."""
    if not frames:
        raise ValueError("union_hits needs a frame; an empty one will do")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def rename_raw(hits: DataFrame) -> DataFrame:
    """Raw columns under their merged names; other columns (the pair's) stay."""
    return hits.select(*[F.col(a).alias(b) for a, b in RAW_TO_MERGED.items()], *[c for c in hits.columns if c not in RAW_TO_MERGED])


def dedup_best(hits: DataFrame) -> DataFrame:
    """The best hit of each (query, subject)."""
    pair = Window.partitionBy("query_id", "subject_id").orderBy(*_best(*_TIES))
    return hits.withColumn("_dedup", F.row_number().over(pair)).where("_dedup = 1").drop("_dedup")


def rank_global(hits: DataFrame) -> DataFrame:
    """``hits`` with ``global_rank`` within each query, from 1."""
    return hits.withColumn("global_rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*_best("subject_id", *_TIES[:3]))))


def top_n_per_query(ranked: DataFrame, n: int) -> DataFrame:
    return ranked.where(F.col("global_rank") <= n)


def merge_hits(hits: DataFrame, top_n: int = 50) -> DataFrame:
    """Merged hits: duplicates go before ranking, so they never take a place among the ``top_n``.

    ``hits`` has the merged columns but the rank.  Both windows get a group limit from Catalyst,
    one ahead of each shuffle and one behind it, so a query with very many hits sends few rows.
    """
    return enforce_contract(top_n_per_query(rank_global(dedup_best(hits)), top_n), HITS_MERGED)


def merge_raw(raw: DataFrame, top_n: int = 50) -> DataFrame:
    """Merged hits from raw ones with query_chunk_id and ref_chunk_id."""
    enforce_contract(raw.select(*HITS_RAW.names), HITS_RAW)
    return merge_hits(rename_raw(raw), top_n)


def ordered(merged: DataFrame) -> DataFrame:
    return merged.orderBy("query_id", "global_rank")


def rank_only(hits: DataFrame, top_n: int = 50) -> DataFrame:
    """Ranks and the limit without dedup: a pair may stand more than once."""
    return top_n_per_query(rank_global(hits), top_n)


def merge_stats(hits: DataFrame, top_n: int = 50) -> DataFrame:
    """Rows for each query chunk: raw, after dedup, after the limit; one aggregation by query and subject, then two sums."""
    per_pair = hits.groupBy("query_chunk_id", "query_id", "subject_id").agg(F.count("*").alias("n"))
    per_query = per_pair.groupBy("query_chunk_id", "query_id").agg(F.sum("n").alias("raw"), F.count("*").alias("distinct"))
    return per_query.groupBy("query_chunk_id").agg(
        F.sum("raw").alias("rows_raw"), F.sum("distinct").alias("rows_deduped"), F.sum(F.least("distinct", F.lit(top_n))).alias("rows_merged")
    )


def limit_targets(hits: DataFrame, max_target_seqs: int = 50) -> DataFrame:
    """All hits of at most ``max_target_seqs`` subjects for each query and reference chunk.

    A subject stands where its best hit does, so many hits of one never displace another.  The best hits are an
    aggregation, combined ahead of its shuffle, and only a row a subject is ranked, with a group limit
    ahead of the window's shuffle.
    """
    keys = ["query_id", "ref_chunk_id"]
    # Nulls count as worst, as in the merged order.
    place = F.struct(F.col("evalue").isNull().alias("no_evalue"), "evalue", F.col("bitscore").isNull().alias("no_bitscore"), (-F.col("bitscore")).alias("minus_bitscore"))
    best = hits.groupBy(*keys, "subject_id").agg(F.min(place).alias("_best"))
    w = Window.partitionBy(*keys).orderBy("_best", "subject_id")
    kept = best.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= max_target_seqs).select(*[F.col(c).alias(f"_{c}") for c in (*keys, "subject_id")])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*keys, "subject_id")]
    return hits.join(kept, same, "left_semi")
