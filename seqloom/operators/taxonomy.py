"""Taxonomic lineages and profiles of hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.contracts import RANKS
from seqloom.functions.scalar import extract_accession
from seqloom.sources.scratch import materialize

#: Accessions with their lineages that are sent to every task.
SENT = 500_000


def resolve_lineage(nodes: DataFrame, names: DataFrame, max_depth: int = 64) -> DataFrame:
    """(taxon_id, species, genus, family, order, class, phylum, kingdom) for every taxon.

    Ancestors are found by doubling: after r rounds every taxon has its nearest 2 ** r, so depth 64
    takes six joins.  A rank that the path lacks is null; a superkingdom or domain stands in for a
    missing kingdom.  ``nodes(taxon_id, parent_id, rank)``; the root is its own parent, or has none.
    """
    jump = nodes.select("taxon_id", F.col("parent_id").alias("up")).where("up IS NOT NULL AND up <> taxon_id")
    reach = nodes.select("taxon_id", F.col("taxon_id").alias("ancestor"), F.lit(0).alias("steps"))
    far = 1
    while far < max_depth:
        more = reach.join(jump.select(F.col("taxon_id").alias("ancestor"), "up"), "ancestor").select("taxon_id", F.col("up").alias("ancestor"), (F.col("steps") + far).alias("steps"))
        reach = materialize(reach.unionByName(more), "reach")  # else each round would double the plan
        jump = materialize(jump.join(jump.select(F.col("taxon_id").alias("up"), F.col("up").alias("next")), "up").select("taxon_id", F.col("next").alias("up")), "jump")
        far *= 2
        if not jump.take(1):
            break  # no taxon lies so deep
    ranked = reach.join(nodes.select(F.col("taxon_id").alias("ancestor"), "rank"), "ancestor").join(names.select(F.col("taxon_id").alias("ancestor"), "name"), "ancestor")
    wanted = ranked.where(F.col("rank").isin(*RANKS, "superkingdom", "domain"))
    pick = lambda r: F.min_by(F.when(F.col("rank") == r, F.col("name")), F.when(F.col("rank") == r, F.col("steps")))
    found = wanted.groupBy("taxon_id").agg(*[pick(r).alias(r) for r in [*RANKS, "superkingdom", "domain"]])
    full = nodes.select("taxon_id").join(found, "taxon_id", "left")
    return full.withColumn("kingdom", F.coalesce("kingdom", "superkingdom", "domain")).select("taxon_id", *RANKS)


def enrich_hits(hits: DataFrame, accession_to_taxon: DataFrame, lineage: DataFrame) -> DataFrame:
    """``hits`` with taxon_id and the lineage; hits without a taxon stay, with nulls.

    Accessions get their lineages first, written once, so the hits take part in one join.  Up to SENT accessions
    go to every task; the hits then stay where they are, also for what is grouped by query behind it, and a frequent
    subject fills no task.  The join of more is left to Spark.
    """
    keyed = hits.withColumn("_accession", extract_accession(F.col("subject_id")))
    taxon = accession_to_taxon.select(F.col("accession").alias("_accession"), "taxon_id")
    known = materialize(taxon.join(lineage.select("taxon_id", *RANKS), "taxon_id", "left"), "accessions")
    known = F.broadcast(known) if known.count() <= SENT else known
    return keyed.join(known, "_accession", "left").select(*hits.columns, "taxon_id", *RANKS)


def taxonomic_profile(enriched: DataFrame) -> DataFrame:
    """Hits of each query by phylum."""
    return enriched.groupBy("query_id", "phylum").agg(
        F.count("*").alias("hit_count"), F.avg("percent_identity").alias("mean_identity"), F.min("evalue").alias("best_evalue")
    )


def broad_reach(enriched: DataFrame, k: int) -> DataFrame:
    """Queries with hits in more than ``k`` phyla."""
    return enriched.groupBy("query_id").agg(F.countDistinct("phylum").alias("num_phyla")).where(F.col("num_phyla") > k)
