"""Features of each query sequence, and their exploration."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.contracts import FEATURES
from seqloom.functions.scalar import log10_evalue
from seqloom.sources.tables import check_dimension

#: Numeric features (names of the contract).
NUMERIC = [f.name for f in FEATURES.fields if f.dataType.typeName() in ("double", "integer")]


def significant(hits: DataFrame, max_evalue: float | None) -> DataFrame:
    return hits if max_evalue is None else hits.where(F.col("evalue") <= max_evalue)


#: The place of a null, and of 0, in the lower half of a long.
_LEAST = 1 << 31


def _best(rank: Column, length: Column) -> Column:
    """A rank and a length in one long, in their order, nulls first: the least of them takes no object, so rows are combined in a hash table."""
    half = lambda c: F.coalesce(c.cast("long"), F.lit(-_LEAST)) + _LEAST
    return F.shiftleft(half(rank) - _LEAST, 32).bitwiseOR(half(length))


def _length(best: Column) -> Column:
    low = best.bitwiseAND(F.lit((1 << 32) - 1))
    return F.when(low > 0, low - _LEAST).cast("int")


def hit_features(enriched: DataFrame) -> DataFrame:
    """One row a query with hits: counts, means, spread, the best hit's length, entropy of phyla in bits.

    Two aggregations: by (query, phylum) and, as further rows, by (query, kingdom); then by query from sums, so that each hit is shuffled
    once at most and combined ahead of it.  All that is added up is a number, no set of a group is held.
    """
    x = F.col("alignment_length").cast("double")
    by_phylum = F.col("_by") == 0
    sides = enriched.withColumn("_by", F.explode(F.array(F.lit(0), F.lit(1))))
    per = sides.groupBy("query_id", "_by", F.when(by_phylum, F.col("phylum")).alias("phylum"), F.when(~by_phylum, F.col("kingdom")).alias("kingdom")).agg(
        F.count("*").alias("n"),
        F.sum("percent_identity").alias("pid"),
        F.max("percent_identity").alias("pid_max"),
        F.sum(log10_evalue(F.col("evalue"))).alias("log_e"),
        F.sum(x).alias("len"),
        F.sum(x * x).alias("len2"),
        F.min(_best(F.col("global_rank"), F.col("alignment_length"))).alias("best"),
    )
    of = lambda c: F.when(by_phylum, F.col(c))
    known = F.when(by_phylum & F.col("phylum").isNotNull(), F.col("n"))
    total = per.groupBy("query_id").agg(
        *[F.sum(of(c)).alias(c) for c in ("n", "pid", "log_e", "len", "len2")], F.max("pid_max").alias("pid_max"),
        F.min("best").alias("best"), F.sum(known).alias("k"), F.sum(known * F.log2(known)).alias("klogk"), F.count(known).alias("phyla"), F.count("kingdom").alias("kingdoms"),
    )
    n = F.col("n")
    spread = F.sqrt(F.greatest(F.col("len2") / n - F.pow(F.col("len") / n, 2), F.lit(0.0)))
    entropy = F.when(F.col("k") > 0, F.greatest(F.log2("k") - F.col("klogk") / F.col("k"), F.lit(0.0))).otherwise(0.0)
    return total.select(
        F.col("query_id").alias("sequence_id"), n.cast("int").alias("hit_count"), (F.col("pid") / n).alias("mean_percent_identity"), F.col("pid_max").alias("max_percent_identity"),
        (F.col("log_e") / n).alias("mean_evalue_log10"), (F.col("len") / n).alias("mean_alignment_length"), spread.alias("std_alignment_length"),
        _length(F.col("best")).alias("_best_length"), entropy.alias("taxonomic_entropy"), F.col("phyla").cast("int").alias("num_phyla"), F.col("kingdoms").cast("int").alias("num_kingdoms"),
    )


def build_features(sequences: DataFrame, enriched: DataFrame, max_evalue: float | None = None, keep_without_hits: bool = True) -> DataFrame:
    """One row for each sequence; without a hit, counts and entropy are 0 and the rest null (or the row is left out)."""
    found = hit_features(significant(enriched, max_evalue))
    base = sequences.select(F.col("id").alias("sequence_id"), F.col("length").alias("_length"))
    out = base.join(found, "sequence_id", "left" if keep_without_hits else "inner")
    covered = F.col("_best_length") / F.col("_length")
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("int") for c in ("hit_count", "num_phyla", "num_kingdoms")}
    out = out.withColumn("best_hit_query_coverage", covered).withColumns(zero).withColumn("taxonomic_entropy", F.coalesce("taxonomic_entropy", F.lit(0.0)))
    return out.select(*FEATURES.names[:11])


def stamp_version(features: DataFrame, version: str, run_id: str, created_at: str) -> DataFrame:
    """Version columns; the time is given, so that the same run gives the same rows."""
    return features.withColumns({"feature_version": F.lit(version), "run_id": F.lit(run_id), "created_at": F.lit(created_at).cast("timestamp")})


def join_embeddings(features: DataFrame, embeddings: DataFrame, dim: int = 320) -> DataFrame:
    """``features`` with ``embedding``, null where a sequence has none; a vector of another length is an error."""
    return features.join(check_dimension(embeddings.select("sequence_id", "embedding"), dim), "sequence_id", "left")


def feature_histogram(features: DataFrame, column: str, bins: int, low: float, high: float) -> DataFrame:
    """(bin, n): equal bins over [low, high), 0 below and bins + 1 from ``high`` on; nulls are left out."""
    return features.where(F.col(column).isNotNull()).groupBy(F.width_bucket(F.col(column).cast("double"), F.lit(low), F.lit(high), F.lit(bins)).alias("bin")).agg(F.count("*").alias("n"))


def feature_correlations(features: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, correlation) for each pair of columns, from one aggregation."""
    pairs = list(combinations(columns, 2))
    one = features.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("correlation")) for i, (a, b) in enumerate(pairs)])
    return one.select(F.inline(rows))


def cluster_features(features: DataFrame, columns: list[str], k: int, seed: int = 42) -> DataFrame:
    """``features`` with ``cluster`` (k-means on scaled columns) and the first two principal components ``pc1`` and ``pc2``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    filled = features.fillna(0, columns)
    model = Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="_x", withMean=True),
        KMeans(k=k, seed=seed, featuresCol="_x", predictionCol="cluster"), PCA(k=2, inputCol="_x", outputCol="_pc"),
    ]).fit(filled)
    out = model.transform(filled).withColumn("_pc", vector_to_array("_pc"))
    return out.withColumn("pc1", F.col("_pc")[0]).withColumn("pc2", F.col("_pc")[1]).drop("_raw", "_x", "_pc")
