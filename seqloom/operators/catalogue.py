"""Datasets, lineage and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqloom.sources.scratch import materialize


def dataset_entry(df: DataFrame, dataset_id: str, dataset_type: str, path: str, schema_version: str, run_id: str, parameters: str = "{}") -> DataFrame:
    """One row that describes ``df``: rows, bytes of its files (null for frames without files), and a checksum that doesn't depend on order."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    stats = df.agg(F.count("*").alias("row_count"), F.bit_xor(row).alias("_x"), F.sum(F.pmod(row, F.lit(1 << 31))).alias("_s"))
    out = stats.select("row_count", F.sha2(F.concat_ws(":", F.col("row_count"), F.coalesce("_x", F.lit(0)), F.coalesce("_s", F.lit(0))), 256).alias("checksum"))
    if df.inputFiles():
        files = df.sparkSession.read.format("binaryFile").load(df.inputFiles()).select("length")  # contents are not read
        out = out.crossJoin(F.broadcast(files.agg(F.sum("length").alias("size_bytes"))))  # one row each
    else:
        out = out.withColumn("size_bytes", F.lit(None).cast("long"))
    given = {"dataset_id": dataset_id, "dataset_type": dataset_type, "path": path, "schema_version": schema_version, "created_by_run": run_id, "parameters": parameters}
    return out.select(*[F.lit(v).alias(k) for k, v in given.items()], "row_count", "size_bytes", "checksum")


def register(entries: DataFrame, path: str) -> None:
    """Append entries to a catalogue table."""
    entries.write.mode("append").parquet(path)


def lineage_edges(edges: DataFrame) -> DataFrame:
    """(child_id, parent_id, relationship), each child and parent once; of several relationships the first by name stays."""
    return edges.groupBy("child_id", "parent_id").agg(F.min("relationship").alias("relationship"))


def latest_runs(runs: DataFrame) -> DataFrame:
    """The last record of each run."""
    w = Window.partitionBy("run_id").orderBy(F.desc_nulls_last("updated_at"), F.desc_nulls_last("status"))
    return runs.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def _walk(edges: DataFrame, start: str, a: str, b: str, max_depth: int) -> DataFrame:
    """Breadth first: each frontier is written, so the next join reads a table, and the walk stops where nothing is left."""
    now = materialize(edges.where(F.col(a) == start).select(F.col(b).alias("dataset_id"), F.col("relationship"), F.lit(1).alias("depth")), "frontier")
    out = now
    step = edges.select(F.col(a).alias("dataset_id"), F.col(b).alias("next"), F.col("relationship").alias("how"))
    for depth in range(2, max_depth + 1):
        now = materialize(now.select("dataset_id").join(step, "dataset_id").select(F.col("next").alias("dataset_id"), F.col("how").alias("relationship"), F.lit(depth).alias("depth")), "frontier")
        if not now.take(1):
            break
        out = out.unionByName(now)
    return out


def ancestry(edges: DataFrame, child: str, max_depth: int = 10) -> DataFrame:
    """(dataset_id, relationship, depth) of a dataset's ancestors; one that is reached by several paths stands for each."""
    return _walk(edges, child, "child_id", "parent_id", max_depth)


def descendants(edges: DataFrame, parent: str, max_depth: int = 10) -> DataFrame:
    return _walk(edges, parent, "parent_id", "child_id", max_depth)


def ancestry_sql(spark: SparkSession, view: str, child: str, max_depth: int = 10) -> DataFrame:
    """The same walk as one recursive query over a view of edges."""
    return spark.sql(
        f"""
        WITH RECURSIVE up(dataset_id, relationship, depth) AS (
          SELECT parent_id, relationship, 1 FROM {view} WHERE child_id = :child
          UNION ALL
          SELECT e.parent_id, e.relationship, up.depth + 1 FROM {view} e JOIN up ON e.child_id = up.dataset_id WHERE up.depth < {int(max_depth)})
        SELECT dataset_id, relationship, depth FROM up ORDER BY depth""",
        args={"child": child},
    )


def row_provenance(chunks: DataFrame, merged: DataFrame, features: DataFrame) -> DataFrame:
    """From each sequence: its chunk, the reference chunks of its merged hits, and whether it has a feature row."""
    hits = merged.groupBy(F.col("query_id").alias("sequence_id")).agg(F.count("*").alias("n_hits"), F.sort_array(F.collect_set("ref_chunk_id")).alias("ref_chunks"))
    has = features.select("sequence_id", F.lit(True).alias("has_features")).distinct()
    out = chunks.select("sequence_id", "chunk_id").join(hits, "sequence_id", "left").join(has, "sequence_id", "left")
    return out.select("sequence_id", "chunk_id", F.coalesce("n_hits", F.lit(0)).alias("n_hits"), "ref_chunks", F.coalesce("has_features", F.lit(False)).alias("has_features"))


def all_descendants(edges: DataFrame, start: str) -> DataFrame:
    """(dataset_id) of every dataset that comes from ``start``, over any number of steps, each once; ``start`` only if it comes from itself.

    Each round joins the edges only with what the round before found first, and what is known already is left out; so
    a cycle ends, and a dataset that many paths reach is followed once.  Every round's finds are written.
    """
    step = edges.select("parent_id", "child_id").distinct()
    now = materialize(step.where(F.col("parent_id") == start).select(F.col("child_id").alias("dataset_id")).distinct(), "reached")
    known = now
    while not now.isEmpty():
        met = now.join(step, F.col("dataset_id") == F.col("parent_id")).select(F.col("child_id").alias("dataset_id")).distinct()
        now = materialize(met.join(known, "dataset_id", "left_anti"), "reached")
        known = known.unionByName(now)
    return known


def runs_using(runs: DataFrame, datasets: DataFrame, edges: DataFrame, reference_id: str) -> DataFrame:
    """Runs that made a dataset which comes from ``reference_id``, directly or through other datasets."""
    made = all_descendants(edges, reference_id)
    by = datasets.join(made, "dataset_id", "left_semi").select(F.col("created_by_run").alias("run_id")).distinct()
    return latest_runs(runs).join(by, "run_id", "left_semi")


def run_summary(runs: DataFrame, datasets: DataFrame) -> DataFrame:
    """Each run's status, seconds, and what it made."""
    made = datasets.groupBy(F.col("created_by_run").alias("run_id")).agg(F.count("*").alias("n_datasets"), F.sum("row_count").alias("rows_written"))
    last = latest_runs(runs).withColumn("seconds", F.unix_timestamp("completed_at") - F.unix_timestamp("started_at"))
    out = last.join(made, "run_id", "left")
    return out.select("run_id", "status", "seconds", F.coalesce("n_datasets", F.lit(0)).alias("n_datasets"), F.coalesce("rows_written", F.lit(0)).alias("rows_written"))
