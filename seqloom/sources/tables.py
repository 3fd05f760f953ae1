"""Other sources and sinks: hits, chunks, manifests, logs, taxonomy dumps, embeddings, features."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.contracts import AUDIT_EVENTS, FEATURES, HITS_MERGED, HITS_RAW, MANIFEST, enforce_contract
from seqloom.sources.layout import ranged


def parse_hits(lines: DataFrame) -> DataFrame:
    """Tabular hits from rows with ``value``: blank rows and comments are skipped, the first 12 fields are taken.

    A short row or a bad number is an error.
    """
    fields = F.split("value", "\t")
    rows = lines.where("trim(value) <> '' AND NOT value LIKE '#%'")
    at = [F.when(F.size(fields) < 12, F.raise_error(F.lit("a hit has 12 fields"))).otherwise(F.get(fields, F.lit(i))) for i in range(12)]
    return rows.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(at, HITS_RAW.fields)])


def scan_hits(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_hits(spark.read.text(paths))


def write_chunks(chunks: DataFrame, path: str) -> None:
    """A partition for each chunk that has rows: files of ranges of (chunk_id, sequence_id), each sorted.

    A chunk of many rows is several ranges, written by as many tasks, and a read by sequence_id skips those that don't hold it.
    """
    ranged(chunks, ["chunk_id", "sequence_id"]).write.mode("overwrite").partitionBy("chunk_id").parquet(path)


def scan_chunks(spark: SparkSession, path: str, chunk_ids: list[str] | None = None) -> DataFrame:
    """Chunks, or only those named (other partitions are not read)."""
    chunks = spark.read.parquet(path).withColumn("chunk_id", F.col("chunk_id").cast("string"))
    return chunks if chunk_ids is None else chunks.where(F.col("chunk_id").isin(chunk_ids))


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.coalesce(1).write.mode("overwrite").json(path)  # one row


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(path)


def manifest_entries(manifest: DataFrame) -> DataFrame:
    return manifest.select("run_id", F.inline("chunks"))


def write_hits(hits: DataFrame, path: str) -> None:
    """Raw hits with query_chunk_id and ref_chunk_id, partitioned by the pair; a task writes a range of pairs, so there are few small files."""
    ranged(hits, ["query_chunk_id", "ref_chunk_id"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("query_chunk_id", "ref_chunk_id").parquet(path)


def scan_hits_parquet(spark: SparkSession, path: str) -> DataFrame:
    """All pairs' hits as one table: the union over pairs, with the pair as columns."""
    hits = spark.read.parquet(path)
    return hits.withColumns({c: F.col(c).cast("string") for c in ("query_chunk_id", "ref_chunk_id")})


def write_merged(merged: DataFrame, path: str) -> None:
    """Merged hits by query chunk; writing a chunk again replaces only that chunk.  A chunk of many rows is written by several tasks, as ranges of (query_id, global_rank)."""
    ordered = ranged(enforce_contract(merged, HITS_MERGED), ["query_chunk_id", "query_id", "global_rank"])
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("query_chunk_id").parquet(path)


def read_merged(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    merged = enforce_contract(spark.read.parquet(path), HITS_MERGED)
    if view:
        merged.createOrReplaceTempView(view)
    return merged


def scan_audit_log(spark: SparkSession, path: str) -> DataFrame:
    """State transitions from JSON log lines; other events are left out."""
    return spark.read.schema(AUDIT_EVENTS).json(path).where("to_state IS NOT NULL")


def _dump(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a taxonomy dump: fields between tab, bar, tab."""
    return spark.read.text(path).select(F.split(F.regexp_replace("value", r"\t\|$", ""), r"\t\|\t").alias("f"))


def scan_taxdump(spark: SparkSession, nodes: str, names: str, accessions: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(taxon_id, parent_id, rank), (taxon_id, name) and (accession, taxon_id); names are the scientific ones.

    A gzip file is one task, so the accession map is dealt out after reading.
    """
    f = F.col("f")
    tree = _dump(spark, nodes).select(f[0].cast("long").alias("taxon_id"), f[1].cast("long").alias("parent_id"), f[2].alias("rank"))
    named = _dump(spark, names).where(f[3] == "scientific name").select(f[0].cast("long").alias("taxon_id"), f[1].alias("name"))
    table = spark.read.option("sep", "\t").option("header", True).schema("accession string, `accession.version` string, taxid long, gi string").csv(accessions)
    return tree, named, table.select("accession", F.col("taxid").alias("taxon_id")).repartition("accession")


def scan_embeddings(spark: SparkSession, path: str, dim: int = 320, id_column: str = "sequence_id", vector: str = "embedding") -> DataFrame:
    """(sequence_id, embedding); a vector of another length is an error."""
    return check_dimension(spark.read.parquet(path).select(F.col(id_column).cast("string").alias("sequence_id"), F.col(vector).cast("array<float>").alias("embedding")), dim)


def check_dimension(vectors: DataFrame, dim: int) -> DataFrame:
    wrong = F.raise_error(F.lit(f"an embedding has {dim} values")).cast("array<float>")
    return vectors.withColumn("embedding", F.when(F.size("embedding") != dim, wrong).otherwise(F.col("embedding")))


def write_features(features: DataFrame, path: str) -> None:
    """Features by version and run; a run that is written again replaces itself."""
    base = features.select(*FEATURES.names, *[c for c in features.columns if c not in FEATURES.names])
    base.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("feature_version", "run_id").parquet(path)


def file_checksums(spark: SparkSession, paths: str | list[str], whole: int = 256 << 20) -> DataFrame:
    """(path, n_bytes, checksum) of input files, for their provenance; checksums are those of the files' bytes.

    Files of up to ``whole`` bytes are one row each.  Of longer ones, whatever their size, the lines are read by many tasks, dealt
    by file and sorted by place (Spark spills what doesn't fit), and one task a file digests them one after
    the other: it holds a batch of lines, never a file.  A long file that Spark doesn't read as it lies
    (compressed, or with a byte-order mark) is an error.  Empty files have no row, as Spark's readers skip them.
    """
    files = spark.read.format("binaryFile").load(paths)
    small = files.where(F.col("length") <= whole).select("path", F.col("length").alias("n_bytes"), F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("checksum"))
    meta = F.col("_metadata")
    lines = (
        spark.read.option("lineSep", "\n").text(paths).where(meta["file_size"] > whole)
        .select(meta["file_path"].alias("path"), meta["file_size"].alias("n_bytes"), meta["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("place"), F.col("value").cast("binary").alias("line"))
    )
    dealt = lines.repartition("path").sortWithinPartitions("path", "start", "place").select("path", "n_bytes", "line")
    return small.unionByName(dealt.mapInArrow(_digest_lines, "path string, n_bytes long, checksum string"))


def _digest_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each file of ``batches(path, n_bytes, line)``, whose lines stand together and in order."""
    path, size, seen, digest = None, 0, 0, None

    def ended() -> pa.RecordBatch:
        if seen != size:
            raise ValueError(f"{path} has {size} bytes, of which its lines have {seen}: it is not read as it lies")
        return pa.RecordBatch.from_pylist([{"path": path, "n_bytes": size, "checksum": f"sha256:{digest.hexdigest()}"}])

    for batch in batches:
        names, sizes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        at = 0
        while at < len(names):
            if names[at] != path:
                if path is not None:
                    yield ended()
                path, size, seen, digest = names[at], sizes[at], 0, hashlib.sha256()
            end = next((i for i in range(at, len(names)) if names[i] != path), len(names))
            for line in batch.column(2).slice(at, end - at):
                raw = line.as_py()
                seen += len(raw)
                digest.update(raw)
                if seen < size:  # the last line may lack its end
                    digest.update(b"\n")
                    seen += 1
            at = end
    if path is not None:
        yield ended()
