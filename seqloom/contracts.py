"""Fixed schemas of the stages, and their enforcement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

_TYPES: dict[str, DataType] = {
    "string": StringType(), "int": IntegerType(), "long": LongType(), "double": DoubleType(), "timestamp": TimestampType(), "strings": ArrayType(StringType()),
}


def _schema(columns: str, **other: DataType) -> StructType:
    """A schema from "name type, name type"; ``other`` has types by name."""
    pairs = [c.split() for c in columns.split(",")]
    return StructType([StructField(name, other.get(kind) or _TYPES[kind]) for name, kind in pairs])


SEQUENCES = _schema("id string, description string, sequence string, length int")
REJECTS = _schema("path string, last_line long, description string, reason string")
CHUNKS = _schema("chunk_id string, sequence_id string, description string, sequence string, length int, content_hash string")
HITS_RAW = _schema(
    "qseqid string, sseqid string, pident double, length int, mismatch int, gapopen int, "
    "qstart int, qend int, sstart int, send int, evalue double, bitscore double"
)
HITS_MERGED = _schema(
    "query_id string, subject_id string, percent_identity double, alignment_length int, mismatches int, gap_opens int, "
    "query_start int, query_end int, subject_start int, subject_end int, evalue double, bitscore double, "
    "global_rank int, query_chunk_id string, ref_chunk_id string"
)
#: Ranks of a resolved lineage, from the narrowest.
RANKS = ["species", "genus", "family", "order", "class", "phylum", "kingdom"]
HITS_ENRICHED = StructType([*HITS_MERGED.fields, *_schema("taxon_id long").fields, *_schema(", ".join(f"{r} string" for r in RANKS)).fields])
MANIFEST = _schema(
    "run_id string, input_files strings, total_sequences int, num_chunks int, chunk_size_target int, "
    "chunks entries, created_at timestamp, chunking_strategy string",
    entries=ArrayType(_schema("chunk_id string, num_sequences int, parquet_path string, content_checksum string")),
)
WORK_PACKAGES = _schema(
    "package_id string, query_chunk_id string, ref_chunk_id string, state string, claimed_by string, claimed_at timestamp, "
    "heartbeat_at timestamp, started_at timestamp, completed_at timestamp, attempt int, max_attempts int, error_history strings"
)
AUDIT_EVENTS = _schema(
    "event string, package_id string, from_state string, to_state string, worker_id string, attempt int, "
    "reason string, timestamp timestamp, run_id string"
)
FEATURES = _schema(
    "sequence_id string, hit_count int, mean_percent_identity double, max_percent_identity double, mean_evalue_log10 double, "
    "mean_alignment_length double, std_alignment_length double, best_hit_query_coverage double, taxonomic_entropy double, "
    "num_phyla int, num_kingdoms int, feature_version string, run_id string, created_at timestamp"
)
STATES = ["PENDING", "RUNNING", "COMPLETED", "POISONED"]


class ContractError(ValueError):
    """A frame does not have the columns that its contract names."""


def enforce_contract(df: DataFrame, schema: StructType, rules: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with exactly the columns of ``schema``, in its order and types.

    Missing or extra columns raise at once.  Values that cannot be cast, and rows that break one
    of ``rules`` (name -> condition that must not be false), fail when the frame is read.
    """
    have, want = set(df.columns), set(schema.names)
    if have != want:
        raise ContractError(f"missing columns {sorted(want - have)}, unexpected columns {sorted(have - want)}")
    out = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    for name, fine in (rules or {}).items():
        first = schema.names[0]
        broken = F.raise_error(F.lit(f"contract rule broken: {name}")).cast(schema.fields[0].dataType)
        out = out.withColumn(first, F.when(~F.coalesce(fine, F.lit(True)), broken).otherwise(F.col(first)))
    return out
