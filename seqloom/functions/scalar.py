"""Column functions: hashing, naming, parsing.  All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Raw hit columns and their names after the merge, in order (fixed names).
RAW_TO_MERGED = {
    "qseqid": "query_id",
    "sseqid": "subject_id",
    "pident": "percent_identity",
    "length": "alignment_length",
    "mismatch": "mismatches",
    "gapopen": "gap_opens",
    "qstart": "query_start",
    "qend": "query_end",
    "sstart": "subject_start",
    "send": "subject_end",
    "evalue": "evalue",
    "bitscore": "bitscore",
}


def assign_chunk(id_: Column, n: int) -> Column:
    """The SHA-256 of the id, as a 256-bit number, modulo ``n``: eight 32-bit limbs folded in longs."""
    if n <= 0:
        raise ValueError("num_chunks must be positive")
    digest = F.sha2(id_, 256)
    out = F.lit(0).cast("long")
    for k in range(8):
        limb = F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")
        out = (out * F.lit(1 << 32) + limb) % F.lit(n)
    return out


def content_hash(sequence: Column) -> Column:
    return F.sha2(F.upper(sequence), 256)


def chunk_name(index: Column, prefix: str) -> Column:
    """The prefix and the index with three digits, or more if it has more."""
    return F.format_string(f"{prefix}%03d", index.cast("long"))


def num_chunks(total: Column, chunk_size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(total / F.lit(chunk_size))).cast("int")


def package_id(query_chunk: Column, ref_chunk: Column) -> Column:
    return F.concat_ws("_", F.lit("wp"), query_chunk, ref_chunk)


def classify_exit(code: Column) -> Column:
    """What an aligner's exit code says."""
    return (
        F.when(code == 0, "ok").when(code == 137, "out_of_memory").when(code == -1, "timeout").when(code == -2, "binary_missing").when(code.isNotNull(), "error")
    )


def exit_label(code: Column) -> Column:
    """The coarser label of the error counter; null for success."""
    return F.when(code == 137, "oom").when(code != 0, "diamond_error")


def extract_accession(subject_id: Column) -> Column:
    """``sp|P12345.2|NAME`` -> ``P12345``; an id without bars only loses its version."""
    middle = F.when(subject_id.contains("|"), F.split_part(subject_id, F.lit("|"), F.lit(2))).otherwise(subject_id)
    return F.regexp_replace(middle, r"\.\d+$", "")


def log10_evalue(evalue: Column) -> Column:
    """log10 with 0 taken as 1e-300."""
    return F.log10(F.greatest(evalue, F.lit(1e-300)))
