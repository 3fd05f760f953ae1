"""A corpus pipeline of five stages over ``documents``: filter, dedup, near-dedup, mix, tokenize."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqloom.llm import bpe, exact_dedup, mixing, quality, similar
from seqloom.llm.common import discard, scratch_path, scratch_scope


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the line-frequency rule reject go; lines above the limits go from the rest.

    Null and empty texts go; rows with null or repeated doc_ids are judged each by its own text; other columns stay as they are; an
    empty table gives an empty table.
    """
    return quality.keep_good(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in lower case; null and empty texts are one) the one with the smallest doc_id stays, of repeated rows any one."""
    return exact_dedup.drop_exact_duplicates(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by SimHash or by five-word shingles of similarity 0.8 the document with the smallest doc_id stays; rows without a doc_id stay."""
    return similar.drop_similar(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document is read at least once, and no source over 1.5 times as often as another; a null source is a source of its own."""
    return mixing.mix_sources(docs, max_repetition=1.5, cover=True)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, which are what is trained on, with digests of the ids and of the text that they decode to; no ids for null texts."""
    return bpe.digests(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("mixing", mix_stage),
    ("bpe", bpe_stage),
]

#: SimHash needs XXH64, and the last stage byte-level BPE: SQL has neither, so tests check the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  Every stage is written to the shared folder and read again; a stage's own tables, and the stage before it, go then."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        with scratch_scope(spark, f"work-{name}"):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        docs.scratch = path
        if before is not None:
            discard(before)
        before = docs
    return docs
