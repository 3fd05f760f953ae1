"""Exact dedup: a log-structured merge index of text digests [native]."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import ascii_lower, fresh, materialize

#: Parquet's own Bloom filters stand beside every run's digests.
_FILTERS = {"parquet.bloom.filter.enabled#digest": "true", "parquet.bloom.filter.expected.ndv#digest": "200000"}


def sha256_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def flush_memtables(docs: DataFrame, digest=sha256_of) -> DataFrame:
    """Level 0: each task's rows are one memtable, flushed as a run sorted by digest.

    No shuffle: a run is a Parquet file with sorted digests (so row groups have narrow
    ranges) and a Bloom filter.
    """
    text = ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return materialize(docs.select("doc_id", text.alias("t")).select("doc_id", digest(F.col("t")).alias("digest")), "lsm-run", sort=["digest", "doc_id"], **_FILTERS)


def compact(runs: DataFrame) -> DataFrame:
    """Merge runs into one level: an entry for each digest with its smallest and largest identifier."""
    merged = runs.groupBy("digest").agg(F.min("doc_id").alias("min_id"), F.max("doc_id").alias("max_id"), F.count("*").alias("n"))
    return materialize(merged, "lsm-level", sort=["digest"], **_FILTERS)


def verified_hits(docs: DataFrame, runs: DataFrame, keep: str, digest=sha256_of) -> tuple[DataFrame, bool]:
    """((digest, t, keep_id, group_size) of texts that stand in two rows or more, whether digests collided).

    The compacted level's digests of two or more rows are hits.  Texts are read again for hits only, and the smallest
    and the largest of a digest must be the same bytes.  Texts are dealt by digest whatever the number of hits (a plan that
    broadcasts few hits would not hold for many); Spark splits a hot digest's texts, of which a semi-join has no second side.
    ``t`` is null but for digests that fail: their rows are counted by text.
    """
    pick, ident = (F.min, "min_id") if keep == "smallest" else (F.max, "max_id")
    hits = materialize(compact(runs).where("n > 1").select("digest", F.col(ident).alias("keep_id"), F.col("n").alias("group_size")), "lsm-hits")
    text = ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("t")
    texts = docs.select("doc_id", text).withColumn("digest", digest(F.col("t"))).join(hits.select("digest").hint("merge"), "digest", "left_semi")
    collided = materialize(
        texts.groupBy("digest").agg(F.min("t").alias("low"), F.max("t").alias("high")).where("low <> high").select("digest"), "lsm-collided"
    )
    none = F.lit(None).cast("string").alias("t")
    if not collided.take(1):
        return hits.select("digest", none, "keep_id", "group_size"), False
    split = texts.join(collided, "digest", "left_semi").groupBy("digest", "t").agg(pick("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return hits.join(collided, "digest", "left_anti").select("digest", none, "keep_id", "group_size").unionByName(split), True


def exact_duplicates(docs: DataFrame, keep: str = "smallest", digest=sha256_of) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) for every row of ``docs(doc_id, text, ...)``.

    Texts are equal when identical after lower-casing A-Z.  Runs are flushed and compacted, and hits verified
    by their bytes (see ``verified_hits``).  The index holds 40 bytes a row and hits one row a group, so a
    group with a third of all rows meets in one place only as counts.

    Null text counts as empty.  ``keep``: the row with the ``smallest`` or ``largest`` doc_id
    stays.  A null doc_id is never the one kept beside a doc_id; rows without a doc_id of a group without any have a null
    keep_id and are kept.  Rows that repeat both doc_id and text are all flagged alike.  An empty table
    gives an empty table; other columns are not read.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    runs = flush_memtables(docs, digest)
    hits, collided = verified_hits(docs, runs, keep, digest)
    if collided:
        text = ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("own")
        runs = docs.select("doc_id", text).withColumn("digest", digest(F.col("own")))
        rows = runs.join(hits.withColumnRenamed("digest", "hit"), (F.col("digest") == F.col("hit")) & (F.col("t").isNull() | (F.col("t") == F.col("own"))), "left")
    else:
        rows = runs.join(hits.drop("t").withColumnRenamed("digest", "hit").hint("merge"), F.col("digest") == F.col("hit"), "left")
    keep_id = F.when(F.col("hit").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    out = rows.select("doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), "digest")
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def drop_exact_duplicates(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with all columns as they were: one row of each text.

    Rows are judged by their own text, so unlike texts with one doc_id or none don't touch each other.  Of
    rows that repeat the kept doc_id and text any one stays.  Null and empty texts are one text.
    """
    runs = flush_memtables(docs)
    hits, _ = verified_hits(docs, runs, keep)
    digest, own, hit, text, keep_id, size = fresh(docs, "_digest", "_own", "_hit", "_text", "_keep", "_size")
    named = hits.toDF(hit, text, keep_id, size).hint("merge")
    marked = docs.withColumn(own, ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit("")))).withColumn(digest, sha256_of(F.col(own)))
    joined = marked.join(named, (F.col(digest) == F.col(hit)) & (F.col(text).isNull() | (F.col(text) == F.col(own))), "left")
    lone = joined.where(F.col(hit).isNull()).select(*docs.columns)
    best = joined.where(F.col(hit).isNotNull() & F.col("doc_id").eqNullSafe(F.col(keep_id))).dropDuplicates([own]).select(*docs.columns)
    return lone.unionByName(best)
