"""Chunks, manifests and the plan of query x reference pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.contracts import CHUNKS
from seqloom.functions.scalar import assign_chunk, chunk_name, content_hash, package_id
from seqloom.sources.layout import ROWS, numbered


def chunk_sequences(sequences: DataFrame, num_chunks: int, prefix: str = "chunk_") -> DataFrame:
    """Rows with their chunk, a function of the id alone; the same for any input order.  A projection, no shuffle."""
    return sequences.select(
        chunk_name(assign_chunk(F.col("id"), num_chunks), prefix).alias("chunk_id"),
        F.col("id").alias("sequence_id"),
        "description",
        "sequence",
        F.col("length").cast("int").alias("length"),
        content_hash(F.col("sequence")).alias("content_hash"),
    ).select(*CHUNKS.names)


def chunk_entries(chunks: DataFrame) -> DataFrame:
    """(chunk_id, num_sequences, content_checksum) of each chunk that has rows.

    The checksum adds up 31-bit parts of a hash over (id, content) of every row, so it doesn't
    depend on order and combines in every task: no chunk is gathered.
    """
    row = F.sha2(F.concat_ws(":", "sequence_id", "content_hash"), 256)
    part = lambda k: F.sum(F.conv(F.substring(row, 8 * k + 1, 8), 16, 10).cast("long"))
    sums = chunks.groupBy("chunk_id").agg(F.count("*").alias("num_sequences"), *[part(k).alias(f"p{k}") for k in range(4)])
    return sums.select("chunk_id", "num_sequences", F.sha2(F.concat_ws(":", *[F.col(f"p{k}") for k in range(4)]), 256).alias("content_checksum"))


def build_manifest(chunks: DataFrame, num_chunks: int, run_id: str, input_files: list[str], created_at: str, path: str = "") -> DataFrame:
    """One row: totals, and an entry for each chunk that has rows (a list as long as the number of chunks)."""
    entry = F.struct("chunk_id", F.col("num_sequences").cast("int").alias("num_sequences"), F.concat(F.lit(f"{path}/chunk_id="), "chunk_id").alias("parquet_path"), "content_checksum")
    total = F.coalesce(F.sum("num_sequences"), F.lit(0)).cast("int")
    return chunk_entries(chunks).agg(F.array_sort(F.collect_list(entry)).alias("chunks"), total.alias("total_sequences")).select(
        F.lit(run_id).alias("run_id"),
        F.array(*[F.lit(f) for f in input_files]).cast("array<string>").alias("input_files"),
        "total_sequences",
        F.lit(num_chunks).alias("num_chunks"),
        F.when(F.col("total_sequences") == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(F.col("total_sequences") / num_chunks))).cast("int").alias("chunk_size_target"),
        "chunks",
        F.lit(created_at).cast("timestamp").alias("created_at"),
        F.lit("deterministic_hash").alias("chunking_strategy"),
    )


def chunk_sequential(sequences: DataFrame, chunk_size: int, order: list[str], prefix: str = "chunk_", rows_per_task: int = ROWS) -> DataFrame:
    """Chunks of exactly ``chunk_size`` rows in ``order``; see ``numbered``: no window runs over rows, no task has over ``rows_per_task`` or so."""
    index = numbered(sequences, order, "_index", rows_per_task)
    return index.withColumn("chunk_id", chunk_name(F.floor(F.col("_index") / chunk_size), prefix)).drop("_index")


def _contents(rows: DataFrame, id_column: str, content: Column, n: str) -> DataFrame:
    """(id, number of rows, fingerprint of the set of contents) of each id.

    Rows are counted by id and content first, so a hot id is combined by every task and its contents meet in many
    tasks; the fingerprint adds and xors hashes of different contents, so it needs no list of them.
    """
    each = rows.select(F.col(id_column).alias("id"), content.alias("content")).groupBy("id", "content").agg(F.count("*").alias("c"))
    wide = F.sum(F.xxhash64(F.lit(1), "content").cast("decimal(38,0)"))
    return each.groupBy("id").agg(F.sum("c").alias(n), F.struct(F.count("*").alias("n"), F.bit_xor(F.xxhash64("content")).alias("x"), wide.alias("s")).alias(f"{n}_set"))


def verify_round_trip(source: DataFrame, chunks: DataFrame) -> DataFrame:
    """(id, problem) for each sequence that was lost, added, changed or has another number of copies; no rows if all is well.

    Contents of an id are compared as sets, by two 64-bit hashes.
    """
    a = _contents(source, "id", content_hash(F.col("sequence")), "n")
    b = _contents(chunks, "sequence_id", F.col("content_hash"), "m")
    problem = (
        F.when(F.col("m").isNull(), "lost").when(F.col("n").isNull(), "added").when(F.col("n_set") != F.col("m_set"), "changed").when(F.col("n") != F.col("m"), "copies")
    )
    return a.join(b, "id", "full_outer").select("id", problem.alias("problem")).where("problem IS NOT NULL")


def duplicate_ids(sequences: DataFrame) -> DataFrame:
    return sequences.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


def chunk_balance(entries: DataFrame) -> DataFrame:
    """How evenly rows lie over chunks."""
    n = F.col("num_sequences")
    return entries.agg(F.count("*").alias("chunks"), F.min(n).alias("min_rows"), F.max(n).alias("max_rows"), F.avg(n).alias("mean_rows"), F.stddev_pop(n).alias("std_rows"))


def generate_pairs(query_chunks: DataFrame, ref_chunks: DataFrame, max_attempts: int = 3) -> DataFrame:
    """A pending package for each pair of chunks: the plan itself is this product, of chunk names only."""
    q = query_chunks.select(F.col("chunk_id").alias("query_chunk_id"))
    r = ref_chunks.select(F.col("chunk_id").alias("ref_chunk_id"))
    return q.crossJoin(r).select(
        package_id(F.col("query_chunk_id"), F.col("ref_chunk_id")).alias("package_id"),
        "query_chunk_id",
        "ref_chunk_id",
        F.lit("PENDING").alias("state"),
        F.lit(0).alias("attempt"),
        F.lit(max_attempts).alias("max_attempts"),
    )


def diff_manifests(old: DataFrame, new: DataFrame) -> DataFrame:
    """(chunk_id, change) over entries of two manifests: added, removed, modified or unchanged."""
    a = old.select("chunk_id", F.col("content_checksum").alias("was"))
    b = new.select("chunk_id", F.col("content_checksum").alias("now"))
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("was") != F.col("now"), "modified").otherwise("unchanged")
    return a.join(b, "chunk_id", "full_outer").select("chunk_id", change.alias("change"))


def generate_pairs_incremental(old: DataFrame, new: DataFrame, ref_chunks: DataFrame, max_attempts: int = 3) -> DataFrame:
    """Packages of added and modified query chunks only."""
    changed = diff_manifests(old, new).where("change IN ('added', 'modified')").select("chunk_id")
    return generate_pairs(changed, ref_chunks, max_attempts)


def pairs_to_resume(packages: DataFrame) -> DataFrame:
    """Packages that are not completed, pending again from attempt 0; a pair that was completed under any package is left out."""
    done = packages.where("state = 'COMPLETED'").select("query_chunk_id", "ref_chunk_id")
    left = packages.where("state <> 'COMPLETED'").join(done, ["query_chunk_id", "ref_chunk_id"], "left_anti")
    return left.withColumn("state", F.lit("PENDING")).withColumn("attempt", F.lit(0))


def missing_pairs(expected: DataFrame, results: DataFrame) -> DataFrame:
    """Expected (query_chunk_id, ref_chunk_id) without a result."""
    keys = ["query_chunk_id", "ref_chunk_id"]
    return expected.select(*keys).join(results.select(*keys).distinct(), keys, "left_anti")


def require_pairs(expected: DataFrame, results: DataFrame, show: int = 50) -> None:
    """Raise if a result is missing; the message names ``show`` of them and says how many there are."""
    missing = missing_pairs(expected, results)
    named = [f"{r[0]} x {r[1]}" for r in missing.orderBy("query_chunk_id", "ref_chunk_id").limit(show).collect()]
    if named:
        raise ValueError(f"missing results for {missing.count()} pairs: {', '.join(named)}")
