"""FASTA: scan, validation, export, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

#: Residues of generated sequences.
RESIDUES = "ACDEFGHIKLMNPQRSTVWY"
#: What ends a record: the next one's mark.
RECORD_END = "\n>"
_BLANKS = " \t\r\n\x0b\x0c"


def _records(raw: DataFrame) -> DataFrame:
    """From records cut at newline + '>': header, sequence, and text that stands ahead of any header.

    Only the first record of a file still has its own '>'; it is the one at block start 0 that
    begins with it or is no record at all.
    """
    first = (F.col("start") == 0) & (F.col("seq_no") == F.col("first_no"))
    has_mark = F.col("value").startswith(">")
    body = F.when(first & has_mark, F.expr("substring(value, 2)")).otherwise(F.col("value"))
    ahead = first & ~has_mark
    # Plain replacements: a pattern for each line costs more than all else here; lines are trimmed one by one only where there are blanks.
    lined = F.replace(F.replace(body, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    n_lines = F.length("value") - F.length(F.replace(F.col("value"), F.lit("\n"), F.lit(""))) + 1
    parts = _once(raw, ["path", "start", "seq_no"], ahead=ahead, lined=lined, n_lines=n_lines)
    parts = _once(parts, ["path", "start", "seq_no", "ahead", "lined", "n_lines"], top=F.substring_index("lined", "\n", 1))
    parts = _once(parts, ["path", "start", "seq_no", "ahead", "lined", "n_lines", "top"], rest=F.col("lined").substr(F.length("top") + 2, F.length("lined")))
    trimmed = F.array_join(F.transform(F.split("rest", "\n"), lambda x: F.btrim(x, F.lit(_BLANKS))), "")
    residues = F.upper(F.when(F.col("rest").rlike(r"[ \t\x0b\x0c]"), trimmed).otherwise(F.replace(F.col("rest"), F.lit("\n"), F.lit(""))))
    return _once(
        parts,
        ["path", "start", "seq_no", "ahead"],
        description=F.when(~F.col("ahead"), F.btrim("top", F.lit(_BLANKS))),
        sequence=F.when(F.col("ahead"), F.lit("")).otherwise(residues),
        stray=F.when(F.col("ahead"), F.btrim("lined", F.lit(_BLANKS))),
        n_lines=F.col("n_lines"),
    )


def _once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` and new ``columns``, worked out once a row: the optimizer would copy a projection's expressions to each place that reads them."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def scan_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every record of FASTA files, valid or not, with its file and place.

    Files are split at newline + '>', so one large file is read by many tasks.  Reading needs no
    shuffle but for one row a file that says which record is its first.
    """
    return records_of(with_place(spark.read.option("lineSep", RECORD_END).text(paths)))


def with_place(text: DataFrame) -> DataFrame:
    """(value, path, start) of text read with ``RECORD_END``: each record with its file and the first byte of its block; a stream's, too."""
    return text.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))


def unpacked(files: DataFrame) -> DataFrame:
    """``with_place`` of files that are a row (path, content) each: as a reader cuts them, an empty file has no row, and no record follows a mark at the end."""
    content = F.when(F.col("content").endswith(RECORD_END), F.col("content").substr(F.lit(1), F.length("content") - len(RECORD_END))).otherwise(F.col("content"))
    whole = files.where("content <> ''").select("path", content.alias("content"))
    return whole.select(F.explode(F.split("content", RECORD_END)).alias("value"), "path", F.lit(0).cast("long").alias("start"))


def records_of(placed: DataFrame) -> DataFrame:
    """Records from rows of ``with_place`` that are still as Spark read them (a scan, or a micro-batch)."""
    raw = placed.withColumn("seq_no", F.monotonically_increasing_id())
    first = raw.where("start = 0").groupBy("path").agg(F.min("seq_no").alias("first_no"))
    return _records(raw.join(first, "path", "left"))


def reject_reason(description: Column, sequence: Column, stray: Column) -> Column:
    """Why a record is no sequence; null if it is one."""
    odd = F.array_sort(F.array_distinct(F.regexp_extract_all(sequence, F.lit("([^A-Z*])"))))
    return (
        F.when(F.coalesce(stray, F.lit("")) != "", "data before any FASTA header")
        .when(F.coalesce(description, F.lit("")) == "", "empty header")
        .when(F.coalesce(sequence, F.lit("")) == "", "header without sequence")
        .when(F.size(odd) > 0, F.concat(F.lit("invalid amino acid characters: "), F.array_join(odd, ",")))
    )


def with_reason(records: DataFrame) -> DataFrame:
    """Records with ``reason``; blank text ahead of a file's first header is no record."""
    kept = records.where("NOT ahead OR stray <> ''")
    return kept.withColumn("reason", reject_reason(F.col("description"), F.col("sequence"), F.col("stray")))


def line_numbers(records: DataFrame) -> DataFrame:
    """``records`` with ``last_line``, the number in its file of a record's last line (only for rejects' reports).

    Lines are counted inside each block of a file, and blocks' sums, a row a block, inside each file;
    so a large file is numbered by many tasks.
    """
    inside = Window.partitionBy("path", "start").orderBy("seq_no").rowsBetween(Window.unboundedPreceding, 0)
    blocks = records.groupBy("path", "start").agg(F.sum("n_lines").alias("block_lines"))
    ahead = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("path", "start", F.coalesce(F.sum("block_lines").over(ahead), F.lit(0)).alias("lines_ahead"))
    counted = records.withColumn("lines_inside", F.sum("n_lines").over(inside))
    return counted.join(offsets, ["path", "start"]).withColumn("last_line", F.col("lines_ahead") + F.col("lines_inside")).drop("lines_ahead", "lines_inside")


def to_sequences(records: DataFrame) -> DataFrame:
    """id, description, sequence, length."""
    return records.select(
        F.get(F.split("description", r"\s+"), F.lit(0)).alias("id"), "description", "sequence", F.length("sequence").cast("int").alias("length")
    )


def validate_sequences(records: DataFrame, mode: str = "failfast", locate: bool = True) -> tuple[DataFrame, DataFrame]:
    """(sequences, rejects).  ``failfast``: reading the sequences fails at a reject; ``quarantine``: rejects are set aside.

    A failure names the file and the last line of its first reject.  Lines are counted ahead of the check: inside each block of a
    file, and over blocks by prefix sums, in rows without text; so it is one more pass over the files, which
    ``locate=False`` saves (the message then names the block instead).
    """
    if mode not in ("failfast", "quarantine"):
        raise ValueError("mode is 'failfast' or 'quarantine'")
    judged = with_reason(records)
    located = line_numbers(judged.select("path", "start", "seq_no", "n_lines", "description", "reason")).where("reason IS NOT NULL")
    rejects = located.select("path", "last_line", "description", "reason")
    if mode == "quarantine":
        return to_sequences(judged.where("reason IS NULL")), rejects
    what = [F.lit(", record '"), F.coalesce("description", F.lit("")), F.lit("': "), "reason"]
    message = F.concat("path", F.lit(", block at byte "), F.col("start"), *what)
    if locate:
        first = located.orderBy("path", "last_line").limit(1).select(F.concat("path", F.lit(", line "), F.col("last_line"), *what).alias("_message"))
        judged = judged.join(F.broadcast(first), F.lit(True), "left")  # one row at most
        message = F.coalesce("_message", message)
    checked = judged.withColumn("description", F.when(F.col("reason").isNotNull(), F.raise_error(message).cast("string")).otherwise(F.col("description")))
    return to_sequences(checked), rejects


def scan_fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The sequences of FASTA files; a bad record is an error."""
    return validate_sequences(scan_records(spark, paths))[0]


def flag_long_sequences(sequences: DataFrame, max_length: int = 100_000) -> DataFrame:
    """``sequences`` with ``too_long``; 0 turns the check off."""
    return sequences.withColumn("too_long", (F.col("length") > max_length) if max_length else F.lit(False))


def fasta_text(description: Column, sequence: Column, width: int = 80) -> Column:
    """A record with its sequence in lines of ``width``."""
    return F.concat(F.lit(">"), description, F.lit("\n"), F.regexp_replace(sequence, f"(.{{{width}}})(?!$)", "$1\n"))


def export_fasta(sequences: DataFrame, path: str) -> int:
    """Write a FASTA folder and return the number of records, which are counted as they are written."""
    seen = Observation()
    rows = sequences.select(fasta_text(F.col("description"), F.col("sequence")).alias("value")).observe(seen, F.count("*").alias("n"))
    rows.write.mode("overwrite").text(path)
    return seen.get["n"]


def head_fasta(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first ``n`` records in file order."""
    ordered = with_reason(scan_records(spark, path)).where("reason IS NULL").orderBy("path", "start", "seq_no").limit(n)
    return to_sequences(ordered)


def generate_sequences(spark: SparkSession, n: int, prefix: str, min_len: int, max_len: int, seed: int = 42) -> DataFrame:
    """``n`` sequences of uniform length and residues, the same for the same seed."""
    span = max_len - min_len + 1
    size = (F.lit(min_len) + F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(span))).cast("int")
    letters = F.transform(F.sequence(F.lit(1), F.col("length")), lambda i: F.substring(F.lit(RESIDUES), (F.pmod(F.xxhash64(F.lit(seed), F.col("no"), i), F.lit(20)) + 1).cast("int"), F.lit(1)))
    name = F.format_string(f"{prefix}_%05d", F.col("no"))
    return (
        spark.range(n).select(F.col("id").alias("no"), size.alias("length"))
        .select(name.alias("id"), F.concat(name, F.lit(" Synthetic protein "), F.col("no")).alias("description"), F.array_join(letters, "").alias("sequence"), "length")
    )
