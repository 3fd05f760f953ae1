"""Quality rules: per-document base rules and cross-document line frequency [native]."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import WORD_BREAK, fresh, materialize, words_of

#: Symbols that the base rules count.
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, host, text_hash, t): verdicts depend on host and text alone, so these name a document, whatever its doc_id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"), F.xxhash64(text).alias("text_hash"), text.alias("t"))


def _window_hashes(hashes: Column) -> Column:
    """A hash for each window of WINDOW words, from the column of the words' hashes."""
    n = F.size(hashes)
    starts = F.when(n >= WINDOW, F.sequence(F.lit(1), n - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))


def base_metrics(docs: DataFrame) -> DataFrame:
    """doc_id, host, text_hash and the counts of the base rules; one projection, no shuffle.

    Window equality is by 64-bit hashes of 64-bit word hashes inside one document.
    """
    keys = ["doc_id", "host", "text_hash"]
    first = _keyed(docs).select(
        *keys,
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        words_of(F.col("t")).alias("w"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    second = first.select(
        *keys,
        "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("hashes"),
    )
    # hashes is a column of its own: inside the lambda an expression would be worked out for each window.
    second = second.withColumn("g", _window_hashes(F.col("hashes"))).drop("hashes")
    # Sorted (hash, start) structs put equal windows side by side; documents without any skip this.
    pairs = F.sort_array(F.transform("g", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    third = second.withColumn("s", F.when(F.size(F.array_distinct("g")) < F.size("g"), pairs))
    same = lambda x, i, k: F.coalesce(F.get("s", i + k)["h"] == x["h"], F.lit(False))
    starts = F.sort_array(F.transform(F.filter("s", lambda x, i: same(x, i, -1) | same(x, i, 1)), lambda x: x["p"]))
    fourth = third.withColumn("starts", starts).drop("s", "g")
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct((a["n"] + p + WINDOW - F.greatest(a["end"], p)).cast("long").alias("n"), (p + WINDOW).alias("end")),
    )["n"]
    return fourth.select(*keys, "n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def normal_line(line: Column) -> Column:
    """A line without blanks at its ends, in lower case."""
    return F.lower(F.btrim(line, F.lit(" \t\n\x0b\f\r")))


def line_rows(docs: DataFrame) -> DataFrame:
    """(row, host, text_hash, line_hash, line_words), a row for each line with a word; written once, read by three steps."""
    lines = F.filter(F.transform(F.split("t", "\n"), normal_line), lambda x: x != "")
    rows = (
        _keyed(docs).select(F.monotonically_increasing_id().alias("row"), "host", "text_hash", lines.alias("lines"))
        .select(
            "row",
            "host",
            "text_hash",
            F.inline(F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("line_hash"), F.size(F.split(x, WORD_BREAK)).alias("line_words")))),
        )
    )
    return materialize(rows, "lines")


def frequent_lines(lines: DataFrame, least: int, share: float | None = None) -> DataFrame:
    """(host, line_hash) of lines in ``least`` or more of a host's distinct texts or, with ``share``, in over this part of them (3 at least).

    Copies of one text count once: many copies of a good document are work for dedup, not
    boilerplate.  The distinct step combines in every task before its shuffle, so a hot line
    or host reaches a reducer pre-aggregated.
    """
    per = lines.select("host", "line_hash", "text_hash").distinct()
    df = per.groupBy("host", "line_hash").agg(F.count("*").alias("df"))
    if share is None:
        return df.where(F.col("df") >= least).select("host", "line_hash")
    total = lines.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("n_texts"))
    few = df.where(F.col("df") >= min(least, 3))
    return few.join(total, "host").where((F.col("df") >= least) | (F.col("df") > share * F.col("n_texts"))).select("host", "line_hash")


def quality_rules(docs: DataFrame, least: int = 25, max_removed: float = 0.5, share: float | None = None) -> DataFrame:
    """One row for each document: base metrics, ``base_failed``, ``kept`` and ``n_removed_words``.

    A document is rejected by the base rules (fewer than 10 words, or over 20 % of words in
    repeated 5-word windows) or as depleted: more than ``max_removed`` of its words stand in
    lines above the limits of ``frequent_lines``.  ``source`` is the host.

    Null text counts as empty (rejected: no words), null source as the host ''.  An empty table gives an
    empty result, other columns are not read.  A verdict depends on host and text alone, so rows with null or repeated
    doc_ids are judged like others, each by its own text.
    """
    rules, _ = _judge(docs, least, max_removed, share)
    return rules.drop("host", "text_hash")


def _judge(docs: DataFrame, least: int, max_removed: float, share: float | None) -> tuple[DataFrame, DataFrame]:
    """(verdicts with host and text_hash, lines above the limits as (host, text_hash, line_hash, line_words, row))."""
    lines = line_rows(docs)
    gone = lines.join(frequent_lines(lines, least, share), ["host", "line_hash"])
    # Copies of a text lose the same words: one of them speaks for all.
    removed = gone.groupBy("row", "host", "text_hash").agg(F.sum("line_words").cast("long").alias("n")).groupBy("host", "text_hash").agg(F.max("n").alias("n_removed_words"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rules = (
        base_metrics(docs).withColumn("base_failed", failed)
        .join(removed, ["host", "text_hash"], "left")
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_removed_words") <= max_removed * F.col("n_words")))
        .select("doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")
    )
    return rules, gone


def keep_good(docs: DataFrame, least: int = 25, max_removed: float = 0.5, share: float | None = None) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, without their lines above the limits.

    Only ``text`` (and ``n_chars``, if there) changes, and only where a line was removed.  Each kept row comes
    once, also of rows with null or repeated doc_ids: rows meet verdicts by host and text.  Null texts go (no
    words); extra columns, whatever their names, stay as they are; an empty table gives an empty table.
    """
    rules, gone = _judge(docs, least, max_removed, share)
    host, text_hash, kept, cut = fresh(docs, "_host", "_text_hash", "_kept", "_cut")
    cuts = gone.groupBy("host", "text_hash").agg(F.collect_set("line_hash").alias("cut"))  # no longer than the text
    marks = rules.where("NOT kept OR n_removed_words > 0").select("host", "text_hash", "kept").distinct().join(cuts, ["host", "text_hash"], "left")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumn(host, F.coalesce(F.col("source").cast("string"), F.lit(""))).withColumn(text_hash, F.xxhash64(text))
    joined = keyed.join(marks.toDF(host, text_hash, kept, cut).hint("merge"), [host, text_hash], "left").where(F.coalesce(kept, F.lit(True)))
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x: ~F.array_contains(F.col(cut), F.xxhash64(normal_line(x)))), "\n")
    out = joined.withColumn("text", F.when(F.col(cut).isNotNull(), left).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(cut).isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
