"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that end a word: space and \t \n \v \f \r.
WORD_BREAK = r"[\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


_scopes: list[str] = []


def _base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="seqloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; on a cluster the
    setting is required, because a machine-local folder is not shared.
    """
    return f"{_scopes[-1] if _scopes else _base(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession, name: str) -> Iterator[None]:
    """Tables that are written inside go when it ends: what came of them must be written by then, to a path asked for before."""
    path = f"{_base(spark)}/{name}-{uuid.uuid4().hex}"
    _scopes.append(path)
    try:
        yield
    finally:
        _scopes.remove(path)
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def materialize(df: DataFrame, name: str, sort: list[str] | None = None, **options: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: this cuts lineage."""
    path = scratch_path(df.sparkSession, name)
    out = df.sortWithinPartitions(*sort) if sort else df
    out.write.options(**options).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` from which nothing is read any more: all that came of them is written."""
    for table in tables:
        _delete(table.sparkSession, table.scratch)


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores behind it until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    ``lower`` has a fast path for ASCII; the slower ``translate`` is needed only where the
    text holds another letter that ``lower`` would change.
    """
    other = text.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]")
    return F.when(other, F.translate(text, _UPPER, _UPPER.lower())).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of the undirected graph ``edges(src, dst)`` of longs.

    ``component`` is the smallest node that can be reached.  Large-star and small-star
    rounds (Kiveris et al. 2014) turn the graph into stars in O(log^2 n) rounds; each round
    is two aggregations and two joins, and its edges are written so that lineage stays
    short.  Only counts reach the driver.  Nodes without an edge to another node are not
    returned; null ends and loops are ignored; an empty table gives an empty table.
    """
    pairs = (
        edges.where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst")
        .select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
        .distinct()
    )
    now = materialize(pairs, "cc")
    state = None
    for _ in range(max_rounds):
        seen = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 20)))).first())
        if seen == state or not seen[0]:
            break
        state = seen
        ends = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = ends.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = now.join(least, F.col("a") == F.col("u")).select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(low, "b")
        small = joined.select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).where("x <> y")
        now = materialize(small.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "cc")
    else:
        raise RuntimeError("connected_components did not settle")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
