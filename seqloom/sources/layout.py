"""How rows are laid out over tasks and files: ranges of a sort order that no frequent key can fill."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.sources.scratch import materialize

#: Rows of a range whose rows are counted first: few, because a row may be a whole text, and a range is read by one task.
ROWS = 50_000


def ranged(df: DataFrame, keys: list[str], parts: int | None = None) -> DataFrame:
    """``df`` in ranges of ``keys``, each sorted.  Rows with equal keys stand in the order of a hash of all columns, so they may fill several ranges.

    The hash, unlike a row's place, is the same when a lost task runs again, so no row goes to two ranges or none.  Without
    ``parts`` there are as many ranges as shuffle partitions, and Spark joins small ones by their measured size.
    """
    tie = "_tie"
    placed = df.withColumn(tie, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    dealt = placed.repartitionByRange(*([] if parts is None else [parts]), *keys, tie)
    return dealt.sortWithinPartitions(*keys, tie).drop(tie)


def numbered(df: DataFrame, keys: list[str], column: str, rows: int = ROWS) -> DataFrame:
    """``df`` with ``column``, each row's number in the order of ``keys``, from 0; rows with equal keys are numbered in any order.

    Rows are counted, dealt to ranges of about ``rows`` rows and written in order.  A row's number is that of its range's first row,
    a prefix sum over one count a range, and its place in the range, which the writing task counts; so no window runs
    over rows, and no task has more than its range, however many rows have one key (only rows that are equal in all columns stay together).
    """
    n = df.count()
    part, place = f"{column}_part", f"{column}_place"
    where = F.monotonically_increasing_id()
    # The upper bits of the id are the partition, the lower 33 the place in it.
    placed = ranged(df, keys, max(1, -(-n // rows))).withColumn(part, F.shiftright(where, 33)).withColumn(place, where.bitwiseAND(F.lit((1 << 33) - 1)))
    local = materialize(placed, "ranged")
    counts = local.groupBy(part).agg(F.count("*").alias("_n"))
    ahead = counts.select(part, F.coalesce(F.sum("_n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))  # a row a range
    return local.join(F.broadcast(ahead), part).withColumn(column, F.col("_ahead") + F.col(place)).drop(part, place, "_ahead")
