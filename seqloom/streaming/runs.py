"""Run logs and incoming sequences as streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from seqloom.contracts import CHUNKS, REJECTS
from seqloom.functions.scalar import exit_label
from seqloom.operators.chunking import chunk_sequences
from seqloom.sources.fasta import RECORD_END, records_of, unpacked, validate_sequences, with_place


#: Bytes of files in a micro-batch.
BATCH_BYTES = 1 << 30


def stream_run_metrics(runs: DataFrame, window: str = "1 minute", late: str = "5 minutes") -> DataFrame:
    """Packages, completed share, hits a second and failures in each window of ``ts``, with late rows up to ``late``."""
    seconds = F.col("w.end").cast("double") - F.col("w.start").cast("double")
    sums = runs.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w")).agg(
        F.count("*").alias("packages"), F.count_if(F.col("exit_code") == 0).alias("completed"), F.sum("hits").alias("hits"), F.count_if(exit_label(F.col("exit_code")).isNotNull()).alias("errors")
    )
    return sums.select(F.col("w.start").alias("window_start"), "packages", "completed", (100.0 * F.col("completed") / F.col("packages")).alias("progress_pct"), (F.col("hits") / seconds).alias("hits_per_s"), "errors")


class StaleWatch(StatefulProcessor):
    """Keeps a package's last heartbeat; a timer in event time tells when it is too old."""

    def __init__(self, timeout_seconds: int):
        self.timeout_ms = timeout_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        at, open_ = (self.last.get()[0] if self.last.exists() else None), True
        for frame in rows:
            newest = frame.sort_values("ts").iloc[-1]
            ms = int(pd.Timestamp(newest["ts"]).timestamp() * 1000)
            if at is None or ms >= at:
                at, open_ = ms, newest["state"] == "RUNNING"
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if open_:
            self.last.update((at,))
            self.handle.registerTimer(at + self.timeout_ms + 1)
        elif self.last.exists():
            self.last.clear()
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.last.exists():
            at = self.last.get()[0]
            self.last.clear()
            yield pd.DataFrame({"package_id": [key[0]], "last_seen": [pd.Timestamp(at, unit="ms")], "timeout_s": [self.timeout_ms // 1000]})

    def close(self) -> None:
        pass


def stream_stale_packages(heartbeats: DataFrame, timeout_seconds: int = 120, late: str = "10 seconds") -> DataFrame:
    """A row for each package whose last heartbeat (package_id, state, ts) has become older than the timeout."""
    return (
        heartbeats.withWatermark("ts", late).groupBy("package_id")
        .transformWithStateInPandas(StaleWatch(timeout_seconds), "package_id string, last_seen timestamp, timeout_s long", "append", "EventTime")
    )


def stream_fasta(spark: SparkSession, path: str, files_per_trigger: int | None = None, bytes_per_trigger: int = BATCH_BYTES) -> DataFrame:
    """FASTA records as they arrive in files of ``path``, each with its file and block; for ``ingest_fasta``.

    A batch takes files up to ``bytes_per_trigger`` (one at least), so that many small files make few batches; with ``files_per_trigger`` it takes so many files instead.
    """
    limit = ("maxBytesPerTrigger", str(bytes_per_trigger)) if files_per_trigger is None else ("maxFilesPerTrigger", str(files_per_trigger))
    return with_place(spark.readStream.option("lineSep", RECORD_END).option(*limit).text(path))


def stream_packs(spark: SparkSession, path: str, bytes_per_trigger: int = BATCH_BYTES) -> DataFrame:
    """As ``stream_fasta``, of many small files that arrive packed: Parquet files of ``path`` with a row (path, content) for each.

    A million files cost a store and the stream's list a million entries, a pack one.
    """
    packs = spark.readStream.schema("path string, content string").option("maxBytesPerTrigger", str(bytes_per_trigger)).parquet(path)
    return unpacked(packs)


def fasta_sinks(num_chunks: int, out: str) -> Callable[[DataFrame, int], None]:
    """A sink of micro-batches of ``stream_fasta`` with two outputs below ``out``: ``chunks``, and ``rejects`` with file, line and reason.

    A file arrives whole in one batch, so its first record is told by the block at byte 0 and lines are counted as in a
    scan.  Each batch has a folder of its own in both outputs and replaces it when it is run again
    after a failure, so no record is lost or doubled.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)  # read once for both outputs
        try:
            good, bad = validate_sequences(records_of(batch), "quarantine")
            chunk_sequences(good, num_chunks).write.mode("overwrite").parquet(f"{out}/chunks/batch={number}")
            bad.write.mode("overwrite").parquet(f"{out}/rejects/batch={number}")
        finally:
            batch.unpersist()

    return write


def ingest_fasta(spark: SparkSession, path: str, num_chunks: int, out: str, checkpoint: str, files_per_trigger: int | None = None, packs: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(chunk rows, rejects): all FASTA files of ``path``, and all those in ``packs`` (see ``stream_packs``), that no earlier run with ``checkpoint`` has taken in are added to ``out``."""
    schemas = {"chunks": CHUNKS, "rejects": REJECTS}
    for name, schema in schemas.items():  # so that both outputs can be read before a file has come
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{out}/{name}/batch=-1")
    stream = stream_fasta(spark, path, files_per_trigger)
    if packs is not None:
        stream = stream.unionByName(stream_packs(spark, packs))
    write_batches(stream, fasta_sinks(num_chunks, out), checkpoint).awaitTermination()
    chunks, rejects = (spark.read.schema(schema).parquet(f"{out}/{name}").drop("batch") for name, schema in schemas.items())
    return chunks, rejects


def write_batches(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str):
    """Start a query that hands each micro-batch to ``sink`` and stops when all that is there has been read."""
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
