from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from seqloom.sources import fasta as FA
from seqloom.streaming import runs as ST


def test_stream_fasta(spark, tmp_path):
    seqs = FA.generate_sequences(spark, 40, "s", 20, 100)
    source = str(tmp_path / "in")
    FA.export_fasta(seqs, source)
    got, rejects = ST.ingest_fasta(spark, source, 5, str(tmp_path / "out"), str(tmp_path / "log"))
    assert got.count() == 40 and got.select("sequence").exceptAll(seqs.select("sequence")).count() == 0 and rejects.count() == 0


def test_stream_metrics(spark, tmp_path):
    rows = [(dt.datetime(2026, 1, 1, 0, i // 3, i), 0 if i % 4 else 137, 60) for i in range(12)]
    source = str(tmp_path / "runs")
    spark.createDataFrame(rows, "ts timestamp, exit_code int, hits int").write.parquet(source)
    stream = spark.readStream.schema("ts timestamp, exit_code int, hits int").parquet(source)
    out = str(tmp_path / "metrics")
    q = ST.stream_run_metrics(stream).writeStream.outputMode("complete").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.read.parquet(out).agg(F.sum("packages"), F.sum("errors"), F.max("hits_per_s")).first()
    assert tuple(got) == (12, 3, 3.0)


def test_stream_stale(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        t = dt.datetime(2026, 1, 1)
        source = tmp_path / "beats"
        schema = "package_id string, state string, ts timestamp"
        for k, rows in enumerate([[("p1", "RUNNING", t), ("p2", "RUNNING", t)], [("p2", "COMPLETED", t + dt.timedelta(seconds=60))], [("p3", "RUNNING", t + dt.timedelta(seconds=600))], [("p3", "RUNNING", t + dt.timedelta(seconds=610))]]):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
        out = str(tmp_path / "stale")
        q = ST.stream_stale_packages(stream, 120).writeStream.foreachBatch(lambda df, _: df.write.mode("append").parquet(out)).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()
        assert [(r["package_id"], r["timeout_s"]) for r in spark.read.parquet(out).collect()] == [("p1", 120)]
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_many_small_files_make_few_batches(spark, tmp_path):
    source, out, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    source.mkdir()
    for i in range(250):
        (source / f"{i}.fasta").write_text(f">s{i}\nMK\n")
    got, _ = ST.ingest_fasta(spark, str(source), 3, out, log)
    assert got.count() == 250 and len(list((tmp_path / "log" / "offsets").glob("[0-9]*"))) == 1


def test_packed_files_are_read_as_files(spark, tmp_path):
    texts = ["junk\nMK\n>a one\nMKV\n", "\n\n>b\nAC D\n E F\t\n>\nMM\n>c\n", ">d\r\nMK\r\r\n>>e\nAC\n>", "", "\n>", ">f x\ry\rM1\n\n", " \x0b>g\nMK"]
    source, packs, none = tmp_path / "in", str(tmp_path / "packs"), tmp_path / "none"
    for folder in (source, none):
        folder.mkdir()
    for i, text in enumerate(texts):
        (source / str(i)).write_text(text, newline="")
    spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path string, content string").write.parquet(packs)
    loose = ST.ingest_fasta(spark, str(source), 3, str(tmp_path / "o1"), str(tmp_path / "l1"))
    packed = ST.ingest_fasta(spark, str(none), 3, str(tmp_path / "o2"), str(tmp_path / "l2"), packs=packs)
    rows = lambda df: sorted(tuple(str(x).rsplit("/", 1)[-1] for x in r) for r in df.collect())
    assert [rows(d) for d in loose] == [rows(d) for d in packed]
    assert {(r["sequence_id"], r["sequence"]) for r in packed[0].collect()} == {("a", "MKV"), (">e", "AC"), ("d", "MK")} and packed[1].count() > 4
