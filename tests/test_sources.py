from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from seqloom.contracts import HITS_RAW, SEQUENCES, ContractError, enforce_contract
from seqloom.sources import fasta as FA
from seqloom.sources import tables as TB


def _write(path, text):
    path.write_text(text, newline="")
    return str(path)


def test_scan_fasta(spark, tmp_path):
    path = _write(tmp_path / "a.fasta", "\n>one first protein\nMKV\n  laa \n\n>two\r\nMM*\r\n>>odd\nAC")
    rows = {r["id"]: r for r in FA.scan_fasta(spark, path).collect()}
    assert set(rows) == {"one", "two", ">odd"}
    assert rows["one"]["sequence"] == "MKVLAA" and rows["one"]["length"] == 6 and rows["one"]["description"] == "one first protein"
    assert rows["two"]["sequence"] == "MM*"


def test_empty_fasta(spark, tmp_path):
    assert FA.scan_fasta(spark, _write(tmp_path / "e.fasta", "")).count() == 0


@pytest.mark.parametrize(
    ("text", "reason"),
    [("no header\nMK\n>a\nMK\n", "data before"), (">\nMK\n", "empty header"), (">a\n>b\nMK\n", "without sequence"), (">a\nMK1X2\n", "invalid amino acid characters: 1,2")],
)
def test_rejects(spark, tmp_path, text, reason):
    path = _write(tmp_path / "bad.fasta", text)
    good, bad = FA.validate_sequences(FA.scan_records(spark, path), "quarantine")
    found = bad.collect()
    assert len(found) == 1 and reason in found[0]["reason"] and found[0]["last_line"] >= 1
    assert good.count() == text.count(">") - (0 if text.startswith("no header") else 1)
    with pytest.raises(Exception, match=reason.split(":")[0]):
        FA.scan_fasta(spark, path).collect()


def test_splits_lose_nothing(spark, tmp_path):
    generated = FA.generate_sequences(spark, 300, "seq", 50, 200)
    path = str(tmp_path / "many")
    assert FA.export_fasta(generated.coalesce(1), path) == 300
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        back = FA.scan_fasta(spark, path)
        assert back.rdd.getNumPartitions() > 5
        assert back.exceptAll(enforce_contract(generated, SEQUENCES)).count() == 0 and back.count() == 300
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["id"] for r in FA.head_fasta(spark, path, 3).collect()] == ["seq_00000", "seq_00001", "seq_00002"]
    assert FA.flag_long_sequences(generated, 100).where("too_long").count() == generated.where("length > 100").count()
    assert FA.flag_long_sequences(generated, 0).where("too_long").count() == 0


def test_export_wraps(spark):
    df = spark.createDataFrame([("a", "M" * 173)], "description string, sequence string")
    text = df.select(FA.fasta_text(F.col("description"), F.col("sequence"))).first()[0]
    assert [len(x) for x in text.split("\n")] == [2, 80, 80, 13]


def test_scan_hits(spark, tmp_path):
    row = "q1\ts1\t85.7\t150\t22\t1\t1\t150\t10\t160\t1.5e-45\t250.3"
    path = _write(tmp_path / "h.tsv", f"# comment\n{row}\textra\n\n{row}\n")
    hits = TB.scan_hits(spark, path)
    assert hits.schema == HITS_RAW and hits.count() == 2 and hits.first()["evalue"] == 1.5e-45
    with pytest.raises(Exception, match="12 fields"):
        TB.scan_hits(spark, _write(tmp_path / "s.tsv", "q1\ts1\n")).collect()
    assert TB.scan_hits(spark, _write(tmp_path / "none.tsv", "")).count() == 0


def test_contract(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    schema = spark.createDataFrame([], "a string, b long").schema
    assert enforce_contract(df, schema).schema.simpleString() == "struct<a:string,b:bigint>"
    with pytest.raises(ContractError):
        enforce_contract(df.drop("a"), schema)
    with pytest.raises(Exception, match="positive"):
        enforce_contract(df, schema, {"b is positive": F.col("b") > 1}).collect()


def test_embeddings_dimension(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0])], "sequence_id string, embedding array<float>")
    assert TB.check_dimension(df, 2).count() == 1
    with pytest.raises(Exception, match="3 values"):
        TB.check_dimension(df, 3).collect()
