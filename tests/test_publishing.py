"""Gated writes, files against notes, and pointers that two writers change at once."""

import threading

import pytest
from pyspark.sql import functions as F

from ledgerlake import storage
from ledgerlake.operators.gates import GateError
from ledgerlake.operators.publishing import Check, Floor, SourcePointers, checked_write, file_digests, file_lineage, lineage_summary, packed_digests, with_repeats
from ledgerlake.plans.catalog import QUERIES


def test_checked_write_publishes_or_raises(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 7 - 1, None if i % 4 == 0 else "d") for i in range(100)], "id long, amount long, day string")
    small = Check("small", F.col("amount") < 0, "warning")
    report = checked_write(df, str(tmp_path / "a"), [small, Floor("days", F.col("day").isNotNull(), F.col("amount") > 0, 0.5), Check("odd", F.col("day") == "x")], F.col("id"), samples=3)
    assert [r[:5] for r in report] == [("small", "warning", 15, 100, False), ("days", "error", 17, 70, True), ("odd", "error", 0, 100, True)]
    assert 1 <= len(report[0][5]) <= 3 and all(int(v) % 7 == 0 for v in report[0][5]) and spark.read.parquet(str(tmp_path / "a")).count() == 100
    with pytest.raises(GateError, match="days") as e:
        checked_write(df, str(tmp_path / "b"), [small, Floor("days", F.col("day").isNotNull(), F.lit(True), 0.8)], F.col("id"))
    assert e.value.report[1][2:5] == (25, 100, False) and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["a"]
    with pytest.raises(FileExistsError):
        checked_write(df, str(tmp_path / "a"), [], F.col("id"))
    empty = checked_write(df.limit(0), str(tmp_path / "c"), [small, Floor("days", F.col("day").isNotNull(), F.lit(True), 0.8)], F.col("id"))
    assert [r[2:5] for r in empty] == [(0, 0, True), (0, 0, True)]


def test_one_job_counts_and_writes(spark, tmp_path):
    df = spark.range(50).toDF("id")
    spark.sparkContext.setJobGroup("gate", "gate")
    checked_write(df, str(tmp_path / "a"), [Check(f"c{i}", F.col("id") % (i + 2) == 1, "warning") for i in range(5)], F.col("id"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("gate")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1


def test_repeats_with_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, "a"), (None, None)], "k long, n string")
    assert sorted((r.k or 0, r.n or "", r.again) for r in with_repeats(df, ["k", "n"], "again").collect()) == [(0, "", False), (1, "", True), (1, "", True), (1, "a", True), (1, "a", True), (2, "a", False)]


def test_lineage(spark, tmp_path):
    import hashlib

    body = b"x" * 40
    (tmp_path / "f1").write_bytes(body)
    digest = hashlib.sha256(body).hexdigest()
    files = file_digests(spark, str(tmp_path / "f1")).select(F.lit("u1").alias("url"), "sha256", "bytes")
    assert files.first()["sha256"] == digest
    wanted = spark.createDataFrame([("a", "u1"), ("a", "u1"), ("a", "u2"), ("b", "u1"), ("c", "u1"), ("d", None)], "source string, url string")
    notes = spark.createDataFrame([("a", "u1", digest, 40), ("a", "u3", digest, 40), ("b", "u1", "0" * 64, 40), ("c", "u1", digest, 31), ("e", "u9", digest, 40)], "source string, url string, sha256 string, bytes long")
    found = file_lineage(wanted, notes, files)
    assert sorted(map(tuple, found.collect())) == [("a", "u1", "VERIFIED"), ("a", "u2", "MISSING"), ("a", "u3", "FOREIGN"), ("b", "u1", "CHANGED"), ("c", "u1", "INVALID_NOTE"), ("e", "u9", "FOREIGN")]
    status = {r.source: (r.status, r.failures.count(",") + (r.failures != "")) for r in lineage_summary(found, wanted).collect()}
    assert status == {"a": ("HOLD", 2), "b": ("HOLD", 3), "c": ("HOLD", 3), "d": ("HOLD", 1)}


def test_packed_files(spark, tmp_path, monkeypatch):
    """Packed files have the digests of the same bytes in files of their own; the query stores few files for many."""
    import hashlib

    bodies = {"a": "길 1\n".encode(), "b": b"", "c": b"x" * 5000}
    found = packed_digests(spark.createDataFrame([(k, bytearray(v)) for k, v in bodies.items()] + [("d", None)], "path string, content binary"))
    assert {r.path: (r.sha256, r.bytes) for r in found.collect()} == {**{k: (hashlib.sha256(v).hexdigest(), len(v)) for k, v in bodies.items()}, "d": (None, None)}
    monkeypatch.setattr(storage, "shared_folder", lambda session: str(tmp_path))
    assert QUERIES["file_lineage"](spark, "/root/testdata/sf0.01").count() == 25
    assert 0 < sum(1 for f in tmp_path.rglob("part-*") if f.is_file()) <= 16


def test_pointers_of_two_writers(spark, tmp_path):
    pointers = SourcePointers(spark, str(tmp_path / "now"))
    assert pointers.latest() == (-1, {}) and pointers.read() is None
    spark.createDataFrame([(1,)], "v long").write.parquet(str(tmp_path / "a1"))
    spark.createDataFrame([(2, "x")], "v long, w string").write.parquet(str(tmp_path / "b1"))
    assert pointers.change({"a": str(tmp_path / "a1"), "b": str(tmp_path / "b1")}) == 0
    assert sorted((r.source, r.v, r.w) for r in pointers.read().collect()) == [("a", 1, None), ("b", 2, "x")]
    numbers = []
    threads = [threading.Thread(target=lambda i=i: numbers.append(SourcePointers(spark, str(tmp_path / "now")).change({f"s{i}": f"v{i}"}))) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(numbers) == list(range(1, 9)), "no number is taken twice"
    number, versions = pointers.latest()
    assert number == 8 and {f"s{i}": f"v{i}" for i in range(8)}.items() <= versions.items(), "no change is lost"
    pointers.change({"a": None})
    assert "a" not in pointers.latest()[1] and sorted(p.name for p in (tmp_path / "now").iterdir() if not p.name.startswith("."))[-1] == "0000000009.json"
