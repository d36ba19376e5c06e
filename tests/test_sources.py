"""Readers, writers and streams on files made here."""

import base64
import gzip
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sources import files, sinks
from ledgerlake.sources.paged import PagedJson
from ledgerlake.sources.workbooks import workbook_lines
from ledgerlake.streaming import arrivals

ROW = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def test_json_and_packed(spark, tmp_path):
    doc = json.dumps({"rows": [{"k": 1, "v": "a"}, {"k": 2, "v": None}]})
    (tmp_path / "a.json").write_text(doc)
    want = [(1, "a"), (2, None)]
    assert sorted(map(tuple, files.json_rows(spark, str(tmp_path / "a.json"), ROW).collect())) == want
    packed = base64.b64encode(gzip.compress(doc.encode())).decode()
    d = tmp_path / "p"
    d.mkdir()
    for i in range(3):
        (d / f"seed.{i:02d}").write_text(packed[i * len(packed) // 3 : (i + 1) * len(packed) // 3])
    assert sorted(map(tuple, files.packed_rows(spark, str(d), ROW).collect())) == want


def test_csv_and_status(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("사업장명,주소\n가나,서울\n".encode("cp949"))
    assert files.probed_csv(spark, str(tmp_path / "a.csv"), ["사업장명"]).first()["사업장명"] == "가나"
    with pytest.raises(ValueError):
        files.probed_csv(spark, str(tmp_path / "a.csv"), ["none"])
    (tmp_path / "s.tsv").write_text("a\tUPDATED\nb\tFAILED:X\n")
    assert files.status_list(spark, str(tmp_path / "s.tsv")).count() == 2
    for bad in ("a\tX\na\tY\n", "a\n"):
        (tmp_path / "bad.tsv").write_text(bad)
        with pytest.raises(ValueError):
            files.status_list(spark, str(tmp_path / "bad.tsv"))


def test_workbooks(spark, tmp_path):
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as z:
        z.writestr("xl/sharedStrings.xml", "<sst><si><t>사용일자</t></si><si><r><t>금</t></r><r><t>액</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", '<worksheet><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row><c r="A2"><v>45658</v></c></row></sheetData></worksheet>')
    (tmp_path / "a.xlsx").write_bytes(blob.getvalue())
    outer = io.BytesIO()
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("in.xlsx", blob.getvalue())
        z.writestr("b.csv", "a,b\n1,2\n")
    (tmp_path / "o.zip").write_bytes(outer.getvalue())
    (tmp_path / "x.pdf").write_bytes(b"%PDF")
    got = workbook_lines(spark, str(tmp_path)).collect()
    assert [r["cells"] for r in got if r["path"].endswith("a.xlsx")] == [["사용일자", "", "금액"], ["45658"]]
    assert sum(r["path"].endswith("o.zip") for r in got) == 4
    assert [r["error"] is not None for r in got if r["path"].endswith("x.pdf")] == [True]


def test_paged(spark, tmp_path):
    for k in (1, 2):
        (tmp_path / f"p{k}.json").write_text(json.dumps({"rows": [{"n": (k - 1) * 2 + i} for i in range(2)]}))
    spark.dataSource.register(PagedJson)
    df = spark.read.format("paged_json").options(url=f"file://{tmp_path}/p{{page}}.json", rows=4, size=2).load()
    assert sorted(json.loads(r["row"])["n"] for r in df.collect()) == [0, 1, 2, 3]


def test_geojson_and_anchors(spark):
    js = 'var d = {"type": "FeatureCollection", "features": [{"geometry": {"coordinates": [127.0, 37.5]}, "properties": {"v": "a"}}]};'
    df = spark.createDataFrame([(1, js, '<p><a class="x" href="/a?b=1">A <b>c</b></a><a href="/z">Z</a></p>')], "k int, js string, html string")
    assert tuple(files.geojson_points(df, "js", T.StructType([T.StructField("v", T.StringType())])).first()) == (37.5, 127.0, "a")
    assert [tuple(r) for r in files.anchors(df, "k", "html").collect()] == [(1, 0, "/a?b=1", "A c"), (1, 1, "/z", "Z")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a|b", 1), ("c</script>", 2)], "v string, p int")
    assert sinks.markdown_table(df.orderBy("p"), ["v", "p"], 1) == "| v | p |\n| --- | --- |\n| a/b | 1 |\n"
    assert "</script>" not in "".join(r[0] for r in sinks.script_rows(df).collect())
    sinks.write_partitions(df, str(tmp_path / "t"), "p")
    sinks.write_partitions(df.where("p = 2").withColumn("v", F.lit("new")), str(tmp_path / "t"), "p")
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t")).select("v", "p").collect())) == [("a|b", 1), ("new", 2)]
    sinks.upsert(df.withColumn("v", F.lit("up")).where("p = 1"), df, str(tmp_path / "u"), ["p"], ["v"])
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "u")).select("v", "p").collect())) == [("c</script>", 2), ("up", 1)]


def test_streamed_merge(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    batch = lambda xs: spark.createDataFrame(xs, ROW).coalesce(1).write.mode("append").json(src)
    for xs in ([(1, "a"), (2, "b")], [(2, "other"), (3, "c")]):
        batch(xs)
        arrivals.merge_arrivals(spark.readStream.schema(ROW).json(src), out, ck, ["k"], ["v"]).awaitTermination()
    assert sorted(map(tuple, arrivals.latest_snapshot(spark, out).collect())) == [(1, "a"), (2, "b"), (3, "c")]
    assert not arrivals.publish_snapshot(spark.createDataFrame([], ROW), out, passed=False)
    assert arrivals.latest_snapshot(spark, out).count() == 3
    a = spark.createDataFrame([(1, "a"), (2, "b")], ROW)
    assert arrivals.input_fingerprint(a) == arrivals.input_fingerprint(a.orderBy(F.desc("k"))) != arrivals.input_fingerprint(a.limit(1))


def test_late_rows(spark, tmp_path):
    src = str(tmp_path / "ev")
    spark.createDataFrame([("2024-01-01 00:00:00", "a"), ("2024-01-01 00:00:01", "a"), ("2024-01-02 00:00:00", "b")], "t string, k string").select(F.col("t").cast("timestamp").alias("ts"), "k").write.json(src)
    s = spark.readStream.schema("ts timestamp, k string").json(src)
    arrivals.late_counts(s, "ts", "1 hour", "1 day", ["k"]).writeStream.format("memory").queryName("late").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r["k"], r["n"]) for r in spark.table("late").collect()) == [("a", 2), ("b", 1)]
