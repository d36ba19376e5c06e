"""CSV by byte ranges and paged services, against csv.DictReader and plain counts."""

import csv
import http.server
import io
import json
import random
import threading
from urllib.parse import parse_qs, urlparse

import pytest

from ledgerlake.sources import ranged
from ledgerlake.sources.files import probed_csv
from ledgerlake.sources.paged import PagedJson, Pages
from ledgerlake.sources.ranged import planned_ranges, ranged_csv, records


def whole(data: bytes, encoding: str) -> list[dict]:
    return list(csv.DictReader(io.TextIOWrapper(io.BytesIO(data), encoding, newline="")))


def odd_rows(n: int, seed: int, alphabet: str) -> str:
    rng, out = random.Random(seed), ["name,address,note\r\n"]
    for i in range(n):
        cells = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 12))) for _ in range(rng.choice((3, 3, 3, 2, 4)))]
        quoted = lambda c: '"' + c.replace('"', '""') + '"'
        out.append(",".join(quoted(c) if rng.random() < 0.6 or set(c) & set('",\r\n') else c for c in cells) + rng.choice(("\n", "\r\n", "\n\n")))
    return "".join(out)


@pytest.mark.parametrize("split", [1, 7, 64, 1000, 10**9])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_records_of_ranges_equal_the_whole_file(tmp_path, split, seed):
    """States by composition, as the plan computes them, over every way to cut a file."""
    data = odd_rows(60, seed, 'ab"",\n\r 가é').encode("utf-8-sig")
    path = tmp_path / "a.csv"
    path.write_bytes(data)
    got, state = [], ranged.BETWEEN
    for start in range(0, len(data), split):
        end = min(start + split, len(data))
        got += records(str(path), start, end, "utf-8-sig", state)
        fits, state = ranged._coded(str(path), start, end, "utf-8-sig", state)
        assert fits
    assert got == [r for r in csv.reader(io.TextIOWrapper(io.BytesIO(data), "utf-8-sig", newline="")) if r]


def test_ranged_csv(spark, tmp_path):
    texts = {"a.csv": ('utf-8-sig', 'ab",\n 가é'), "b.csv": ("utf-8", 'ab"x,\n'), "c.csv": ("cp949", 'ab",\n 가나')}
    want = []
    for k, (name, (encoding, alphabet)) in enumerate(texts.items()):
        data = odd_rows(400, k, alphabet).encode(encoding)
        (tmp_path / name).write_bytes(data)
        want += [(r["note"], r["name"]) for r in whole(data, "cp949" if encoding == "cp949" else "utf-8-sig")]
    plan = planned_ranges(spark, str(tmp_path), split=1500).collect()
    assert len(plan) > 10 and {(r["path"][-5:], r["encoding"]) for r in plan} == {("a.csv", "utf-8-sig"), ("b.csv", "utf-8-sig"), ("c.csv", "cp949")} and {r["state"] for r in plan} == {0, 1}
    df = ranged_csv(spark, str(tmp_path), ["note", "name"], split=1500)
    assert df.rdd.getNumPartitions() == len(plan)
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(map(tuple, df.collect()), key=key) == sorted(want, key=key)


def test_late_byte_decides_the_encoding(spark, tmp_path):
    """A file that is ASCII but for its last line: a sample of its head would take the wrong encoding."""
    data = b"name,v\n" + b"plain,1\n" * 20_000 + "가나,2\n".encode("cp949")
    (tmp_path / "a.csv").write_bytes(data)
    df = ranged_csv(spark, str(tmp_path), ["name"], split=30_000)
    assert df.count() == 20_001 and df.where("name = '가나'").count() == 1
    (tmp_path / "a.csv").write_bytes(data + b"\xff\xff\n")
    with pytest.raises(ValueError, match="fits"):
        probed_csv(spark, str(tmp_path), ["name"])


def test_long_fields_and_slices(tmp_path, monkeypatch):
    monkeypatch.setattr(ranged, "SLICE", 100)
    csv.field_size_limit(ranged.FIELD)
    data = ('a,b\n"' + "line\n" * 50_000 + '",2\n' + "x" * 300_000 + ",3\nlast,4").encode()
    (tmp_path / "a.csv").write_bytes(data)
    got, state = [], ranged.BETWEEN
    for start in range(0, len(data), 40_000):
        end = min(start + 40_000, len(data))
        got += records(str(tmp_path / "a.csv"), start, end, "utf-8", state)
        state = ranged._coded(str(tmp_path / "a.csv"), start, end, "utf-8", state)[1]
    assert [(len(a), b) for a, b in got] == [(1, "b"), (250_000, "2"), (300_000, "3"), (4, "4")]


class Service:
    """A paged service whose rows can grow; it notes the pages that are asked for."""

    def __init__(self, rows: int, size: int):
        self.rows, self.size, self.asked = rows, size, []
        outer = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self):
                page = int(parse_qs(urlparse(self.path).query)["page"][0]) - 1
                outer.asked.append(page)
                found = [{"n": n} for n in range(page * size, min((page + 1) * size, outer.rows))]
                body = json.dumps({"rows": found} if found else {"RESULT": "no data"}).encode()
                self.send_response(200)
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *args):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}/?page={{page}}"


@pytest.mark.parametrize("rows", [0, 1, 2, 3, 4, 5, 6, 7, 8, 202, 203])
def test_end_of_pages(rows):
    service = Service(rows, 2)
    assert Pages({"url": service.url, "size": 2}).end() == divmod(rows, 2)
    assert len(service.asked) <= 2 * (rows // 2 + 2).bit_length() + 1


def test_paged_batch_has_no_cap(spark):
    service = Service(101 * 3 + 1, 3)
    spark.dataSource.register(PagedJson)
    df = spark.read.format("paged_json").options(url=service.url, size=3).load()
    assert df.rdd.getNumPartitions() == 102
    assert sorted(json.loads(r["row"])["n"] for r in df.collect()) == list(range(304))


def test_paged_stream_resumes(spark, tmp_path):
    service = Service(101 * 3 + 1, 3)
    spark.dataSource.register(PagedJson)

    def run():
        stream = spark.readStream.format("paged_json").options(url=service.url, size=3).load()
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
        return sorted(json.loads(r["row"])["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == list(range(304))
    service.rows, service.asked = 310, []
    assert run() == list(range(310))
    assert min(service.asked) >= 101, "pages that the first run has read are not asked for again"
    service.asked = []
    assert run() == list(range(310)) and min(service.asked) >= 103
