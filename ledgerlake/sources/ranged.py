"""CSV files of any size, read by byte ranges.

A quoted field may hold line breaks, so a task that starts in the middle of a file cannot tell a record's first line from a
line inside a field. Two passes settle that without any task reading more than its range:

1. Every range is scanned from its first line break on. The scan gives, for each encoding, whether the bytes fit it, and
   what state the range ends in (between records or inside a quoted field) for either state that it may start in. Such
   functions of two states compose, so the states at all starts follow from the ranges in order, and the encoding of a file
   is the first that all its ranges fit.
2. Every range is read from its first line break on with its known state: what is left of a record of the range before is
   passed over, and a record that begins in the range is read to its end, wherever that is.

Line breaks and quotes are single bytes that no character of the encodings here contains, so ranges never cut a character.
Files are opened through pyarrow's file systems, in slices; a task holds one slice and one record at a time.
"""

from __future__ import annotations

import csv
import json
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SLICE = 1 << 20
#: csv.reader's default limit of 128 KB for a field would refuse long texts.
FIELD = 2**31 - 1
BETWEEN, INSIDE = 0, 1
#: A line that ends a quoted field that is open; else it opens one that holds it.
_PROBE = '",end\n'


def opened(path: str) -> pa.NativeFile:
    """A random-access stream of a file, given by a path or a URI of any file system that pyarrow knows."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(inner)


def _lines(file: pa.NativeFile, start: int, end: int | None = None) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines that begin in [start, end), line break included; start is at the beginning of a line."""
    file.seek(start)
    at, rest = start, b""
    while True:
        data = file.read(SLICE)
        *whole, rest = (rest + data).split(b"\n") if data else ([rest] if rest else []) + [b""]
        for line in whole:
            if end is not None and at >= end:
                return
            line += b"\n" * bool(data)
            yield at, line
            at += len(line)
        if not data:
            return


def _first_line(file: pa.NativeFile, start: int, end: int) -> int:
    """Offset of the first line that begins in [start, end], end if none does."""
    if start == 0:
        return 0
    at = start - 1
    file.seek(at)
    while at < end:
        data = file.read(min(SLICE, end - at))
        if not data:
            return end
        if (k := data.find(b"\n")) >= 0:
            return at + k + 1
        at += len(data)
    return end


def _pieces(line: str) -> list[str]:
    """A line cut after carriage returns that stand alone, as text files are read with newline=''."""
    if "\r" not in line[:-1]:
        return [line]
    body = line[:-2] if line.endswith("\r\n") else line[:-1] if line.endswith(("\n", "\r")) else line
    parts = body.split("\r")
    return [p + "\r" for p in parts[:-1]] + [parts[-1] + line[len(body) :]]


def _ends(lines: Iterator[str], state: int) -> int:
    """The state after some lines that start in a state. Records are parsed and dropped one at a time."""
    def fed() -> Iterator[str]:
        if state == INSIDE:
            yield '"\n'
        yield from lines
        yield _PROBE

    last: list[str] = []
    for last in csv.reader(fed()):
        pass
    return INSIDE if last[-1:] == ["end"] else BETWEEN


def _coded(path: str, start: int, end: int, encoding: str, state: int) -> tuple[bool, int]:
    """Whether a range's lines fit an encoding, and the state that the range ends in."""
    with opened(path) as file:
        first = _first_line(file, start, end)
        codec = encoding.removesuffix("-sig") if first else encoding

        def lines() -> Iterator[str]:
            for at, line in _lines(file, first, end):
                yield from _pieces(line.decode(codec if at == first else encoding.removesuffix("-sig")))

        try:
            return True, _ends(lines(), state)
        except UnicodeDecodeError:
            return False, BETWEEN


def _probed(encodings: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(FIELD)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                fits = []
                for encoding in encodings:
                    ok, between = _coded(row["path"], row["start"], row["end"], encoding, BETWEEN)
                    fits.append({"fits": ok, "between": between, "inside": _coded(row["path"], row["start"], row["end"], encoding, INSIDE)[1] if ok else BETWEEN})
                out.append({**row, "coded": fits})
            yield pa.RecordBatch.from_pylist(out, batch.schema.append(pa.field("coded", pa.list_(pa.struct([("fits", pa.bool_()), ("between", pa.int32()), ("inside", pa.int32())])))))

    return run


def file_ranges(spark: SparkSession, paths: str | list[str], split: int = 64 << 20) -> DataFrame:
    """(path, start, end): the files under paths, which may hold wildcards, cut into ranges of at most `split` bytes."""
    files = spark.read.format("binaryFile").load(paths).select("path", F.col("length").alias("size"))
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split).cast("long")))
    return files.select("path", "size", at.alias("start")).select("path", "start", F.least(F.col("start") + split, F.col("size")).alias("end"))


def planned_ranges(spark: SparkSession, paths: str | list[str], encodings: tuple[str, ...] = ("utf-8-sig", "cp949"), split: int = 64 << 20) -> DataFrame:
    """(path, start, end, encoding, state): each range with its file's encoding (null if none fits) and the state it starts in.

    A task scans one range; the ranges of a file meet as rows of a few bytes, in order."""
    ranges = file_ranges(spark, paths, split)
    scanned = ranges.repartition("path", "start").mapInArrow(_probed(encodings), "path string, start long, end long, coded array<struct<fits:boolean,between:int,inside:int>>")
    each = F.col("ranges")
    fits = lambda k: F.forall(each, lambda r: F.get(r["coded"], F.lit(k))["fits"])
    chosen = F.coalesce(*(F.when(fits(k), F.lit(k)) for k in range(len(encodings))))
    files = scanned.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("start", "end", "coded"))).alias("ranges")).withColumn("k", chosen)
    step = lambda r: F.get(r["coded"], F.coalesce(F.col("k"), F.lit(0)))
    none = F.array().cast("array<int>")
    # the states at the starts: what each range makes of the state before it, in order
    states = F.aggregate(each, F.struct(F.lit(BETWEEN).alias("now"), none.alias("seen")), lambda a, r: F.struct(F.when(a["now"] == INSIDE, step(r)["inside"]).otherwise(step(r)["between"]).alias("now"), F.concat(a["seen"], F.array(a["now"])).alias("seen")))["seen"]
    rows = files.select("path", F.get(F.array(*(F.lit(e) for e in encodings)), F.col("k")).alias("encoding"), F.explode(F.arrays_zip(each.alias("range"), states.alias("state"))).alias("r"))
    return rows.select("path", F.col("r.range.start").alias("start"), F.col("r.range.end").alias("end"), "encoding", F.col("r.state").alias("state"))


def records(path: str, start: int, end: int, encoding: str, state: int) -> Iterator[list[str]]:
    """The records of a file that begin in a range, as csv.reader gives them; blank lines are left out."""
    with opened(path) as file:
        first = _first_line(file, start, end)
        plain = encoding.removesuffix("-sig")
        here = first

        def lines() -> Iterator[str]:
            nonlocal here
            if state == INSIDE:
                yield '"\n'
            for at, line in _lines(file, first):
                *some, last = _pieces(line.decode(encoding if at == 0 else plain))
                for piece in some:
                    yield piece
                here = at + len(line)
                yield last

        reader = csv.reader(lines())
        if state == INSIDE and first < end and next(reader, None) is None:
            return
        while here < end and (row := next(reader, None)) is not None:
            if row:
                yield row


def header_of(path: str, encoding: str) -> list[str]:
    """The first record of a file, without white space around its names."""
    with opened(path) as file:
        lines = (p for at, line in _lines(file, 0) for p in _pieces(line.decode(encoding if at == 0 else encoding.removesuffix("-sig"))))
        return [c.strip() for c in next(csv.reader(lines), [])]


class RangedCsv(DataSource):
    """Records of CSV files by byte ranges. Options: plan (ranges as JSON, of planned_ranges()), columns (names as JSON)."""

    @classmethod
    def name(cls) -> str:
        return "ranged_csv"

    def schema(self) -> str:
        return ", ".join(f"`{c.replace('`', '``')}` string" for c in json.loads(self.options["columns"]))

    def reader(self, schema) -> DataSourceReader:
        return RangedReader(json.loads(self.options["plan"]), json.loads(self.options["columns"]))


class RangedReader(DataSourceReader):
    def __init__(self, plan: list[list], columns: list[str]):
        self.plan, self.columns = plan, columns

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.plan]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(FIELD)
        path, start, end, encoding, state = partition.value
        place = {c: i for i, c in enumerate(header_of(path, encoding))}
        at = [place[c] for c in self.columns]
        found: list[list[str | None]] = []
        size = 0
        schema = pa.schema([(c, pa.string()) for c in self.columns])
        batch = lambda: pa.record_batch([pa.array(x, pa.string()) for x in zip(*found)] or [pa.array([], pa.string()) for _ in at], schema=schema)
        rows = records(path, start, end, encoding, state)
        if start == 0:
            next(rows, None)
        for row in rows:
            found.append([row[i] if i < len(row) else None for i in at])
            size += sum(map(len, row))
            if len(found) == 10_000 or size > 4 * SLICE:
                yield batch()
                found, size = [], 0
        if found:
            yield batch()


def ranged_csv(spark: SparkSession, paths: str | list[str], required: list[str], encodings: tuple[str, ...] = ("utf-8-sig", "cp949"), split: int = 64 << 20) -> DataFrame:
    """The required columns of CSV files as strings, equal to what csv.DictReader gives over each whole file.

    A file is read in the first of the encodings that all its bytes fit, by as many tasks as it has ranges of `split` bytes.
    Blank lines are no records, missing cells are null, of columns of one name the last counts. Raises ValueError if a file
    fits no encoding or lacks a required column. What comes to the driver is one row for each range, as for any file scan.
    """
    plan = planned_ranges(spark, paths, encodings, split).collect()
    if bad := next((r["path"] for r in plan if r["encoding"] is None), None):
        raise ValueError(f"no encoding of {encodings} fits {bad}")
    for path, encoding in sorted({(r["path"], r["encoding"]) for r in plan}):
        if lacks := sorted(set(required) - set(header_of(path, encoding))):
            raise ValueError(f"{path} lacks the columns {lacks}")
    spark.dataSource.register(RangedCsv)
    ranges = [[r["path"], r["start"], r["end"], r["encoding"], r["state"]] for r in sorted(plan, key=lambda r: (r["path"], r["start"]))]
    return spark.read.format("ranged_csv").option("plan", json.dumps(ranges)).option("columns", json.dumps(required)).load()
