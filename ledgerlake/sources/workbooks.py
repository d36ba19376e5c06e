"""Sheets of workbooks as cell grids, one row for each line: XLSX, HWPX tables, CSV and ZIP files of these.

Files are read by Spark's binaryFile source and decoded in Arrow batches, one file at a time. Formats whose decoders are not
in the standard library (XLS, HWP, PDF) give one row in `error`.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

csv.field_size_limit(2**31 - 1)
SCHEMA = "path string, member string, sheet string, idx int, cells array<string>, error string"


def _tag(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2]


def _text(e: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in e.iter() if _tag(t) == "t")


def _xlsx(z: zipfile.ZipFile) -> Iterator[tuple[str, list[str]]]:
    names = z.namelist()
    shared = [_text(si) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
    for name in sorted(n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)):
        for row in (e for e in ElementTree.fromstring(z.read(name)).iter() if _tag(e) == "row"):
            cells: list[str] = []
            for c in row:
                letters = re.match("[A-Z]*", c.get("r") or "")[0]
                at = 0
                for x in letters:
                    at = at * 26 + ord(x) - 64
                cells += [""] * (at - 1 - len(cells) if at else 0)
                value = next((v.text or "" for v in c if _tag(v) == "v"), "")
                cells.append(_text(c) if c.get("t") == "inlineStr" else shared[int(value)] if c.get("t") == "s" and value else value)
            yield name[14:-4], cells


def _hwpx(z: zipfile.ZipFile) -> Iterator[tuple[str, list[str]]]:
    for name in sorted(n for n in z.namelist() if re.fullmatch(r"Contents/section\d+\.xml", n)):
        for k, table in enumerate(e for e in ElementTree.fromstring(z.read(name)).iter() if _tag(e) == "tbl"):
            for row in (e for e in table if _tag(e) == "tr"):
                yield f"{name[9:-4]}.{k}", [_text(c) for c in row if _tag(c) == "tc"]


def grids_of(blob: bytes, name: str = "", depth: int = 3) -> Iterator[tuple[str, str, list[str]]]:
    """(member, sheet, cells) of each line of a file, told apart by its first bytes and names inside."""
    if blob[:2] == b"PK":
        with zipfile.ZipFile(io.BytesIO(blob)) as z:
            names = z.namelist()
            if any(n.startswith("xl/") for n in names):
                yield from ((name, s, c) for s, c in _xlsx(z))
            elif any(n.startswith("Contents/section") for n in names):
                yield from ((name, s, c) for s, c in _hwpx(z))
            elif depth:
                for n in sorted(names):
                    if not n.endswith("/"):
                        yield from grids_of(z.read(n), n, depth - 1)
            else:
                raise ValueError("archives are nested too deep")
    elif name.lower().endswith(".csv"):
        try:
            text = blob.decode("utf-8-sig")
        except UnicodeDecodeError:
            text = blob.decode("cp949")
        yield from ((name, "", row) for row in csv.reader(io.StringIO(text)))
    else:
        raise ValueError(f"no decoder for {name or 'this file'}")


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("path", pa.string()), ("member", pa.string()), ("sheet", pa.string()), ("idx", pa.int32()), ("cells", pa.list_(pa.string())), ("error", pa.string())])
    for batch in batches:
        for path, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows, idx = [], {}
            try:
                for member, sheet, cells in grids_of(blob.as_py(), path):
                    k = idx[member, sheet] = idx.get((member, sheet), -1) + 1
                    rows.append({"path": path, "member": member, "sheet": sheet, "idx": k, "cells": cells, "error": None})
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
            except (ValueError, KeyError, IndexError, RuntimeError, NotImplementedError, EOFError, zlib.error, csv.Error, zipfile.BadZipFile, ElementTree.ParseError) as e:
                rows.append({"path": path, "member": None, "sheet": None, "idx": None, "cells": None, "error": f"{type(e).__name__}: {e}"})
            yield pa.RecordBatch.from_pylist(rows, schema)


def workbook_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The lines of all sheets of all files; a file that cannot be read gives one row with its error."""
    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(_lines, SCHEMA)


def placed_rows(lines: DataFrame, places: dict[str, int], carry: list[str] = (), skip: int = 0) -> DataFrame:
    """Rows of sheets without a header: fields by the positions (from 0) of their cells, behind the first `skip` lines.

    Fields in `carry` keep their last value where a cell is empty, as merged cells do."""
    cell = lambda i: F.nullif(F.trim(F.get("cells", F.lit(i))), F.lit(""))
    rows = lines.where((F.col("idx") >= skip) & F.col("error").isNull()).select("path", "member", "sheet", "idx", *(cell(i).alias(f) for f, i in places.items()))
    down = Window.partitionBy("path", "member", "sheet").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("path", "member", "sheet", "idx", *((F.last(f, ignorenulls=True).over(down) if f in carry else F.col(f)).alias(f) for f in places))
