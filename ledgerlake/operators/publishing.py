"""Writes that are published only if their checks hold, files against their manifest, and pointers to sources' versions."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.gates import GateError


@dataclass
class Check:
    """Rows that break a rule; an error keeps a write from being published, a warning does not."""

    name: str
    broken: Column
    severity: str = "error"


@dataclass
class Floor:
    """The least share that rows with `good` must have among rows with `counted`; no rows to count is no failure."""

    name: str
    good: Column
    counted: Column
    least: float
    severity: str = "error"


def with_repeats(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """df with a flag for rows whose key other rows have, too. Keys are counted before they meet the rows."""
    counts = df.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1").select(*(F.col(k).alias(f"_k_{k}") for k in key), F.lit(True).alias(name))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key))
    return df.join(counts, same, "left").select(*(df[c] for c in df.columns), F.coalesce(name, F.lit(False)).alias(name))


def _metrics(checks: Sequence[Check | Floor], key: Column, bucket: Column, samples: int) -> list[Column]:
    out = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(checks):
        broken = c.broken if isinstance(c, Check) else c.counted & ~c.good
        out.append(F.count_if(broken).alias(f"n{i}"))
        # of each bucket of keys one, so that what is gathered stays bounded however many rows fail
        out += [F.min(F.when(broken & (bucket == b), key)).alias(f"s{i}_{b}") for b in range(samples)]
        if isinstance(c, Floor):
            out.append(F.count_if(c.counted).alias(f"c{i}"))
    return out


def _report(seen: dict, checks: Sequence[Check | Floor], samples: int) -> list[tuple]:
    rows = []
    for i, c in enumerate(checks):
        n, total = seen[f"n{i}"], seen[f"c{i}"] if isinstance(c, Floor) else seen["rows"]
        ok = (n == 0) if isinstance(c, Check) else (total == 0 or (total - n) / total >= c.least)
        found = sorted(str(v) for b in range(samples) if (v := seen[f"s{i}_{b}"]) is not None)
        rows.append((c.name, c.severity, n, total, ok, found))
    return rows


def checked_write(df: DataFrame, path: str, checks: Sequence[Check | Floor], key: Column, samples: int = 5, bucket: Column | None = None) -> list[tuple]:
    """Writes df as Parquet to a new path, if no error is found: one job counts all checks while it writes.

    Returns (check, severity, n, total, ok, sample) for each check; sample has at most `samples` keys of failing rows, one for
    each bucket of the key's hash. Rows go to a folder beside the path first. If an error is found that folder is deleted and
    GateError raised, with the report as its `report`; nothing is at the path then. Conditions that are null do not hold.
    """
    checks = [Check(c.name, F.coalesce(c.broken, F.lit(False)), c.severity) if isinstance(c, Check) else Floor(c.name, F.coalesce(c.good, F.lit(False)), F.coalesce(c.counted, F.lit(False)), c.least, c.severity) for c in checks]
    spark, seen = df.sparkSession, Observation(f"checks-{uuid.uuid4().hex}")
    bucket = F.pmod(F.xxhash64(key), F.lit(samples)) if bucket is None else bucket
    aside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.observe(seen, *_metrics(checks, key, bucket, samples)).write.parquet(aside)
    report = _report(seen.get, checks, samples)
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    fs = jpath(aside).getFileSystem(spark._jsc.hadoopConfiguration())
    if bad := [r for r in report if r[1] == "error" and not r[4]]:
        fs.delete(jpath(aside), True)
        error = GateError("; ".join(f"{r[0]}: {r[2]} of {r[3]} rows, such as {', '.join(r[5])}" for r in bad))
        error.report = report
        raise error
    if fs.exists(jpath(path)) or not fs.rename(jpath(aside), jpath(path)):
        fs.delete(jpath(aside), True)
        raise FileExistsError(path)
    return report


def report_table(spark: SparkSession, report: list[tuple]) -> DataFrame:
    return spark.createDataFrame(report, "check string, severity string, n long, total long, ok boolean, sample array<string>")


def file_digests(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, sha256, bytes) of files, whole; a file is hashed by one task and none comes to the driver."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def packed_digests(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """(path, sha256, bytes) of small files that are kept as rows of a table, many in one of its files.

    Millions of small files by themselves would each cost a creation, a rename, an entry of a listing and an opening; here
    the cost is that of their bytes."""
    whole = F.col(content)
    return files.select(F.col(path).alias("path"), F.sha2(whole, 256).alias("sha256"), F.octet_length(whole).cast("long").alias("bytes"))


def file_lineage(authorized: DataFrame, parsed: DataFrame, files: DataFrame, least_bytes: int = 32) -> DataFrame:
    """(source, url, state) for every file that is authorised, parsed or both.

    authorized has (source, url); parsed has (source, url, sha256, bytes) as noted when a file was parsed; files has (url,
    sha256, bytes) of what is stored now. States: VERIFIED; MISSING (authorised, not parsed), FOREIGN (parsed, not
    authorised), INVALID_NOTE (no sha256 or too few bytes noted), NOT_STORED, CHANGED (stored bytes differ from the note).
    Addresses that come several times count once; of several notes the first by hash counts.
    """
    noted = parsed.groupBy("source", "url").agg(F.min(F.struct("sha256", "bytes")).alias("_note"))
    wanted = authorized.where("url IS NOT NULL").select("source", "url", F.lit(True).alias("_wanted")).distinct()
    stored = files.groupBy("url").agg(F.min(F.struct(F.col("sha256"), F.col("bytes"))).alias("_stored"))
    both = wanted.join(noted, ["source", "url"], "full").join(stored, "url", "left")
    valid = F.coalesce(F.col("_note.sha256").rlike("^[a-f0-9]{64}$") & (F.col("_note.bytes") >= least_bytes), F.lit(False))
    state = (
        F.when(F.col("_note").isNull(), "MISSING").when(F.col("_wanted").isNull(), "FOREIGN").when(~valid, "INVALID_NOTE").when(F.col("_stored").isNull(), "NOT_STORED")
        .when((F.col("_stored.sha256") != F.col("_note.sha256")) | (F.col("_stored.bytes") != F.col("_note.bytes")), "CHANGED").otherwise("VERIFIED")
    )
    return both.select("source", "url", state.alias("state"))


def lineage_summary(lineage: DataFrame, sources: DataFrame) -> DataFrame:
    """For each source: authorised, parsed and verified files, those in one set only, failures, and PUBLISH_READY or HOLD."""
    s = F.col("state")
    count = lambda *names: F.count_if(s.isin(*names))
    n = lineage.groupBy("source").agg(F.count_if(s != "FOREIGN").alias("authorized"), F.count_if(s != "MISSING").alias("parsed"), count("VERIFIED").alias("verified"), count("MISSING").alias("missing"), count("FOREIGN").alias("foreign"), count("CHANGED", "NOT_STORED").alias("changed"), count("INVALID_NOTE").alias("invalid"))
    names = ["authorized", "parsed", "verified", "missing", "foreign", "changed", "invalid"]
    all_ = sources.select("source").distinct().join(n, "source", "left").select("source", *(F.coalesce(c, F.lit(0)).alias(c) for c in names))
    failures = F.array_compact(F.array(
        F.when(F.col("foreign") + F.col("invalid") + F.col("changed") > 0, "file_not_verified_or_not_in_official_discovery"),
        F.when(F.col("verified") == 0, "missing_official_posts_or_hashed_files"), F.when(F.col("authorized") != F.col("verified"), "official_attachment_missing_parsed_file"),
    ))
    return all_.withColumn("failures", F.array_join(failures, ",")).withColumn("status", F.when(F.col("failures") == "", "PUBLISH_READY").otherwise("HOLD"))


class SourcePointers:
    """Which version of each source is published: numbered manifests in one folder, the highest of which counts.

    A change reads the latest manifest and writes the next number, which only one writer can take; another reads again and
    tries the number after it, so no change is lost and readers see whole manifests only."""

    def __init__(self, spark: SparkSession, folder: str, tries: int = 50):
        self.spark, self.folder, self.tries = spark, folder.rstrip("/"), tries
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def latest(self) -> tuple[int, dict[str, str]]:
        """The number of the latest manifest, and the version of each source; (-1, {}) without any."""
        if not self._fs.exists(self._path(self.folder)):
            return -1, {}
        numbers = [int(n[:-5]) for s in self._fs.listStatus(self._path(self.folder)) if (n := s.getPath().getName()).endswith(".json") and n[:-5].isdigit()]
        if not numbers:
            return -1, {}
        text = self.spark.read.text(f"{self.folder}/{max(numbers):010d}.json", wholetext=True).first()[0]
        return max(numbers), json.loads(text)

    def change(self, versions: dict[str, str | None]) -> int:
        """Points sources to versions (None takes a source out); sources that are not named keep theirs. Returns the number."""
        for _ in range(self.tries):
            number, now = self.latest()
            now = {k: v for k, v in (now | versions).items() if v is not None}
            if self._take(number + 1, json.dumps(now, ensure_ascii=False, sort_keys=True)):
                return number + 1
        raise TimeoutError(f"{self.tries} other writers came first")

    def _take(self, number: int, text: str) -> bool:
        """Writes a manifest beside its place and gives it its name, unless that is taken."""
        self._fs.mkdirs(self._path(self.folder))
        aside, place = f"{self.folder}/.{uuid.uuid4().hex}", f"{self.folder}/{number:010d}.json"
        out = self._fs.create(self._path(aside), True)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self._fs.getScheme() == "file":  # renaming would replace a file here; a second name is refused
                local = [self._path(p).toUri().getPath() for p in (aside, place)]
                os.link(*local)
                return True
            return bool(self._fs.rename(self._path(aside), self._path(place)))
        except FileExistsError:
            return False
        finally:
            self._fs.delete(self._path(aside), False)

    def read(self, versions: dict[str, str] | None = None) -> DataFrame | None:
        """The tables that the latest manifest names, as one with `source`; None without any."""
        versions = self.latest()[1] if versions is None else versions
        parts = [self.spark.read.parquet(path).withColumn("source", F.lit(source)) for source, path in sorted(versions.items())]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None
