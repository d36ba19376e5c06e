"""Incremental arrivals: insert-only merges by key, late data, last-good snapshots and skipping of unchanged inputs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.operators.merging import first_wins


def within_lookback(df: DataFrame, ts: str, lookback: str, name: str) -> DataFrame:
    """df with a flag for rows at most `lookback` older than its latest; the latest time is one broadcast row."""
    latest = df.agg(F.max(ts).alias("_latest"))
    return df.join(F.broadcast(latest)).withColumn(name, F.col(ts) >= F.col("_latest") - F.expr(f"INTERVAL {lookback}")).drop("_latest")


def late_counts(stream: DataFrame, ts: str, lookback: str, window: str, by: list[str]) -> DataFrame:
    """Counts of rows by event-time window and key; rows later than `lookback` no longer change them."""
    return stream.withWatermark(ts, lookback).groupBy(F.window(ts, window), *by).agg(F.count("*").alias("n"))


def distinct_arrivals(stream: DataFrame, key: str, ts: str, lookback: str) -> DataFrame:
    """Each key once among rows that are at most `lookback` late."""
    return stream.withWatermark(ts, lookback).dropDuplicatesWithinWatermark([key])


def merge_arrivals(stream: DataFrame, path: str, checkpoint: str, key: list[str], order: list[str]) -> StreamingQuery:
    """Adds each micro-batch's rows with new keys to the table under `path`; known rows stay and are not written again.

    A batch writes the part d=<batch>; a batch that comes again overwrites its own, so a restart changes nothing. A batch
    without new keys writes no rows.
    """
    def add(batch: DataFrame, number: int) -> None:
        known = latest_snapshot(batch.sparkSession, path, before=number)
        fresh = first_wins([batch], key, order)
        fresh = fresh if known is None else fresh.join(known.select(*key), key, "left_anti").select(*batch.columns)
        fresh.write.mode("overwrite").parquet(f"{path}/d={number}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def retry_list(old: DataFrame, failed: DataFrame, done: DataFrame, url: str, order: list[str], keep: int = 100) -> DataFrame:
    """Addresses to try again: those that failed before or now and were not read since, each once, the `keep` latest by order."""
    both = old.unionByName(failed).join(done.select(url).distinct(), url, "left_anti")
    last = both.groupBy(url).agg(F.max(F.struct(*order)).alias("_o")).select(url, "_o.*")
    return last.orderBy(*(F.desc(c) for c in order), url).limit(keep)


def has_news(batch: DataFrame, known: DataFrame, key: list[str]) -> bool:
    """Whether a batch has a key that the table lacks; without one nothing is written or computed again."""
    return not batch.select(*key).join(known.select(*key), key, "left_anti").isEmpty()


def _versions(spark: SparkSession, path: str, kind: str = "v") -> list[int]:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath() for s in fs.listStatus(root)]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(p.getName()[2:]) for p in names if p.getName().startswith(f"{kind}=") and fs.exists(done(p, "_SUCCESS")))


def latest_snapshot(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest complete snapshot under path, with the parts that merges added; only those before a number, if one is given.

    None without either."""
    earlier = lambda kind: [f"{path}/{kind}={v}" for v in _versions(spark, path, kind) if before is None or v < before]
    found = [*earlier("v")[-1:], *earlier("d")]
    return spark.read.parquet(*found) if found else None


def publish_snapshot(df: DataFrame, path: str, passed: bool) -> bool:
    """Writes df as the next snapshot if its gate passed; else the last good one stays the newest."""
    if passed:
        versions = _versions(df.sparkSession, path)
        df.write.parquet(f"{path}/v={versions[-1] + 1 if versions else 0}")
    return passed


def input_fingerprint(df: DataFrame) -> str:
    """A hash of a table's rows that their order does not change; equal tables need no new run."""
    row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("a"), F.bit_xor(F.xxhash64(F.lit(1), *df.columns)).alias("b")).first()
    return uuid.uuid5(uuid.NAMESPACE_OID, f"{row['n']}|{row['a']}|{row['b']}").hex


def stale_cache_rows(wanted: DataFrame, cache: DataFrame, key: str, versions: list[str]) -> DataFrame:
    """Rows of wanted whose key the cache lacks in just these versions; only they are computed again."""
    return wanted.join(cache.select(key, *versions), [key, *versions], "left_anti")
