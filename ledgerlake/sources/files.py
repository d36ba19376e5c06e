"""Readers: JSON envelopes, packed payloads, probed CSV, status lists, GeoJSON, anchors of pages, registries and snapshots."""

from __future__ import annotations

import base64
import gzip

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sources.ranged import ranged_csv


def json_rows(spark: SparkSession, paths: str | list[str], row: T.StructType, field: str = "rows") -> DataFrame:
    """The rows of JSON documents that hold them in an array, with a fixed schema; files are read in parallel."""
    schema = T.StructType([T.StructField(field, T.ArrayType(row))])
    return spark.read.schema(schema).json(paths, multiLine=True).select(F.explode(field).alias("_r")).select("_r.*")


def _unpack(chunks: pd.Series) -> pd.Series:
    return chunks.map(lambda c: gzip.decompress(base64.b64decode("".join(c).encode())).decode("utf-8"))


def packed_rows(spark: SparkSession, folder: str, row: T.StructType, field: str = "rows") -> DataFrame:
    """Rows of payloads kept as base64 of gzip, cut into files <payload>.<number>; a payload's files go by their number.

    A payload is one compressed document, which cannot be split; payloads are unpacked in parallel."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    parts = spark.read.text(folder, wholetext=True).select(F.trim("value").alias("chunk"), F.regexp_extract(name, r"^(.*?)\.?(\d+)", 1).alias("payload"), F.regexp_extract(name, r"(\d+)", 1).cast("int").alias("n"))
    whole = parts.groupBy("payload").agg(F.array_sort(F.collect_list(F.struct("n", "chunk")))["chunk"].alias("chunks"))
    text = F.pandas_udf(_unpack, T.StringType())(F.col("chunks"))
    return whole.select(F.explode(F.from_json(text, T.StructType([T.StructField(field, T.ArrayType(row))]))[field]).alias("_r")).select("_r.*")


def probed_csv(spark: SparkSession, paths: str | list[str], required: list[str], encodings: tuple[str, ...] = ("utf-8-sig", "cp949")) -> DataFrame:
    """The required columns of CSV files, each file in the first encoding that all its bytes fit; several files are one
    table. Raises ValueError if a file fits none, or lacks a required column. Files are read by ranges: see ranged_csv()."""
    return ranged_csv(spark, paths, required, encodings)


def status_list(spark: SparkSession, path: str) -> DataFrame:
    """(source, status) of a tab-separated list; raises on malformed lines and on sources that come twice."""
    df = spark.read.text(path).where(F.trim("value") != "").select(F.split("value", "\t").alias("p")).select(F.size("p").alias("n"), F.get("p", F.lit(0)).alias("source"), F.get("p", F.lit(1)).alias("status"))
    if not df.where("n <> 2 OR source = '' OR status = ''").isEmpty():
        raise ValueError("malformed line in the status list")
    if not df.groupBy("source").count().where("count > 1").isEmpty():
        raise ValueError("a source comes twice in the status list")
    return df.select("source", "status")


def geojson_points(texts: DataFrame, column: str, properties: T.StructType) -> DataFrame:
    """(lat, lon, properties) of the points of feature collections that stand as JSON somewhere in a text."""
    feature = T.StructType([T.StructField("geometry", T.StructType([T.StructField("coordinates", T.ArrayType(T.DoubleType()))])), T.StructField("properties", properties)])
    json = F.regexp_extract(column, r'(?s)(\{\s*"type"\s*:\s*"FeatureCollection".*\})', 1)
    f = texts.select(F.explode(F.from_json(json, T.StructType([T.StructField("features", T.ArrayType(feature))]))["features"]).alias("f"))
    return f.select(F.get("f.geometry.coordinates", F.lit(1)).alias("lat"), F.get("f.geometry.coordinates", F.lit(0)).alias("lon"), "f.properties.*")


def anchors(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, n, href, label) of the anchors of pages, in their order."""
    found = F.regexp_extract_all(html, F.lit(r'(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"[^>]*>(?:.*?)</a>'), F.lit(0))
    a = pages.select(key, F.posexplode(found).alias("n", "a"))
    return a.select(key, "n", F.regexp_extract("a", r'(?i)href\s*=\s*"([^"]*)"', 1).alias("href"), F.trim(F.regexp_replace("a", r"(?s)<[^>]*>", "")).alias("label"))


def registry(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    """A small JSON-lines table of rules with one row for each key; raises if a key comes twice."""
    df = spark.read.schema(schema).json(path)
    if not df.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError(f"a {key} comes twice in {path}")
    return df
