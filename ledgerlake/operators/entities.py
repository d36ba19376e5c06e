"""Entity resolution: a cascade of unique matches gives each record the key of one physical place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.text import compact
from ledgerlake.operators.joins import unique_index


def resolve_entities(records: DataFrame, bridges: DataFrame | None = None) -> DataFrame:
    """records with entity_key and basis.

    records: name, origin, family, strict, building (address key, '' if none), place (locality, '' if none),
    institutions (a number). In order: own address; the one address of (family, place); without a place: the one address of
    a family of four or more signs that two or more origins give; the one address of a strict name that ends like a
    branch; a bridge from strict name to an address known here; the one address of a strict name of six or more signs
    with two or more institutions. Else the family with its place, or the record alone.
    Each index has one row for a key, so the joins do not multiply rows.
    """
    own = F.when((F.col("family") != "") & (F.col("building") != ""), F.concat_ws("||", "family", "building"))
    r = records.withColumn("own", own)
    with_key = r.where("own IS NOT NULL")
    by_place = unique_index(with_key, ["family", "place"], "own", F.col("place") != "").withColumnRenamed("own", "_place")
    by_origins = unique_index(with_key, ["family"], "own", (F.col("origin") != "") & (F.length("family") >= 4), "origin", 2).withColumnRenamed("own", "_origins")
    by_name = unique_index(with_key, ["strict"], "own", F.col("strict") != "").withColumnRenamed("own", "_name")
    out = r.join(by_place, ["family", "place"], "left").join(by_origins, "family", "left").join(by_name, "strict", "left")
    if bridges is not None:
        known = with_key.select("strict", "building", "own").distinct().join(bridges.select("strict", F.col("building").alias("bridge")).distinct(), "strict").where("building = bridge")
        out = out.join(unique_index(known, ["strict"], "own").withColumnRenamed("own", "_bridge"), "strict", "left")
    else:
        out = out.withColumn("_bridge", F.lit(None).cast("string"))
    nowhere = F.col("place") == ""
    rules = [
        ("address", F.col("own").isNotNull(), F.col("own")),
        ("place", (F.col("family") != "") & ~nowhere & F.col("_place").isNotNull(), F.col("_place")),
        ("origins", nowhere & F.col("_origins").isNotNull(), F.col("_origins")),
        ("branch", nowhere & F.col("_name").isNotNull() & F.col("strict").rlike("(?:점|지점|호점)$"), F.col("_name")),
        ("bridge", nowhere & F.col("_bridge").isNotNull(), F.col("_bridge")),
        ("name", nowhere & F.col("_name").isNotNull() & (F.length("strict") >= 6) & (F.col("institutions") >= 2), F.col("_name")),
        ("family_place", (F.col("family") != "") & ~nowhere & (F.length("family") >= 4), F.concat("family", F.lit("||locality:"), "place")),
    ]
    key, basis = F.concat_ws("||", F.lit("single"), compact("name"), compact("origin")), F.lit("single")
    for name, rule, value in reversed(rules):
        key, basis = F.when(rule, value).otherwise(key), F.when(rule, name).otherwise(basis)
    return out.withColumn("entity_key", key).withColumn("basis", basis).drop("own", "_place", "_origins", "_name", "_bridge")


def entity_id(key: str = "entity_key") -> F.Column:
    return F.substr(F.sha1(F.col(key).cast("binary")), F.lit(1), F.lit(16))
