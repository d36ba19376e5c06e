"""Routes of addresses to the office of their locality; an ambiguous locality is never guessed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.joins import longest_prefix
from ledgerlake.storage import materialize

# A registry entry of a whole province ends in this word, a locality that may stand alone in one of these.
MAIN_OFFICE = "본청"
LOCALITY_ENDS = ["구", "군"]


def localities(registry: DataFrame, provinces: DataFrame) -> DataFrame:
    """(label, locality, name, code): the registry's entries of localities, split behind the label of their province.

    registry has name and code, a name being a label and a locality in one word; provinces has label (and alias)."""
    labels = provinces.select("label").distinct()
    named = longest_prefix(registry.select("name", "code").where(~F.endswith("name", F.lit(MAIN_OFFICE))), labels, "name", "label")
    return named.where("label IS NOT NULL").select("label", F.substr("name", F.length("label") + 1).alias("locality"), "name", "code").where("locality <> ''")


def unique_localities(entries: DataFrame) -> DataFrame:
    """An inverted index from a locality's word to its entry, for those words that have one owner in the whole registry."""
    ends = F.lit(False)
    for end in LOCALITY_ENDS:
        ends = ends | F.endswith("locality", F.lit(end))
    return entries.where(ends).groupBy("locality").agg(F.count("*").alias("_n"), F.first("name").alias("name"), F.first("code").alias("code")).where("_n = 1").select("locality", "name", "code")


def route_addresses(df: DataFrame, address: str, registry: DataFrame, provinces: DataFrame, whole: list[str] | None = None) -> DataFrame:
    """df with route_name, route_code and route_reason, by the words that an address begins with, blanks left out.

    An address that begins with an alias of a province (the longest one) goes to the longest locality of that province that
    follows, and nowhere if none does. Provinces in `whole` have one office, their MAIN_OFFICE entry, for all that follows.
    Only an address without a province is looked up among localities that one province owns. Nothing is read from further
    inside an address. Reasons: PROVINCE, WHOLE_PROVINCE, UNIQUE_LOCALITY; MISSING_ADDRESS and UNROUTABLE_JURISDICTION for
    addresses without a route. Texts are routed once each, by equi-joins on the prefixes' lengths."""
    entries = localities(registry, provinces)
    text = F.regexp_replace(F.coalesce(F.col(address), F.lit("")), r"(?U)\s+", "")
    texts = materialize(df.select(text.alias("_text")).distinct(), "route_texts")
    known = longest_prefix(texts, provinces.select(F.col("alias").alias("prefix"), "label"), "_text").withColumn("_rest", F.substr("_text", F.length("prefix") + 1))
    known = materialize(known, "route_known")
    whole = whole or []
    offices = registry.where(F.endswith("name", F.lit(MAIN_OFFICE))).select("name", "code", F.trim(F.regexp_replace("name", f"{MAIN_OFFICE}$", "")).alias("label")).where(F.col("label").isin(whole))
    of_whole = known.where(F.col("label").isin(whole) & (F.col("_rest") != "")).join(offices, "label").select("_text", "name", "code", F.lit("WHOLE_PROVINCE").alias("reason"))
    # a province's localities behind its label, so that one look-up serves all provinces
    routes = entries.where(~F.col("label").isin(whole)).groupBy(F.concat_ws("|", "label", "locality").alias("prefix")).agg(F.min_by(F.struct("name", "code"), "name").alias("o")).select("prefix", F.col("o.name").alias("name"), F.col("o.code").alias("code"))
    inside = known.where(F.col("label").isNotNull() & ~F.col("label").isin(whole)).select("_text", F.concat_ws("|", "label", "_rest").alias("_rest"))
    in_province = longest_prefix(inside, routes, "_rest").where("name IS NOT NULL").select("_text", "name", "code", F.lit("PROVINCE").alias("reason"))
    alone = unique_localities(entries).select(F.col("locality").alias("prefix"), "name", "code")
    single = longest_prefix(known.where("label IS NULL").select("_text"), alone, "_text").where("name IS NOT NULL AND length(_text) > length(prefix)").select("_text", "name", "code", F.lit("UNIQUE_LOCALITY").alias("reason"))
    found = of_whole.unionByName(in_province).unionByName(single).select(F.col("_text").alias("_t"), F.col("name").alias("route_name"), F.col("code").alias("route_code"), F.col("reason").alias("route_reason"))
    reason = F.coalesce("route_reason", F.when(text == "", F.lit("MISSING_ADDRESS")).otherwise(F.lit("UNROUTABLE_JURISDICTION")))
    return df.join(found, text == F.col("_t"), "left").select(*(df[c] for c in df.columns), "route_name", "route_code", reason.alias("route_reason"))
