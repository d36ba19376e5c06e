"""From candidates to published records: raw rows of chosen merchants, gates with corroboration, merged evidence and signals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.numbers import share
from ledgerlake.functions.rules import TIER_ORDER
from ledgerlake.operators.filters import pass_thresholds
from ledgerlake.operators.ranking import best_rows, first_mode, recent_list, top_values


def chosen_rows(rows: DataFrame, selected: DataFrame, name: str, accept: Column) -> DataFrame:
    """Raw rows of the selected names that a row test accepts; selected has one row for each name."""
    return rows.where(accept).join(selected.select(name), name, "left_semi")


def corroborated(records: DataFrame, others: DataFrame, specs: DataFrame, least: int = 4) -> DataFrame:
    """records with how many other sources of their region confirm them.

    records: region, place, family. others: source, region, origin, family, visits, months, score. specs: source and its
    min_ columns. A source confirms a record whose place is its origin if a candidate of the same family passes the
    source's thresholds; it counts once, whatever number of its candidates do."""
    strong = pass_thresholds(others, specs, "source", ["visits", "months", "score"]).select("region", F.col("origin").alias("place"), "family", "source").distinct()
    found = strong.where(F.length("family") >= least).groupBy("region", "place", "family").agg(F.count("*").alias("confirmed"))
    return records.join(found, ["region", "place", "family"], "left").withColumn("confirmed", F.when(F.col("place") != "", F.coalesce("confirmed", F.lit(0))).otherwise(0).cast("long"))


def regional_gate(confirmed: Column, visits: Column, months: Column, score: Column, heads: Column, address: Column, strict: Column) -> Column:
    """A record passes by its own strength, or with less of it if another source confirms it (strict regions only)."""
    normal = (visits >= 3) & (months >= 2) & (score >= 50) & ((F.coalesce(address, F.lit("")) != "") | (strict & (heads >= 3)))
    return normal | (strict & (visits >= 2) & (months >= 2) & (score >= 50) & (heads >= 2) & (confirmed > 0))


def merged_profiles(rows: DataFrame, by: list[str], entity: str, order: list[Column], recent: int = 16, purposes: int = 8) -> DataFrame:
    """Evidence of merged entities from raw rows: sums, roles by visits and spend, the most common purposes, the latest
    events, and which rows it rests on, each as a small table joined by entity.

    rows: by (which holds the entity), role, purpose, amount, people, used_date, row. Purposes go by count, ties by
    text. A group's rows are counted before they are listed; purposes and latest rows are cut before they are collected, all
    roles of a group are (a rule table bounds them)."""
    base = rows.groupBy(*by).agg(F.count("*").alias("visits"), F.sum("amount").alias("spend"), F.sum("people").alias("people"), F.min("used_date").alias("date_min"), F.max("used_date").alias("date_max"), F.count_distinct("row").alias("source_rows"))
    base = base.withColumn("per_head", F.bround(share(F.col("spend"), F.col("people"))).cast("bigint"))
    roles = rows.groupBy(*by, "role").agg(F.count("*").alias("v"), F.sum("amount").alias("s")).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct((-F.col("v")).alias("v"), (-F.col("s")).alias("s"), "role"))).alias("_r"))
    texts = top_values(rows.where("purpose <> ''"), by, "purpose", purposes).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("rank", "purpose", "n"))).alias("_p"))
    latest = recent_list(rows, by, order, recent, ["used_date", "role", "amount"])
    out = base.join(roles, by, "left").join(texts, by, "left").join(latest, by, "left")
    return out.withColumn("roles", F.transform("_r", lambda x: F.struct(x["role"].alias("role"), (-x["v"]).alias("visits"), (-x["s"]).alias("spend")))).withColumn("purposes", F.transform("_p", lambda x: F.struct(x["purpose"].alias("text"), x["n"].alias("count")))).drop("_r", "_p")


def tier_rank(c: Column) -> Column:
    """Place of a tier in the order of rank; 0 for unknown ones."""
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, TIER_ORDER)), c), F.lit(0)) - 1, F.lit(0)).cast("int")


def merged_signals(records: DataFrame, by: list[str], counters: list[str], tiebreak: list[str]) -> DataFrame:
    """The signal with the highest score, the sums of the counters, and the strongest tier of all of a group's signals."""
    best = F.min_by(F.struct("score", *tiebreak), F.struct(-F.col("score"), *tiebreak))
    strongest = F.max_by("tier_name", tier_rank(F.col("tier_name")))
    return records.groupBy(*by).agg(best.alias("_b"), strongest.alias("top_tier"), *(F.sum(c).alias(c) for c in counters)).select(*by, "_b.*", "top_tier", *counters)


def by_origin(records: DataFrame, entity: str) -> DataFrame:
    """(entity, by_origin): visits, spend and records of each origin, in the origins' order."""
    parts = records.groupBy(entity, "origin").agg(F.sum("visits").alias("visits"), F.sum("spend").alias("spend"), F.count("*").alias("records"))
    return parts.groupBy(entity).agg(F.array_sort(F.collect_list(F.struct("origin", "visits", "spend", "records"))).alias("by_origin"))


def enriched_addresses(rows: DataFrame, known: DataFrame, name: str, address: str, first: str) -> DataFrame:
    """rows without an address get the most common one that `known` has for their name; ties by the least `first`."""
    usual = first_mode(known.where((F.length(name) >= 2) & (F.length(address) >= 5)), [name], address, first, "_usual").select(name, "_usual")
    filled = F.coalesce(F.nullif(F.col(address), F.lit("")), F.col("_usual"), F.lit(""))
    return rows.join(usual, name, "left").withColumn("enriched", (F.coalesce(F.col(address), F.lit("")) == "") & F.col("_usual").isNotNull()).withColumn(address, filled).drop("_usual")


def approved_in_order(candidates: DataFrame, approved: DataFrame, key: str, place: str) -> DataFrame:
    """Candidates on the approval list, with the list's place; a name that the list has twice takes its first place."""
    first = approved.groupBy(key).agg(F.min(place).alias(place))
    return candidates.join(first, key)


def review_queue(records: DataFrame, merged: DataFrame, name: str, sources: str, least: int = 2) -> DataFrame:
    """Names in several sources that no merge covers: candidates for a review."""
    wide = records.groupBy(name).agg(F.count_distinct(sources).alias("sources"), F.count("*").alias("records")).where(F.col("sources") >= least)
    return wide.join(merged.select(name).distinct(), name, "left_anti")


def named_best(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """The name of each group: the most frequent, of these the longest, of these the last; with the share of rows that have
    an address and how many names there are."""
    counts = rows.groupBy(*by, name).agg(F.count("*").alias("n"), F.count_if(F.col("address") != "").alias("a"))
    return counts.groupBy(*by).agg(F.max_by(name, F.struct("n", F.length(name), F.col(name))).alias(name), share(F.sum("a"), F.sum("n")).alias("address_coverage"), F.count("*").alias("variants"), F.sum("n").alias("visits"))


def union_of_tops(df: DataFrame, lists: list[tuple[list[Column], int]], key: list[str], best: list[Column]) -> DataFrame:
    """The rows that lead one of several orders, each key once: its best row."""
    parts = [df.orderBy(*order).limit(k) for order, k in lists]
    return best_rows(reduce(DataFrame.unionByName, parts).distinct(), key, best)


def key_sets(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """One row: how many distinct keys both tables have, only the old, only the new, and whether new holds all of old."""
    a, b = old.select(*key).distinct().withColumn("_o", F.lit(1)), new.select(*key).distinct().withColumn("_n", F.lit(1))
    one = a.join(b, key, "full").agg(F.count_if(F.col("_o").isNotNull() & F.col("_n").isNotNull()).alias("both"), F.count_if(F.col("_n").isNull()).alias("lost"), F.count_if(F.col("_o").isNull()).alias("added"))
    return one.withColumn("superset", F.col("lost") == 0).withColumn("equal", (F.col("lost") == 0) & (F.col("added") == 0))


def first_attachments(posts: DataFrame, order: list[str], url: Column) -> DataFrame:
    """Attachments with a canonical address, each address once: at its first place in the order."""
    named = posts.withColumn("canonical", url).where("canonical IS NOT NULL")
    return named.groupBy("canonical").agg(F.min_by(F.struct(*order), F.struct(*order)).alias("_f")).select("canonical", "_f.*")


def upsert_fields(old: DataFrame, changes: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """old with the given fields replaced where changes has the key; keys and all other fields stay. Null changes keep the old value."""
    new = changes.select(*key, *(F.col(f).alias(f"_{f}") for f in fields), F.lit(True).alias("_c"))
    out = old.join(new, key, "left").withColumn("changed", F.coalesce("_c", F.lit(False)))
    for f in fields:
        out = out.withColumn(f, F.coalesce(f"_{f}", f))
    return out.drop("_c", *(f"_{f}" for f in fields))


def integrity(old: DataFrame, new: DataFrame, by: list[str], key: list[str], columns: list[str]) -> DataFrame:
    """For each source: rows before and now, lost, changed and new keys, and PASS or HOLD with the failures.

    History is immutable: a lost or changed row holds the source, and so does a source without rows."""
    content = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    a, b = old.select(*by, *key, content.alias("_a")), new.select(*by, *key, content.alias("_b"))
    n = a.join(b, [*by, *key], "full").groupBy(*by).agg(
        F.count("_a").alias("old_rows"), F.count("_b").alias("current_rows"), F.count_if(F.col("_b").isNull()).alias("lost"),
        F.count_if(F.col("_a") != F.col("_b")).alias("changed"), F.count_if(F.col("_a").isNull()).alias("added"),
    )
    # fixed values: the labels of failures
    failures = F.array_compact(F.array(F.when(F.col("lost") > 0, "historical_rows_removed"), F.when(F.col("changed") > 0, "historical_rows_modified"), F.when(F.col("current_rows") == 0, "missing_ingested_official_rows_or_files")))
    return n.withColumn("failures", F.array_join(F.array_sort(failures), ",")).withColumn("status", F.when(F.size(failures) == 0, "PASS").otherwise("HOLD"))


def incremental_verdict(changed: DataFrame, by: list[str], valid: Column, lost: DataFrame) -> DataFrame:
    """(by, changed, verified, status) of sources: NO_CHANGE, HOLD or PUBLISH_READY.

    Only new and changed rows are verified; `lost` has one row for each source with its number of lost rows."""
    n = changed.groupBy(*by).agg(F.count_if(F.col("is_changed")).alias("changed"), F.count_if(F.col("is_changed") & valid).alias("verified"))
    out = n.join(lost, by, "left").withColumn("lost", F.coalesce("lost", F.lit(0)).cast("long"))
    status = F.when((F.col("changed") == 0) & (F.col("lost") == 0), "NO_CHANGE").when((F.col("lost") > 0) | (F.col("verified") < F.col("changed")), "HOLD").otherwise("PUBLISH_READY")
    return out.withColumn("status", status)

