"""Aggregates of transactions to candidates and of candidates to entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def candidates(tx: DataFrame, by: list[str], **more: Column) -> DataFrame:
    """visits, roles, institutions, months, spend, people, evening and further aggregates of each group.

    Distinct counts are taken over small sets collected before the shuffle (roles, institutions and months are few)."""
    few = lambda c: F.size(F.collect_set(c)).cast("long")
    return tx.groupBy(*by).agg(
        F.count("*").alias("visits"), few("role").alias("roles"), few("institution").alias("institutions"), few(F.substring("used_date", 1, 7)).alias("months"),
        F.coalesce(F.sum("amount"), F.lit(0)).alias("spend"), F.coalesce(F.sum("people"), F.lit(0)).alias("people"), F.count_if("evening").alias("evening"),
        *(c.alias(k) for k, c in more.items()),
    )


def tier_counts(tx: DataFrame, by: list[str], tier: str, tiers: list) -> DataFrame:
    """One count column for each tier."""
    return tx.groupBy(*by).agg(*(F.count_if(F.col(tier) == t).alias(f"tier_{t}") for t in tiers))


def two_level(tx: DataFrame, by: list[str], part: str, k: int) -> DataFrame:
    """Per group its total and its k largest parts by visits, then spend, then name, as an array of structs."""
    parts = tx.groupBy(*by, part).agg(F.count("*").alias("visits"), F.sum("amount").alias("spend"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("visits"), F.desc("spend"), part))
    cut = F.when(F.col("_k") <= k, F.struct("_k", F.col(part).alias("part"), "visits", "spend"))  # the aggregate collects k structs of a group, nulls not
    out = parts.withColumn("_k", place).groupBy(*by).agg(F.sum("visits").alias("visits"), F.sum("spend").alias("spend"), F.count("*").alias("parts"), F.array_sort(F.collect_list(cut)).alias("_l"))
    return out.withColumn("top", F.transform("_l", lambda s: F.struct(s["part"].alias("part"), s["visits"].alias("visits"), s["spend"].alias("spend")))).drop("_l")


def merged_evidence(records: DataFrame, by: list[str]) -> DataFrame:
    """Evidence of merged records: sums, the largest months (no union), first and last date, sorted distinct sources."""
    return records.groupBy(*by).agg(
        F.sum("visits").alias("visits"), F.sum("spend").alias("spend"), F.max("months").alias("months"), F.min("date_min").alias("date_min"), F.max("date_max").alias("date_max"),
        F.array_sort(F.collect_set("origin")).alias("origins"), F.count("*").alias("records"),
    )


def merged_signal(records: DataFrame, by: list[str], counters: list[str], tiebreak: list[str]) -> DataFrame:
    """The row with the highest score of each group (ties by tiebreak), with the group's sums of the counters."""
    rest = [c for c in records.columns if c not in by and c not in counters]
    best = F.min_by(F.struct(*rest), F.struct(-F.col("score"), *tiebreak))
    return records.groupBy(*by).agg(best.alias("_b"), *(F.sum(c).alias(c) for c in counters)).select(*by, "_b.*", *counters)


def memberships(df: DataFrame, entity: str, values: Column) -> DataFrame:
    """(group, entities): in how many distinct entities each value occurs; an entity counts once in each of its groups."""
    return df.select(entity, F.explode(values).alias("group")).distinct().groupBy("group").agg(F.count("*").alias("entities"))
