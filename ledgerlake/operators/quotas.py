"""Places reserved to groups whose rows belong to several of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.ranking import ranked, top_k
from ledgerlake.storage import discard, materialize


def shared_reservations(offers: DataFrame, group: str, key: Sequence[str], prefer: Sequence[Column], each: int) -> DataFrame:
    """(key, group): the rows that each group reserves, at most `each`, no row twice.

    Groups choose in ascending order, each its first rows by `prefer` (then key) that no group before it has. Instead of one
    group after the other, all propose at once: every group proposes to its first rows, a row holds the first group that
    proposes, and offers of a row to groups after that one are struck out. A group never withdraws, so what is struck out
    stays so, and when no proposal is refused the rows held are those of the sequential choice. Each round writes the
    offers that are left; Spark cuts a group to its first rows before they are shuffled.
    """
    left = materialize(offers.select(group, *key, F.struct(*prefer).alias("_p")).groupBy(group, *key).agg(F.min("_p").alias("_p")), "offers")
    first = Window.partitionBy(group).orderBy("_p", *key)
    while True:
        asked = left.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= each)
        held = materialize(asked.groupBy(*key).agg(F.min(group).alias("_held"), F.count("*").alias("_asked")), "held")
        if held.where("_asked > 1").isEmpty():
            discard(left)
            return held.select(*key, F.col("_held").alias(group))
        fewer = materialize(left.join(held, list(key), "left").where(F.col("_held").isNull() | (F.col(group) <= F.col("_held"))).select(*left.columns), "offers")
        discard(left), discard(held)
        left = fewer


def fair_share(window: int, groups: int, least: int) -> int:
    """Places of each group: an even share of the window, one at least, `least` at most."""
    return min(least, max(1, window // max(1, groups)))


def shared_quota(rows: DataFrame, members: DataFrame, group: str, key: Sequence[str], order: Sequence[Column], window: int = 180, least: int = 10, most: int = 250, incumbents: DataFrame | None = None) -> DataFrame:
    """The first `most` rows of a ranked list of which each group has reserved places, as rows with reserved and place.

    members has (key, group) for every group of a row; incumbents has (key, group, turn) of an earlier list and takes a
    group's places first, by turn, where the row is still in the list. The window is filled up by `order`, in which its rows
    are listed; then come others up to `most`. Ties of the order go by key. rows has one row for each key.
    """
    key = list(key)
    place = F.struct(*order, *key)
    groups = members.where(F.col(group).isNotNull()).select(*key, group).join(rows.select(*key), key, "left_semi")
    each = fair_share(window, groups.select(group).distinct().count(), least)
    at = rows.select(*key, place.alias("_order"))
    offers = groups.join(at, key).select(group, *key, F.lit(1).alias("_new"), F.lit(None).cast("long").alias("_turn"), "_order")
    if incumbents is not None:
        known = groups.select(group).distinct()
        kept = incumbents.select(*key, group, F.col("turn").cast("long").alias("_turn")).join(known, group, "left_semi").join(at, key)
        offers = offers.unionByName(kept.select(group, *key, F.lit(0).alias("_new"), "_turn", "_order"))
    held = shared_reservations(offers, group, key, [F.col("_new"), F.col("_turn"), F.col("_order")], each)
    marked = rows.join(held.select(*key, F.lit(True).alias("reserved")), key, "left").withColumn("reserved", F.coalesce("reserved", F.lit(False)))
    ties = [*order, *(F.col(k) for k in key)]
    reserved = marked.where("reserved")
    count = reserved.count()
    filled = marked.where(~F.col("reserved")).orderBy(*ties).limit(max(0, window - count))
    front = materialize(reserved.unionByName(filled), "quota_front")
    behind = marked.join(front.select(*key), key, "left_anti").orderBy(*ties).limit(max(0, most - max(window, count)))
    listed = front.withColumn("_front", F.lit(0)).unionByName(behind.withColumn("_front", F.lit(1)))
    return ranked(top_k(listed, [F.col("_front"), *ties], most, "_k").drop("_k"), [F.col("_front"), *ties], name="place").drop("_front")
