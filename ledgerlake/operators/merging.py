"""Merging tables by key: first wins, last wins, conflicts, snapshot differences, carry-forward."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _kept(df: DataFrame, key: list[str], value: Column, last: bool) -> DataFrame:
    pick = F.max_by if last else F.min_by
    return df.groupBy(*key).agg(pick(F.struct(*df.columns), value).alias("_r")).select("_r.*")


def first_wins(tables: list[DataFrame], key: list[str], order: list[str]) -> DataFrame:
    """Union of tables by name; of rows with the same key that of the earliest table stays, and there the first by order.

    Null keys are keys like others. Aggregates before the shuffle, so a key with very many rows is no hot task."""
    parts = [t.withColumn("_t", F.lit(i)) for i, t in enumerate(tables)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p, allowMissingColumns=True)
    return _kept(union, key, F.struct("_t", *order), False).drop("_t")


def last_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row by order of each key."""
    return _kept(df, key, F.struct(*order), True)


def content_hash(columns: list[str]) -> Column:
    """A hash of the columns' values that equal rows share."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def snapshot_diff(old: DataFrame, new: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """(key, change) with change lost, added or changed for keys whose rows differ; keys are unique in both."""
    a = old.select(*key, content_hash(columns).alias("_a"))
    b = new.select(*key, content_hash(columns).alias("_b"))
    change = F.when(F.col("_b").isNull(), "lost").when(F.col("_a").isNull(), "added").when(F.col("_a") != F.col("_b"), "changed")
    return a.join(b, key, "full").withColumn("change", change).where("change IS NOT NULL").drop("_a", "_b")


def merge_conflicts(old: DataFrame, new: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Keys that both tables have with different content."""
    return snapshot_diff(old, new, key, columns).where("change = 'changed'").drop("change")


def merge_new(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """old and the rows of new whose key it lacks."""
    return old.unionByName(new.join(old.select(*key), key, "left_anti").select(*old.columns))


def carry_forward(current: DataFrame, last_good: DataFrame, key: list[str]) -> DataFrame:
    """current, and rows of the last good table whose key it lacks, with `carried`."""
    return current.withColumn("carried", F.lit(False)).unionByName(last_good.join(current.select(*key), key, "left_anti").select(*current.columns).withColumn("carried", F.lit(True)))


def replace_partitions(old: DataFrame, new: DataFrame, part: str, floor: float) -> DataFrame:
    """old with each part replaced by new's where new has at least `floor` of its rows; other parts stay as they were.

    Returns the rows with `refreshed`; parts only new has are taken."""
    n_old = old.groupBy(part).agg(F.count("*").alias("_o"))
    n_new = new.groupBy(part).agg(F.count("*").alias("_n"))
    take = n_new.join(n_old, part, "left").where(F.col("_o").isNull() | (F.col("_n") >= floor * F.col("_o"))).select(part)
    return new.join(take, part, "left_semi").withColumn("refreshed", F.lit(True)).unionByName(old.join(take, part, "left_anti").withColumn("refreshed", F.lit(False)))


def moved_keys(old: DataFrame, new: DataFrame, entity: str, keys: str) -> DataFrame:
    """(key, old entity, new entity) of keys that lie in another entity than before; `keys` is an array column."""
    a, b = (df.select(entity, F.explode(keys).alias("key")) for df in (old, new))
    return moved_rows(a, b, entity, "key").distinct()


def moved_rows(old: DataFrame, new: DataFrame, entity: str, key: str) -> DataFrame:
    """moved_keys() of tables with one row for each key."""
    a, b = old.select(F.col(key).alias("key"), F.col(entity).alias("old_entity")), new.select(F.col(key).alias("key"), F.col(entity).alias("new_entity"))
    return a.join(b, "key").where("old_entity <> new_entity")
