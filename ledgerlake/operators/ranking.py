"""Ranking, top-k, modes and choices among the rows of a group. Every order is total: ties end in the given keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.storage import materialize

Keys = Sequence[str]


def ranked(df: DataFrame, order: Sequence[Column], by: Keys = (), name: str = "rank") -> DataFrame:
    """Numbers the rows of each group, or of a whole small result, from 1.

    Without a group all rows meet in one task: meant for results already cut by top_k(); for any size use global_rank()."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def top_k(df: DataFrame, order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """The first k rows of a total order, numbered; each task keeps k rows, and only these meet."""
    return ranked(df.orderBy(*order).limit(k), order, name=name)


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Numbers all rows of a table from 1 in a total order without bringing them into one task.

    Rows are range-partitioned and written in order; each partition numbers its own rows and adds the sizes of those
    before it (one row for each partition). An empty table gives no rows.
    """
    cuts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    dealt = materialize(cuts, "rank")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return dealt.withColumn("_own", own).join(F.broadcast(sizes), "_part").withColumn(name, (F.col("_own") + F.col("_before")).cast("long")).drop("_part", "_own", "_before")


def best_rows(df: DataFrame, by: Keys, order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first k rows of each group; Spark cuts each partition's groups to k rows before the shuffle."""
    return ranked(df, order, by, "_k").where(F.col("_k") <= k).drop("_k")


def recent_list(df: DataFrame, by: Keys, order: Sequence[Column], k: int, fields: Keys, name: str = "recent") -> DataFrame:
    """(by, name): the first k rows of each group as an ordered array of structs."""
    cut = ranked(df, order, by, "_k").where(F.col("_k") <= k)
    return cut.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_k", *fields))).alias("_l")).select(*by, F.transform("_l", lambda s: F.struct(*(s[f].alias(f) for f in fields))).alias(name))


def first_mode(df: DataFrame, by: Keys, value: str, first: str, name: str = "mode") -> DataFrame:
    """(by, name, n): the most frequent value of each group; of equally frequent ones that whose smallest `first` is least."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"), F.min(first).alias("_at"))
    best = counts.groupBy(*by).agg(F.min_by(F.struct(F.col(value).alias("v"), "n"), F.struct(-F.col("n"), "_at", F.col(value))).alias("_b"))
    return best.select(*by, F.col("_b.v").alias(name), F.col("_b.n").alias("n"))


def top_values(df: DataFrame, by: Keys, value: str, k: int) -> DataFrame:
    """(by, value, n, rank): the k most frequent values of each group, ties by value."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("n"))
    return ranked(counts, [F.desc("n"), F.col(value)], by).where(F.col("rank") <= k)


def quota(df: DataFrame, group: str, order: Sequence[Column], each: int, window: int, most: int, key: Keys = (), incumbents: DataFrame | None = None) -> DataFrame:
    """The rows of a ranked list with `each` places reserved to each group, filled up to `window` in order, then to `most`.

    Incumbents (a table of `key`, with `turn` as its order) take the reserved places of their group first. A row belongs
    to one group, so reservations of one group do not touch another's. Returns df with `reserved` and `place`.
    """
    if incumbents is not None:
        df = df.join(incumbents.groupBy(*key).agg(F.min("turn").alias("_turn")), list(key), "left")
    else:
        df = df.withColumn("_turn", F.lit(None).cast("long"))
    df = ranked(df, [F.col("_turn").asc_nulls_last(), *order], [group], "_g").withColumn("reserved", F.col("_g") <= each).drop("_g", "_turn")
    first = top_k(df, [F.desc("reserved"), *order], window, "_w")
    rest = df.join(first.select(*key), list(key), "left_anti") if most > window else None
    listed = first.drop("_w").withColumn("_front", F.lit(0))
    if rest is not None:
        listed = listed.unionByName(rest.orderBy(*order).limit(most - window).withColumn("_front", F.lit(1)))
    return ranked(listed, [F.col("_front"), *order], name="place").drop("_front")
