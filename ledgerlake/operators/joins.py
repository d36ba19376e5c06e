"""Joins with conditions on how many partners there are, fallbacks, prefix routes and distances."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unique_index(df: DataFrame, by: list[str], key: str, where: Column | None = None, sources: str | None = None, least: int = 1) -> DataFrame:
    """(by, key) for groups with exactly one distinct key and at least `least` distinct sources."""
    rows = df if where is None else df.where(where)
    aggs = [F.min(key).alias(key), F.max(key).alias("_top")]
    if sources:
        aggs.append(F.count_distinct(sources).alias("_n"))
    out = rows.where(F.col(key).isNotNull()).groupBy(*by).agg(*aggs).where(F.col(key) == F.col("_top"))
    return (out.where(F.col("_n") >= least).drop("_n") if sources else out).drop("_top")


def with_fallback(df: DataFrame, lookup: DataFrame, levels: list[list[str]], value: str, default: Column) -> DataFrame:
    """df with `value` from the first level of keys that the lookup has; lookup has nulls in the keys a row leaves open."""
    every = sorted({k for level in levels for k in level})
    found = []
    for i, level in enumerate(levels):
        open_ = [k for k in every if k not in level]
        part = lookup.where(reduce(lambda a, b: a & b, (F.col(k).isNull() for k in open_), F.lit(True)))
        df = df.join(part.groupBy(*level).agg(F.min(value).alias(f"_v{i}")), level, "left")
        found.append(F.col(f"_v{i}"))
    return df.withColumn(value, F.coalesce(*found, default)).drop(*(f"_v{i}" for i in range(len(levels))))


def duplicates_elsewhere(df: DataFrame, key: list[str], source: str, flag: str, fields: list[str]) -> DataFrame:
    """Flagged rows with exactly one unflagged row of the same key in another source; that row's fields come as other_<f>.

    The unflagged rows are counted by key and source. With three or more sources there are always two rows elsewhere, and
    without a source of one row never just one, so these keys go first; of the others the first and the last source are
    kept, and the join meets one row for each key. Counting needs no sorted groups, which structs as aggregates would."""
    # a field's smallest value is that of the row where there is one row, and only then it is read
    alone = [F.min(f).alias(f"_f{i}") for i, f in enumerate(fields)]
    by_source = df.where(~F.col(flag)).groupBy(*key, source).agg(F.count("*").alias("_c"), *alone)
    few = by_source.groupBy(*key).agg(F.count("*").alias("_n"), F.count_if(F.col("_c") == 1).alias("_ones")).where("_n <= 2 AND _ones >= 1").select(*key)
    ends = F.struct(source, "_c", F.struct(*(F.col(f if f == source else f"_f{fields.index(f)}").alias(f) for f in dict.fromkeys([source, *fields]))).alias("_f"))
    by_key = by_source.join(few, key, "left_semi").groupBy(*key).agg(F.count("*").alias("_n"), F.min(ends).alias("_lo"), F.max(ends).alias("_hi"))
    asked = df.where(F.col(flag)).join(by_key, key)
    own, lo, hi = F.col(source), F.col("_lo"), F.col("_hi")
    single = F.when((F.col("_n") == 1) & (lo[source] != own), lo).when((F.col("_n") == 2) & (lo[source] == own), hi).when((F.col("_n") == 2) & (hi[source] == own), lo)
    found = asked.withColumn("_o", single).where(F.col("_o._c") == 1)
    return found.select(*df.columns, *(F.col("_o._f")[f].alias(f"other_{f}") for f in dict.fromkeys([source, *fields])))


def longest_prefix(df: DataFrame, routes: DataFrame, text: str, prefix: str = "prefix") -> DataFrame:
    """df left-joined to the route with the longest prefix of its text.

    An equi-join on each length that routes have, so no row meets all routes; routes has one row for each prefix.
    """
    lengths = sorted(r["n"] for r in routes.select(F.length(prefix).alias("n")).distinct().collect())
    keys = F.array(*(F.when(F.length(text) >= n, F.substr(F.col(text), F.lit(1), F.lit(n))) for n in lengths)) if lengths else F.array().cast("array<string>")
    texts = df.select(text).distinct().select(text, F.explode(F.array_compact(keys)).alias(prefix))
    best = texts.join(routes, prefix).groupBy(text).agg(F.max_by(F.struct(prefix, *(c for c in routes.columns if c != prefix)), F.length(prefix)).alias("_r"))
    return df.join(best, text, "left").select(*df.columns, "_r.*")


def close_pairs(points: DataFrame, key: str, x: str, y: str, radius: float, by: Sequence[str] = ()) -> DataFrame:
    """(a, b, distance) of points at most radius apart, a < b: an equi-join on square cells and their neighbours.

    With `by`, only points that agree in these columns (those of one map) are compared; a null agrees with none."""
    cell = lambda c: F.floor(F.col(c) / F.lit(radius)).cast("long")
    maps = [F.col(c).alias(f"m{i}") for i, c in enumerate(by)]
    same = [f"m{i}" for i in range(len(by))]
    p = points.select(*maps, F.col(key).alias("k"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), cell(x).alias("cx"), cell(y).alias("cy")).where("x IS NOT NULL AND y IS NOT NULL")
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    near = p.withColumn("s", F.explode(steps)).select(*same, F.col("k").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"), (F.col("cx") + F.col("s.i")).alias("cx"), (F.col("cy") + F.col("s.j")).alias("cy"))
    d = F.sqrt((F.col("x") - F.col("bx")) * (F.col("x") - F.col("bx")) + (F.col("y") - F.col("by")) * (F.col("y") - F.col("by")))
    return p.join(near, [*same, "cx", "cy"]).where(F.col("k") < F.col("b")).select(F.col("k").alias("a"), "b", d.alias("distance")).where(F.col("distance") <= radius)


def in_boxes(points: DataFrame, boxes: DataFrame, on: list[str], x: str, y: str) -> DataFrame:
    """Points with their group's box that holds them; boxes: on, xmin, xmax, ymin, ymax."""
    return points.join(boxes, on).where(F.col(x).between(F.col("xmin"), F.col("xmax")) & F.col(y).between(F.col("ymin"), F.col("ymax")))


def forward_fill(df: DataFrame, by: list[str], order: list[str], column: str, name: str | None = None) -> DataFrame:
    """df with the last value of column so far in its group in place of nulls, and <name>_inferred."""
    name = name or column
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carried = F.last(column, ignorenulls=True).over(w)
    return df.withColumn(f"{name}_inferred", F.col(column).isNull() & carried.isNotNull()).withColumn(name, carried)
