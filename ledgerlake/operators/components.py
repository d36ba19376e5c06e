"""Connected components by repeated hooking and contraction (display collisions, duplicate groups)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.storage import discard, materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Returns (node, component) for every node of an undirected edge table; component is its smallest node.

    Each round lets every node point to its smallest neighbour, follows the pointers twice and replaces the edges by
    those between what the pointers reach, so the table of edges shrinks geometrically and hubs become one row soon.
    Joins are on a key that is unique on one side; the other, skewed side can be split. Rows with a null end and
    loops name no link: a node with only loops is returned alone, null ends are dropped. An empty table gives no rows.
    """
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    labels = materialize(ends.select(F.col("a").alias("node")).union(ends.select("b")).distinct().withColumn("component", F.col("node")), "cc_labels")
    links = materialize(ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc_links")
    for _ in range(rounds):
        if links.isEmpty():
            return labels
        # the larger end always has a smaller neighbour; roots keep themselves
        up = materialize(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")), "cc_up")

        def climb(df: DataFrame, column: str, up: DataFrame = up) -> DataFrame:
            step = up.select(F.col("node").alias("_n"), F.col("up").alias("_u"))
            return df.join(step, df[column] == step["_n"], "left").withColumn(column, F.coalesce("_u", column)).drop("_n", "_u")

        jump = materialize(climb(climb(up, "up"), "up"), "cc_jump")
        nxt = climb(climb(links, "a", jump), "b", jump).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        nxt, moved = materialize(nxt, "cc_links"), materialize(climb(labels, "component", jump), "cc_labels")
        for old in (links, labels, up, jump):
            discard(old)
        links, labels = nxt, moved
    raise RuntimeError(f"components did not settle in {rounds} rounds")
