"""Quality gates: checks as rows, health funnels, grades, floors and roll-ups. A gate that must stop a run raises."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.numbers import share
from ledgerlake.functions.text import ladder


class GateError(RuntimeError):
    """A gate that a batch must pass did not hold."""


def run_checks(df: DataFrame, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """(check, severity, n) with the number of rows that break each check; one pass over df."""
    one = df.agg(*(F.count_if(rule).alias(name) for name, _, rule in checks))
    rows = F.array(*(F.struct(F.lit(name).alias("check"), F.lit(severity).alias("severity"), F.col(name).alias("n")) for name, severity, _ in checks))
    return one.select(F.explode(rows).alias("c")).select("c.*")


def require(checks: DataFrame, severity: str = "error") -> None:
    """Raises GateError with the broken checks of a severity; what is collected is one row for each check."""
    broken = {r["check"]: r["n"] for r in checks.where((F.col("severity") == severity) & (F.col("n") > 0)).collect()}
    if broken:
        raise GateError(f"broken checks: {broken}")


def coverage(df: DataFrame, by: list[str], flags: dict[str, Column]) -> DataFrame:
    """Rows and the share of rows with each flag, by group."""
    return df.groupBy(*by).agg(F.count("*").alias("rows"), *(share(F.count_if(c), F.count("*")).alias(name) for name, c in flags.items()))


def diagnosis() -> Column:
    """What a source's funnel says; the first rule that holds, in this order."""
    c = F.col
    return ladder([
        ((c("publishable") > 0) & (c("published") == 0), "PUBLISH_PIPELINE_REVIEW"),
        ((c("leadership") >= 10) & (c("candidates") == 0), "CANDIDATE_BUILD_REVIEW"),
        ((c("raw") >= 100) & (c("leadership") == 0), "ROLE_OR_SOURCE_SCOPE_REVIEW"),
        ((c("raw") == 0) & (c("discovered") > 0), "INGESTION_REVIEW"),
        ((c("raw") == 0) & (c("discovered") == 0), "DISCOVERY_REVIEW"),
        ((c("candidates") == 0) & (c("raw") > 0), "NO_CANDIDATES"),
        ((c("published") == 0) & (c("candidates") > 0), "BELOW_PUBLICATION_THRESHOLDS"),
        (c("published") > 0, "PUBLISHED"),
    ], "NO_DATA")


def health_funnel(sources: DataFrame, counts: list[tuple[DataFrame, dict[str, Column]]], on: str) -> DataFrame:
    """sources with one count for each step (0 where a step has no row) and the diagnosis.

    counts: tables with the conditions of the steps counted in them; each table is read and grouped once."""
    one = lambda df, steps: df.groupBy(on).agg(*(F.count_if(c).alias(k) for k, c in steps.items()))
    joined = reduce(lambda a, t: a.join(one(*t), on, "left"), counts, sources)
    return joined.select(on, *(F.coalesce(k, F.lit(0)).alias(k) for _, steps in counts for k in steps)).withColumn("diagnosis", diagnosis())


def health_rollup(status: DataFrame, name: str = "status") -> DataFrame:
    """One row: updated, no_change, stale, failed and health (FAILED if every source is stale or failed, DEGRADED if any is)."""
    s = F.col(name)
    one = status.agg(F.count_if(s == "UPDATED").alias("updated"), F.count_if(s == "NO_CHANGE").alias("no_change"), F.count_if(F.startswith(s, F.lit("STALE_OK"))).alias("stale"), F.count_if(F.startswith(s, F.lit("FAILED"))).alias("failed"), F.count("*").alias("_n"))
    bad = F.col("stale") + F.col("failed")
    return one.withColumn("health", F.when((F.col("_n") > 0) & (bad == F.col("_n")), "FAILED").when(bad > 0, "DEGRADED").otherwise("OK")).drop("_n")


def floors(old: DataFrame, new: DataFrame, by: list[str], measures: dict[str, float]) -> DataFrame:
    """(by, measure, before, after, ok): whether each measure kept its least share of what it was before."""
    both = old.join(new.select(*by, *(F.col(m).alias(f"_{m}") for m in measures)), by, "left")
    rows = F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("before"), F.coalesce(F.col(f"_{m}"), F.lit(0)).cast("double").alias("after"), (F.coalesce(F.col(f"_{m}"), F.lit(0)) >= F.lit(least) * F.col(m)).alias("ok")) for m, least in measures.items()))
    return both.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")
