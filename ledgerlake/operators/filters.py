"""Reason-coded filters: every row gets the first reason that rejects it, so counts add up to the input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.text import ladder


def with_reason(df: DataFrame, rules: list[tuple[str, Column]], name: str = "reason") -> DataFrame:
    """df with the name of the first rule that holds, null for rows that pass all."""
    return df.withColumn(name, ladder([(rule, reason) for reason, rule in rules]))


def reason_counts(df: DataFrame, name: str = "reason", kept: str = "KEPT") -> DataFrame:
    """(reason, n) over all rows."""
    return df.groupBy(F.coalesce(F.col(name), F.lit(kept)).alias(name)).agg(F.count("*").alias("n"))


def plausible(amount: Column, people: Column, least: int = 1000) -> Column:
    """False where two or more people share less than `least` each; nulls pass."""
    return F.coalesce(~((amount > 0) & (people >= 2) & (amount / people < least)), F.lit(True))


def pass_thresholds(df: DataFrame, specs: DataFrame, on: str, least: list[str]) -> DataFrame:
    """Rows that reach their spec's min_<measure> in every measure; rows without a spec go. specs has one row for each `on`."""
    joined = df.join(specs, on)
    return joined.where(reduce(lambda a, b: a & b, (F.col(m) >= F.col(f"min_{m}") for m in least))).drop(*(f"min_{m}" for m in least))


def matches_words(c: Column, include: list[str], exclude: list[str], exact: list[str] = ()) -> Column:
    """Whether a text has a word of include (or there are none), none of exclude, and is none of exact."""
    any_of = lambda words: reduce(lambda a, b: a | b, (F.contains(c, F.lit(w)) for w in words), F.lit(False))
    return (any_of(include) if include else F.lit(True)) & ~any_of(exclude) & ~c.isin(list(exact))
