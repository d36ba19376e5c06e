"""Writers: JSON lines, partitions replaced in place, upserts, Markdown tables and script data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.text import html_safe
from ledgerlake.operators.merging import first_wins


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replaces just the partitions that df has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def upsert(df: DataFrame, old: DataFrame | None, path: str, key: list[str], order: list[str]) -> None:
    """Writes old with df's rows in place of those of the same key to a new path."""
    (first_wins([df, old], key, order) if old is not None else df).write.parquet(path)


def markdown_table(df: DataFrame, columns: list[str], k: int) -> str:
    """The first k rows of an ordered DataFrame as a Markdown table; bars in cells become slashes."""
    rows = df.select(*columns).limit(k).collect()
    cell = lambda v: "" if v is None else str(v).replace("|", "/").replace("\n", " ")
    lines = [columns, ["---"] * len(columns), *([cell(v) for v in r] for r in rows)]
    return "\n".join("| " + " | ".join(line) + " |" for line in lines) + "\n"


def script_rows(df: DataFrame) -> DataFrame:
    """Each row as JSON that can stand inside a script element."""
    return df.select(html_safe(F.to_json(F.struct("*"))).alias("json"))
