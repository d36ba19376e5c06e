"""Sheets to transactions: where a sheet's table ends, and which of its lines are none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.numbers import amount_of, date_of, head_count, without_time
from ledgerlake.functions.rules import packed_name, plausible_name
from ledgerlake.functions.text import rejoined, text
from ledgerlake.operators.grids import column_positions, find_headers

# Notices of sheets without transactions, ways of paying that stand in a merchant's place, words of totals,
# and the number of blank lines in a row that end a table.
NO_DATA = ["사용내역없음", "해당없음", "내역없음"]
PAYMENT_METHODS = ["신용카드", "카드", "현금", "계좌이체"]
TOTAL_DATES = ["합계", "총계", "누계", "계"]
TOTAL_WORDS = ["합계", "총계", "누계"]
BLANKS = 8


def _without_blanks(c: Column) -> Column:
    return F.replace(F.coalesce(c, F.lit("")), F.lit(" "), F.lit(""))


def _says(c: Column, words: list[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.contains(c, F.lit(word))
    return found


def blank_ends(lines: DataFrame, by: list[str], blanks: int = BLANKS) -> DataFrame:
    """(by, end): the lines at which a run of blank lines reaches its `blanks`-th; lines has by, idx, blank.

    Runs are islands: among a sheet's blank lines, idx less their number stays the same as long as they follow each other."""
    number = F.row_number().over(Window.partitionBy(*by).orderBy("idx"))
    runs = lines.where("blank").withColumn("_run", F.col("idx") - number).groupBy(*by, "_run").agg(F.min("idx").alias("_from"), F.count("*").alias("_n"))
    return runs.where(F.col("_n") >= blanks).select(*by, (F.col("_from") + blanks - 1).alias("end"))


def transactions_of(grid: DataFrame, by: list[str], aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """The transactions of sheets: by, idx, used_date, date_inferred, merchant, address, purpose, people, amount, role, method.

    A sheet's table starts behind its header and ends at the eighth blank line in a row, once a transaction came before it.
    Lines are none that carry a notice instead of a date, a merchant that is no name or a way of paying, neither a merchant
    nor an amount, neither a merchant nor a date, or a total. A line without a date has that of the line before it that has
    a full one, if it has a merchant. Sheets without a header give no rows; grid has one row for each line of a sheet.
    """
    headers = find_headers(grid, by, aliases).select(*by, F.col("idx").alias("_h"), "span", column_positions(F.col("header"), aliases).alias("_m"))
    lines = grid.join(headers.hint("shuffle_hash"), by).where(F.col("idx") >= F.col("_h") + F.col("span")).withColumn("_texts", F.transform("cells", text))
    # what several rules read is a column of an earlier step, computed once for a line
    of = lambda cells, f: F.get(cells, F.try_element_at("_m", F.lit(f)))
    cell = lambda f: F.coalesce(of("_texts", f), F.lit(""))
    read = lines.select(
        *by, "idx", (~F.exists("_texts", lambda c: c != "")).alias("blank"), cell("date").alias("_raw_date"), without_time(of("cells", "date")).alias("_day"), cell("merchant").alias("merchant"), amount_of(cell("amount")).alias("amount"),
        cell("address").alias("address"), cell("purpose").alias("purpose"), head_count(F.concat(of("cells", "people"), F.lit("명"))).alias("people"), cell("role").alias("role"), cell("method").alias("method"),
        F.concat_ws(" ", F.slice("_texts", 1, 8)).alias("_line"), rejoined(cell("merchant")).alias("_name"), _without_blanks(cell("date")).alias("_said"),
    )
    read = read.withColumns({"_date": F.coalesce(F.date_format(date_of(F.col("_day")), "yyyy-MM-dd"), F.col("_raw_date")), "_packed": packed_name(F.col("_name")), "_totals": _says(F.col("_line"), TOTAL_WORDS)})
    named = F.col("merchant") != ""
    no_name = named & (~plausible_name(F.col("_name"), F.col("_packed")) | _without_blanks(F.col("merchant")).isin(PAYMENT_METHODS))
    open_ = read.withColumn("_live", ~F.col("blank") & ~_says(F.col("_said"), NO_DATA) & ~no_name).drop("_day", "_raw_date", "_line", "_name", "_packed", "_said")
    # every rule on other lines is a window in the order of the sheet: one sort serves all
    order = Window.partitionBy(*by).orderBy("idx")
    down = order.rowsBetween(Window.unboundedPreceding, 0)
    full = F.col("_live") & F.col("_date").rlike("^20[0-9]{2}")
    before = F.last(F.when(full, F.col("_date")), ignorenulls=True).over(down)
    run = F.count_if("blank").over(order.rangeBetween(1 - BLANKS, 0)) == BLANKS
    placed = open_.withColumns({"_before": before, "_run": run})
    carried = (F.col("_date") == "") & named & F.col("_before").isNotNull()
    dated = placed.withColumn("used_date", F.when(carried, F.col("_before")).otherwise(F.col("_date"))).withColumn("date_inferred", carried)
    total = F.col("used_date").isin(TOTAL_DATES) | (F.col("_totals") & (F.col("used_date") == ""))
    none = ~named & (F.col("amount").isNull() | (F.col("used_date") == ""))
    good = dated.withColumn("_good", F.col("_live") & ~none & ~total)
    # the table ends at the first full run of blank lines behind the first transaction
    begun = good.withColumn("_ends", F.col("_run") & (F.count_if("_good").over(down) > 0))
    kept = begun.withColumn("_ended", F.count_if("_ends").over(down) > 0).where("_good AND NOT _ended")
    return kept.select(*by, "idx", F.nullif("used_date", F.lit("")).alias("used_date"), "date_inferred", *(F.nullif(F.col(c), F.lit("")).alias(c) for c in ("merchant", "address", "purpose")), "people", "amount", F.nullif("role", F.lit("")).alias("role"), F.nullif("method", F.lit("")).alias("method"))
