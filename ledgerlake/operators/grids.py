"""Cell grids of sheets: header detection, column mapping, rows, control totals and unpivoting.

A grid is one row (by columns, idx, cells) for each line of a sheet, idx from 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.numbers import head_count, to_amount
from ledgerlake.functions.text import text

# Names that columns of a field have, after norm_header(), in the fields' and the names' order.
ALIASES = {
    "date": ["사용일", "사용일자", "집행일", "집행일자", "일자", "일시", "날짜", "사용일시", "집행일시", "결제일", "이용일", "승인일"],
    "time": ["사용시간", "집행시간", "시간"],
    "merchant": ["집행장소", "사용처", "사용장소", "장소", "업소명", "상호", "가맹점명"],
    "address": ["주소", "소재지", "집행장소주소", "사용처주소"],
    "purpose": ["집행목적", "사용목적", "목적", "내용", "적요"],
    "people": ["인원", "참석인원", "대상인원", "사용인원"],
    "amount": ["금액", "집행금액", "집행액", "사용금액", "사용액", "결제금액", "결제액", "지출금액", "지출액", "지급금액", "지급액", "승인금액", "카드사용액", "카드이용금액"],
    "role": ["사용자", "사용자명", "직책", "직위", "집행자", "부서명", "부서", "구분"],
    "method": ["결제방법", "지급방법", "결제수단"],
}
#: Extra points of a header that has the field.
BONUS = {"merchant": 2, "amount": 2, "date": 1}


def norm_header(c: Column) -> Column:
    return F.lower(F.regexp_replace(text(c), r"(?U)[\s()\[\]·ㆍ._/-]+", ""))


def has_field(cells: Column, names: list[str]) -> Column:
    return F.exists(cells, lambda c: (c != "") & reduce(lambda a, b: a | b, (F.contains(c, F.lit(n)) for n in names)))


def header_score(cells: Column, aliases: dict[str, list[str]] | None = None) -> Column:
    """Points of a line as a header: one for each field it names, and the fields' bonus."""
    return _points(F.transform(cells, norm_header), aliases or ALIASES)


def _points(cells: Column, aliases: dict[str, list[str]]) -> Column:
    """header_score() of cells that went through norm_header()."""
    return reduce(lambda a, b: a + b, (F.when(has_field(cells, names), 1 + BONUS.get(f, 0)).otherwise(0) for f, names in aliases.items()))


def find_headers(grid: DataFrame, by: list[str], aliases: dict[str, list[str]] | None = None, first: int = 40) -> DataFrame:
    """(by, idx, span, header, score): the header of each sheet among its first lines.

    The best single line, the first of equals, if it has 4 points and names merchant and amount; else the best pair of
    neighbouring lines joined cell by cell, on the same condition. Sheets without a header give no row.
    """
    a = aliases or ALIASES
    after = F.lead("cells").over(Window.partitionBy(*by).orderBy("idx"))
    g = grid.where(F.col("idx") < first).withColumn("_next", after)
    pair = F.zip_with("cells", "_next", lambda x, y: F.trim(F.concat_ws(" ", F.nullif(text(x), F.lit("")), F.nullif(text(y), F.lit("")))))
    options = g.select(*by, "idx", F.explode(F.array(F.struct(F.lit(1).alias("span"), F.col("cells").alias("header")), F.struct(F.lit(2).alias("span"), pair.alias("header")))).alias("o")).select(*by, "idx", "o.*").where("header IS NOT NULL")
    # the names of cells are read for every field: a column of their own, computed once for a line
    options = options.withColumn("_names", F.transform("header", norm_header)).withColumn("score", _points(F.col("_names"), a))
    best = options.groupBy(*by, "span").agg(F.min_by(F.struct("idx", "header", "score", "_names"), F.struct(-F.col("score"), "idx")).alias("b")).select(*by, "span", "b.*")
    good = best.where((F.col("score") >= 4) & has_field(F.col("_names"), a["merchant"]) & has_field(F.col("_names"), a["amount"]))
    return good.groupBy(*by).agg(F.min_by(F.struct("idx", "span", "header", "score"), "span").alias("b")).select(*by, "b.*")


def column_positions(header: Column, aliases: dict[str, list[str]] | None = None) -> Column:
    """Map from field to the position (from 0) of its column: the first cell that names it; for role the first of its
    names, in their order, that a cell has."""
    aliases = aliases or ALIASES
    cells = F.transform(header, norm_header)
    at = lambda names: F.array_position(F.transform(cells, lambda c: (c != "") & reduce(lambda a, b: a | b, (F.contains(c, F.lit(n)) for n in names))), True) - 1
    found = []
    for field, names in aliases.items():
        place = F.coalesce(*(F.nullif(at([n]), F.lit(-1).cast("long")) for n in names)) if field == "role" else F.nullif(at(names), F.lit(-1).cast("long"))
        found.append(F.struct(F.lit(field).alias("k"), place.cast("int").alias("v")))
    return F.map_from_entries(F.filter(F.array(*found), lambda s: s["v"].isNotNull()))


def sheet_rows(grid: DataFrame, by: list[str], aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows behind each sheet's header as (by, idx, date, date_inferred, merchant, purpose, people, amount, role).

    Dates of merged cells are carried down; lines of subtotals and lines without merchant or amount are left out."""
    headers = find_headers(grid, by, aliases).select(*by, F.col("idx").alias("_h"), "span", column_positions(F.col("header"), aliases).alias("_m"))
    lines = grid.join(headers, by).where(F.col("idx") >= F.col("_h") + F.col("span"))
    cell = lambda f: F.nullif(text(F.get("cells", F.try_element_at("_m", F.lit(f)))), F.lit(""))
    rows = lines.select(*by, "idx", cell("date").alias("_d"), cell("merchant").alias("merchant"), cell("purpose").alias("purpose"), head_count(F.concat(F.get("cells", F.try_element_at("_m", F.lit("people"))), F.lit("명"))).alias("people"), to_amount(cell("amount")).alias("amount"), cell("role").alias("role"), F.array_join("cells", "").alias("_all"))
    down = F.last("_d", ignorenulls=True).over(Window.partitionBy(*by).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("date", down).withColumn("date_inferred", F.col("_d").isNull() & down.isNotNull())
    total = F.regexp_replace("_all", r"\s", "").rlike("^(?:소계|합계|총계|계)")
    return rows.where(F.col("merchant").isNotNull() & F.col("amount").isNotNull() & ~total).select(*by, "idx", "date", "date_inferred", "merchant", "purpose", "people", "amount", "role")


def scaled_by_median(rows: DataFrame, by: list[str], amount: str, least: int = 5000, factor: int = 1000, enough: int = 3) -> DataFrame:
    """Amounts times factor in groups of `enough` or more whose median is below `least`: they were given in thousands."""
    med = rows.groupBy(*by).agg(F.median(amount).alias("_median"), F.count(amount).alias("_n"))
    small = (F.col("_median") < least) & (F.col("_n") >= enough)
    return rows.join(med, by).withColumn("scale", F.when(small, factor).otherwise(1)).withColumn(amount, F.col(amount) * F.col("scale")).drop("_median", "_n")


def control_totals(rows: DataFrame, totals: DataFrame, by: list[str], amount: str) -> DataFrame:
    """(by, n, total, ok): whether rows have the printed number and sum of each group."""
    got = rows.groupBy(*by).agg(F.count("*").alias("n"), F.sum(amount).alias("total"))
    return got.join(totals, by, "full").withColumn("ok", F.coalesce((F.col("n") == F.col("printed_n")) & (F.col("total") == F.col("printed_total")), F.lit(False)))


def unpivot_positive(df: DataFrame, ids: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """One row for each column of a row that is above 0."""
    return df.unpivot(ids, columns, name, value).where(F.col(value) > 0)
