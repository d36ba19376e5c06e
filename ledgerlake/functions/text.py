"""Names, addresses and other text as column functions; no Python runs per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns and words that names and addresses are normalised by.
NOT_KEY = "[^0-9a-z가-힣]"
COMPANY_PREFIX = r"(?i)^(?:주식회사|유한회사|\(주\)|㈜)\s*"
BRANCH_IN_BRACKETS = r"\([^)]*(?:점|지점|호점)\)\s*$"
BRANCH_SUFFIXES = ["서여의도\\d*호?점$", "서여의도점$", "여의도아이에프씨점$", "여의도ifc점$", "여의도점$", "일산점$", "마포점$", "강선점$", "영등포점$", "아이에프씨점$", "ifc점$", "\\d+호점$"]
PROVINCES = {"서울특별시": "서울", "서울시": "서울", "경기도": "경기", "인천광역시": "인천", "부산광역시": "부산", "대구광역시": "대구", "대전광역시": "대전", "광주광역시": "광주", "울산광역시": "울산", "세종특별자치시": "세종"}
ROAD = r"^(.+?(?:대로|로|길)\s*\d+(?:-\d+)?)(?:$|[^0-9A-Za-z_가-힣])"
LOT = r"^(.+?[가-힣0-9]+동\s*\d+(?:-\d+)?)(?:$|[^0-9A-Za-z_가-힣])"
LOCALITY = r"([가-힣0-9]+(?:시|군|구))(?:$|[^0-9A-Za-z_가-힣])"
BROAD_ORIGINS = ["서울시청", "경기도청", "인천시청", "중앙정부"]
# Fixed value: a name with a bracket at its end.
NAME_AND_BRACKET = r"^(.*?)[（(]([^()（）]+)[)）]\s*$"
ADDRESS_WORDS = ["서울", "경기", "인천", "부산", "대구", "대전", "광주", "울산", "세종", "강원", "충북", "충남", "전북", "전남", "경북", "경남", "제주", "구 ", "시 ", "군 ", "로 ", "길 ", "동 ", "대로"]


def text(c: Column | str) -> Column:
    """Trimmed text with runs of any white space as one blank; null becomes the empty string."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?U)\s+", " "))


def compact(c: Column | str) -> Column:
    """Lower-cased digits, a-z and Hangul only."""
    return F.regexp_replace(F.lower(text(c)), NOT_KEY, "")


def strict_name(c: Column | str) -> Column:
    """Name key that keeps company prefix and branch."""
    return compact(c)


def family_name(c: Column | str, suffixes: list[str] | None = None) -> Column:
    """Name key without company prefix, branch in brackets and known branch endings, taken off in order."""
    s = F.regexp_replace(F.regexp_replace(text(c), COMPANY_PREFIX, ""), BRANCH_IN_BRACKETS, "")
    for pattern in BRANCH_SUFFIXES if suffixes is None else suffixes:
        s = F.regexp_replace(s, f"(?i){pattern}", "")
    return compact(s)


def canonical_name(df: DataFrame, column: str, aliases: DataFrame, name: str) -> DataFrame:
    """df with `name`: what the aliases (alias, name; one row for each) say for the trimmed text of a column, or that text."""
    known = aliases.select(F.col("alias").alias("_alias"), F.col("name").alias("_name"))
    return df.join(known, text(column) == F.col("_alias"), "left").withColumn(name, F.coalesce("_name", text(column))).drop("_alias", "_name")


def _or_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def canonical_address(c: Column | str) -> Column:
    """Building key: province shortened, brackets gone, cut behind road and number, else behind quarter and lot."""
    s = text(c)
    for long, short in PROVINCES.items():
        s = F.replace(s, F.lit(long), F.lit(short))
    s = F.trim(F.regexp_replace(F.regexp_replace(s, r"\([^)]*\)", " "), r"(?U)\s+", " "))
    s = F.regexp_replace(s, "^[ ,]+|[ ,]+$", "")
    return compact(F.coalesce(_or_empty(F.regexp_extract(s, ROAD, 1)), _or_empty(F.regexp_extract(s, LOT, 1)), s))


def locality(hint: Column, address: Column, origin: Column) -> Column:
    """The last city, county or district named by hint, else address, else a local origin; empty without one."""
    local = F.when(text(origin).rlike("(?:시|군|구)$") & ~text(origin).isin(BROAD_ORIGINS), text(origin))
    raw = F.coalesce(_or_empty(text(hint)), _or_empty(text(address)), local, F.lit(""))
    return F.coalesce(compact(F.try_element_at(F.regexp_extract_all(raw, F.lit(LOCALITY), F.lit(1)), F.lit(-1))), F.lit(""))


def entity_key(name: Column, address: Column, place: Column, origin: Column) -> Column:
    """family||address; without address family||locality of names of 4 signs or more; else the single record."""
    family, building = family_name(name), canonical_address(address)
    return (
        F.when((family != "") & (building != ""), F.concat_ws("||", family, building))
        .when((family != "") & (place != "") & (F.length(family) >= 4), F.concat(family, F.lit("||locality:"), place))
        .otherwise(F.concat_ws("||", F.lit("single"), compact(name), compact(origin)))
    )


def rejoin_spaced(c: Column | str) -> Column:
    """Joins a text of three or more parts if at least 70 % of these are single Hangul syllables."""
    return rejoined(text(c))


def rejoined(s: Column) -> Column:
    """rejoin_spaced() of what text() gives: parts are parted by one blank each."""
    joined = F.replace(s, F.lit(" "), F.lit(""))
    parts = F.length(s) - F.length(joined) + 1
    single = F.regexp_count(s, F.lit("(?<![^ ])[가-힣](?![^ ])"))
    return F.when((parts >= 3) & (single / parts >= 0.7), joined).otherwise(s)


def split_place(c: Column | str) -> Column:
    """struct(name, address): a bracket at the end is the address if it has a word of an address."""
    s = text(c)
    name, hint = text(F.regexp_extract(s, NAME_AND_BRACKET, 1)), text(F.regexp_extract(s, NAME_AND_BRACKET, 2))
    found = reduce(lambda a, b: a | b, (F.contains(hint, F.lit(w)) for w in ADDRESS_WORDS))
    return F.struct(F.when(found, F.coalesce(_or_empty(name), s)).otherwise(s).alias("name"), F.when(found, hint).otherwise("").alias("address"))


def first_label(c: Column, rules: list[tuple[list[str], str]], default: str) -> Column:
    """The label of the first rule that has a word contained in c."""
    out = F.lit(default)
    for words, label in reversed(rules):
        out = F.when(reduce(lambda a, b: a | b, (F.contains(c, F.lit(w)) for w in words)), F.lit(label)).otherwise(out)
    return out


def ladder(rules: list[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first rule that holds; a rule that is null does not hold."""
    out = F.lit(default)
    for rule, value in reversed(rules):
        out = F.when(rule, value if isinstance(value, Column) else F.lit(value)).otherwise(out)
    return out


def html_safe(json: Column) -> Column:
    """JSON text that can stand inside a script element."""
    for sign, code in (("&", "\\u0026"), ("<", "\\u003c"), (">", "\\u003e"), ("\u2028", "\\u2028"), ("\u2029", "\\u2029")):
        json = F.replace(json, F.lit(sign), F.lit(code))
    return json


def row_id(columns: list[Column | str], length: int = 20, null: str = "") -> Column:
    """The first `length` hex digits of the SHA-256 of the columns joined by |; nulls read as `null`."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(null)) for c in columns]
    return F.substr(F.sha2(F.concat_ws("|", *parts), 256), F.lit(1), F.lit(length))
