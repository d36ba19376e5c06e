"""Scalar functions on single values."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import numbers as N
from ledgerlake.functions import text as X
from ledgerlake.functions import web as W
from ledgerlake.functions.similarity import compatibility_form, match_ratio


def values(spark, f, xs, *more):
    rows = spark.createDataFrame([(i, x, *m) for i, (x, *m) in enumerate(zip(xs, *more))], "i int, x string" + "".join(f", y{k} int" for k in range(len(more))))
    return [r["v"] for r in rows.select("i", f.alias("v")).orderBy("i").collect()]


def test_dates(spark):
    x = ["25.11.18. 14:37", "20260105", "2026-0105", "202601-05", "2026.1.5", "2026/01/05", "2026-13-40", "", None, "30"]
    assert [str(d) if d else None for d in values(spark, N.to_date(F.col("x")), x)] == ["2025-11-18"] + ["2026-01-05"] * 5 + [None] * 4


def test_dates_from_period(spark):
    x = ["8월 5일", "5일", "5", "31", "2월 30일"]
    got = values(spark, N.repair_date(F.col("x"), F.lit(2026), F.lit(8)), x)
    assert [str(d) if d else None for d in got] == ["2026-08-05"] * 3 + ["2026-08-31", None]
    assert values(spark, N.repair_date(F.col("x"), F.lit(2026), F.lit(None).cast("int")), ["5일"]) == [None]


def test_serial_and_bounds(spark):
    assert [str(d) if d else None for d in values(spark, N.serial_date(F.col("x")), ["45658", "19999", "abc", "45658.5"])] == ["2025-01-01", None, None, "2025-01-01"]
    b = values(spark, N.period_bounds(F.lit(2024), F.col("y0"), F.col("y1")), ["", "", ""], [2, None, None], [None, 4, None])
    assert [(str(r["first"]), str(r["last"])) for r in b] == [("2024-02-01", "2024-02-29"), ("2024-10-01", "2024-12-31"), ("None", "None")]


def test_titles(spark):
    x = ["2026년 8월 업무추진비", "2026년 업무추진비 (2분기)", "2026년도 3분기", "2026년 2/4분기", "업무추진비 2분기"]
    assert [tuple(r) for r in values(spark, N.title_period(F.col("x")), x)] == [(2026, 8, None), (2026, None, 2), (2026, None, 3), (2026, None, 2), (None, None, None)]


def test_amounts_and_heads(spark):
    assert values(spark, N.to_amount(F.col("x")), ["125,000원", "2.5", "3.5", "-", "", None, "1-2"]) == [125000, 2, 4, None, None, None, None]
    assert values(spark, N.head_count(F.col("x")), ["부장 외 3명", "직원 등 5명", "7인", "관계자", None]) == [4, 5, 7, None, None]
    cells = F.split("x", ";")
    assert values(spark, N.recover_amount(cells), ["a;125,000원;3", "18;8;2", "999;60000000;1000"]) == [125000, None, 1000]
    assert values(spark, N.recover_amount(cells, F.array(F.lit(1))), ["a;125,000;2000"]) == [2000]


def test_names_and_addresses(spark):
    assert values(spark, X.family_name("x"), ["주식회사 가나식당", "(주)가나 식당 3호점", "가나식당(본점)", "ABC  마포점", None]) == ["가나식당", "가나식당", "가나식당", "abc", ""]
    assert values(spark, X.strict_name("x"), ["주식회사 가나"]) == ["주식회사가나"]
    assert values(spark, X.canonical_address("x"), ["서울특별시 중구 세종대로 110 (태평로1가) 3층", "인천광역시 연수구 송도동 24-5 상가", "", None]) == ["서울중구세종대로110", "인천연수구송도동245", "", ""]
    place = X.locality(F.lit(None), F.col("x"), F.lit("중앙정부"))
    assert values(spark, place, ["인천광역시 연수구 송도", "", None]) == ["연수구", "", ""]
    assert values(spark, X.text("x"), ["  a　\n b ", None]) == ["a b", ""]
    assert values(spark, X.rejoin_spaced("x"), ["가 나 식 당", "가나 식당 집", "a b c"]) == ["가나식당", "가나 식당 집", "a b c"]
    assert [tuple(r) for r in values(spark, X.split_place("x"), ["가나 (서울 중구)", "가나 (2층)", "가나"])] == [("가나", "서울 중구"), ("가나 (2층)", ""), ("가나", "")]


def test_urls(spark):
    x = ["https://a.kr/download?b=2&a=1&c=#x", "https://a.kr/x/attach", "https://a.kr/bbsAttachDownload.do", "javascript:void(0)", "https://a.kr/f.xlsx?a=1&amp;b=2", "https://u:p@a.kr/f.pdf", "https://a.kr/page", None]
    assert values(spark, W.attachment_url(F.col("x")), x) == ["https://a.kr/download?a=1&b=2", None, None, None, "https://a.kr/f.xlsx?a=1&b=2", None, None, None]
    assert values(spark, W.trusted(F.col("x"), ["go.kr"]), ["https://a.go.kr/x", "https://go.kr:8080", "https://ago.kr", None]) == [True, True, False, False]


def test_scores(spark):
    df = spark.createDataFrame([(10, 5, 2, 10, 3_000_000), (0, 0, 0, 0, 0)], "visits long, months long, roles long, evening long, spend long")
    assert [r[0] for r in df.select(N.score("council")).collect()] == [100.0, 0.0]
    for name, (scale, terms) in N.SCORES.items():
        assert round(scale * sum(t[0] for t in terms), 6) == 100, name


def test_evening_and_html(spark):
    assert values(spark, N.is_evening(F.col("x")), ["18:30", "17시", "9:00", "", None]) == [True, True, False, False, False]
    assert values(spark, X.html_safe(F.col("x")), ["a<b>& "]) == ["a\\u003cb\\u003e\\u0026\\u2028"]


def test_arrow_functions(spark):
    df = spark.createDataFrame([("abcd", "abcd"), ("abcd", "xyz"), (None, "a")], "a string, b string")
    assert [r[0] for r in df.select(match_ratio("a", "b")).collect()] == [1.0, 0.0, 0.0]
    assert df.select(compatibility_form(F.lit("Ａ１"))).first()[0] == "a1"
