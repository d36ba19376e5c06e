"""The cohorts' rules, dates and reviews on small cases."""

from pyspark.sql import functions as F

from ledgerlake.functions import numbers as N
from ledgerlake.functions import rules as R
from ledgerlake.operators import publication as P
from ledgerlake.operators import review as V
from ledgerlake.sources import workbooks
from ledgerlake.sources.paged import PagedReader, Pages
from ledgerlake.streaming import arrivals


def values(spark, cases, *columns):
    rows = [c if isinstance(c, tuple) else (c,) for c in cases]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"c{k} string" for k in range(len(rows[0]))))
    return [tuple(r)[0] if len(columns) == 1 else tuple(r) for r in df.orderBy("i").select(*columns).collect()]


def test_merchants(spark):
    cases = ["3828700", "의원 및 직원 명4", "임**", "의정활동 간담회 식비", "11번가식당", "직원 3명", "", "미상", "가 나 다 라", "파리 식당"]
    assert values(spark, cases, R.plausible_merchant(F.col("c0"))) == [True, False, False, False, True, False, False, False, True, True]
    assert values(spark, ["배달의민족", "㈜쿠팡", "쿠팡식당", None, "우성 화원"], R.is_non_venue(F.col("c0"))) == [True, True, False, True, True]


def test_roles(spark):
    cells = [("과장", "의장 업무추진비", "", "(부의장) 간담"), ("운영위원장", "", "", ""), ("시의회", "2부의장", "", ""), ("홍보과", "", "공개", "시군의회의장협의회"), (None, None, None, None)]
    assert values(spark, cells, R.resolved_role(F.col("c0"), F.col("c1"), F.col("c2"), F.col("c3"))) == ["부의장", "운영위원장", "2부의장", "홍보과", ""]
    assert values(spark, ["차관 겸 장관", "부총리", "국무총리실장", "경찰청장", None], R.central_tier(F.col("c0")), R.central_tier(F.col("c0"), True)) == [("minister", "vice_minister"), ("deputy_prime_minister",) * 2, ("prime_minister",) * 2, ("agency_head",) * 2, ("other",) * 2]
    pairs = [("교육감", "교육감 외 2명"), ("교육감", "교육감실 직원"), ("국장(대)", "국장(대) 참석"), ("", "교육감"), ("교육감", None)]
    assert values(spark, pairs, R.actor_in_target(F.col("c0"), F.col("c1"))) == [True, False, True, False, False]


def test_dates(spark):
    assert values(spark, ["25년 3분기 내역", "2026년 파주시의회 업무추진비 내역(2분기)", "2026.7월", "2026년 2/4분기", "내역"], N.title_period(F.col("c0"))["y"], N.title_period(F.col("c0"))["m"], N.title_period(F.col("c0"))["q"]) == [(2025, None, 3), (2026, None, 2), (2026, 7, None), (2026, None, 2), (None, None, None)]
    assert values(spark, ["2025-11-18 14시", "2025.1.5 9:7", "2025년 2월 30일", None], N.moment(F.col("c0"))["day"], N.moment(F.col("c0"))["time"]) == [("2025-11-18", "14:00"), ("2025-01-05", "09:07"), ("", ""), ("", "")]
    assert values(spark, ["20260105", "미정", "8. 5."], N.date_or_text(F.col("c0")), F.date_format(N.repair_date(F.col("c0"), F.lit(2026), F.lit(8)), "yyyy-MM-dd")) == [("2026-01-05", "2026-01-05"), ("미정", None), ("8. 5.", "2026-08-05")]
    assert values(spark, ["총 12명 (직원 3명, 위원 9명)", "직원 2명, 위원 5명", "외 3명", "4인", "없음"], N.head_total(F.col("c0"))) == [12, None, 4, 4, None]


def test_places(spark):
    assert values(spark, ["서울시, 마포구 월드컵로 1", "세종대로 5", "경기 수원시", None], R.city_address(F.col("c0")), R.location_bucket(F.col("c0"))["bucket"]) == [("서울 마포구 월드컵로 1", "seoul_cross_district"), ("세종대로 5", "unknown"), ("경기 수원시", "capital_region_destination"), ("", "unknown")]
    assert values(spark, ["동일로 131-0@", "동일로 131-10@", None], R.building_of(F.lit("3"), F.col("c0"))) == ["3|동일로131", "3|동일로131-10", ""]
    km = spark.range(1).select(N.haversine_km(*(F.lit(x) for x in (37.5, 127.0, 37.5, 127.0))), N.haversine_km(*(F.lit(x) for x in (0.0, 0.0, 0.0, 90.0)))).first()
    assert km[0] == 0 and abs(km[1] - 6371 * 3.141592653589793 / 2) < 1e-6


def test_coordinates(spark):
    schema = "id int, turn int, geo_key string, lat double, lon double, match_mode string, addr_type string, geo_address string, result_name string, geo_score double, target string, names array<string>, verified boolean, national boolean"
    row = lambda i, turn, key, mode, kind, at, score, target, verified=False, national=False: (i, turn, key, 1.0, 2.0, mode, kind, at, "n", score, target, ["n"], verified, national)
    rows = [row(1, 0, "a", "name", "poi", "x", 99.0, "t"), row(1, 1, "b", "name", "poi", "t", 5.0, "t"), row(1, 2, "c", "address", "poi", "t", 1.0, "t"), row(2, 0, "d", "name", "poi", "x", 9.0, "t"), row(3, 0, "e", "name", "poi", "x", 9.0, "t", True),
            row(4, 0, "f", "name", "locality", "x", 100.0, None), row(5, 0, "g", "address", "poi", "x", 1.0, "", False, True), row(6, 0, "h", "name", "poi", "x", 1.0, None)]
    got = {r["id"]: (r["geo_key"], r["basis"]) for r in V.selected_coordinates(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: ("c", "address"), 2: (None, "address_mismatch"), 3: ("e", "verified_name"), 4: (None, "name_resolved_to_geographic_locality"), 5: (None, "national_record_without_verified_address"), 6: ("h", "safe")}


def test_licences(spark):
    venues = spark.createDataFrame([(1, "a", "x1", "b1"), (2, "a", "x9", "b1"), (3, "a", "x2", "b2"), (4, "z", "x1", "b1"), (5, "c", "", "")], "venue int, name_key string, address_key string, building string")
    licences = spark.createDataFrame([("l1", "a", "x1", "b1"), ("l2", "a", "x2", "b2"), ("l3", "a", "x2", "b2"), ("l4", "c", "", "")], "licence string, name_key string, address_key string, building string")
    got = {r["venue"]: (r["status"], r["licence"], r["neighbours"]) for r in V.licence_matches(venues, licences).collect()}
    assert got == {1: ("EXACT_NAME_AND_ADDRESS", "l1", 1), 2: ("NAME_AND_BUILDING_ADDRESS_FLOOR_UNVERIFIED", "l1", 1), 3: ("AMBIGUOUS_LICENSE_RECORDS", None, 2), 4: ("NOT_MATCHED", None, 1), 5: ("NOT_MATCHED", None, 0)}


def test_integrity(spark):
    old = spark.createDataFrame([("s", 1, "a"), ("s", 2, "b"), ("t", 1, "a")], "src string, k int, v string")
    new = spark.createDataFrame([("s", 2, "c"), ("s", 3, "d"), ("t", 1, "a"), ("u", 1, "n")], "src string, k int, v string")
    got = {r["src"]: (r["status"], r["lost"], r["changed"], r["added"], r["failures"]) for r in P.integrity(old, new, ["src"], ["k"], ["v"]).collect()}
    assert got == {"s": ("HOLD", 1, 1, 1, "historical_rows_modified,historical_rows_removed"), "t": ("PASS", 0, 0, 0, ""), "u": ("PASS", 0, 0, 1, "")}


def test_placed_rows(spark):
    lines = spark.createDataFrame([("p", "", "s", 0, ["x", "y"], None), ("p", "", "s", 1, ["A", "1"], None), ("p", "", "s", 2, ["", "2"], None), ("q", None, None, None, None, "bad")], workbooks.SCHEMA)
    got = [(r["idx"], r["member_name"], r["n"]) for r in workbooks.placed_rows(lines, {"member_name": 0, "n": 1}, ["member_name"], 1).orderBy("idx").collect()]
    assert got == [(1, "A", "1"), (2, "A", "2")]
    assert [list(c) for _, _, c in workbooks.grids_of(("x" * 200_000 + ",y").encode(), "a.csv")] == [["x" * 200_000, "y"]]


def test_pages_until_a_short_one(tmp_path):
    for k, n in ((1, 2), (2, 2), (3, 1)):
        (tmp_path / f"p{k}.json").write_text('{"rows": [%s]}' % ", ".join("1" * n))
    reader = PagedReader(Pages({"url": f"file://{tmp_path}/p{{page}}.json", "size": 2}))
    assert [page for part in reader.partitions() for page, _ in reader.read(part)] == [1, 1, 2, 2, 3]


def test_retries_and_news(spark):
    of = lambda rows: spark.createDataFrame(rows, "url string, at int")
    got = arrivals.retry_list(of([("a", 1), ("b", 2)]), of([("a", 5), ("c", 3)]), of([("b", 9)]), "url", ["at"], 2)
    assert sorted(map(tuple, got.collect())) == [("a", 5), ("c", 3)]
    assert arrivals.has_news(of([("a", 1), ("z", 1)]), of([("a", 1)]), ["url"]) and not arrivals.has_news(of([("a", 7)]), of([("a", 1)]), ["url"])


def test_parts_are_computed_once(spark):
    """A name is split once for a row, and an address made ready once, not again for every part."""
    plan = lambda c: spark.createDataFrame([("a, b",)], "x string").select(c.alias("y"))._jdf.queryExecution().analyzed().toString()
    assert plan(R.street_of_display(F.col("x"))).count("split(") == 1
    assert plan(R.address_tokens(F.col("x"))).count("regexp_replace(") == plan(R.lookup_address(F.col("x"))).count("regexp_replace(") > 0
