"""The cohorts' rules over whole tables: texts in the cohorts' language are dealt to the rows by their keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import rules as R
from ledgerlake.functions.numbers import currency_in_text, head_count, head_total, moment, month_marks, scale_word, shifted_month, active_in, latest_day
from ledgerlake.functions.text import canonical_name, entity_key, locality, rejoin_spaced
from ledgerlake.operators.filters import reason_counts, with_reason
from ledgerlake.plans.registry import query, table

#: Texts that stand for the columns of disclosures; a row takes the one at its key modulo the list's length.
MERCHANTS = [
    "가나식당", "(주)다라면옥", "주식회사 신화푸드", "한 강 횟 집", "스타벅스 역삼점", "의원 및 직원 명4", "직원 5명", "임**", "3828700", "국민은행", "파리바게뜨 시청점", "간담회 식비 지출", "-", "제주흑돼지 (02-123-4567)",
    "배달의민족", "쿠팡 이츠", "현대그린푸드 국회점", "마곡점", "신안촌", "대한식당 (123-45-67890)", "구내식당", "참석자 명단", "남도한정식 (인천 연수구 송도 소재)", "초밥나라", "금호동해물찜", "의장 외 의원 3명", "", "유한회사 소문난국밥",
]
PURPOSES = ["현안 협의 간담", "직원 격려 오찬", "물품 구입", "주차 요금", "의정활동 지원", "업무협의", "커피 구입", "택시비", "유관기관 관계자 방문", "(의장) 현안 논의", "[2부의장] 간담", "", "시군의회의장협의회 참석", "기념품 및 다과"]
ROLES = ["의장", "부의장", "1부의장(홍길동)", "기획경제위원장", "의장단협의회", "장관", "차관", "국무총리", "부총리 겸 장관", "경찰청장", "실장", "교통국장", "시장", "부시장", "검찰총장", "법무부 차관", "사장", "과장", "총리", "헌법재판소사무처장", "장관 비서실 차관", "운영 위원장"]
TITLES = ["교육감 업무추진비 집행내역", "제1부교육감 업무추진비", "부서별 업무추진비", "경찰서장 업무추진비", "강남교육지원청장 업무추진비 공개", "정책기획조정관 업무추진비", "교육감 일정", "국가수사본부장 업무추진비", "경찰청 차장 업무추진비", "대변인 업무추진비 (7월)"]
TARGETS = ["교육감 외 3명", "교육감실 직원", "경찰청장, 국장", "의장 등 5명", "부의장실", "의장비서실 2명, 의장", "", "검찰총장(대리)", "시장+부시장"]
ADDRESSES = [
    "서울특별시 중구 세종대로 110", "종로구 사직로 8길 4-1 2층", "서울시 강남구 테헤란로 131-0@", "경기 수원시 팔달구 효원로 1", "인천 연수구 송도동 12-3", "부산광역시 해운대구 우동 1", "세종대로 5", "", "마포구, 월드컵로 3 (성산동) 102호", "제주 제주시 연동 1", "서울 서울 용산구 한강대로 2", "강원특별자치도 춘천시 중앙로 1",
]
INSTITUTIONS = ["법무부", "대검찰청", "헌법재판소", "고위공직자범죄수사처", "서울고등법원", "국회의원 홍길동", "서울시청", "중앙정부 기획재정부", "한국공기업", "서울특별시교육청", "마포구", "수원시의회", "광역 집행부 경기", "법조 단체", "기타"]


def dealt(texts: list[str], key: Column | str, step: int = 1) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.element_at(F.array(*map(F.lit, texts)), (F.floor(k / step) % len(texts)).cast("int") + 1)


def dealt_sql(texts: list[str], key: str, step: int = 1) -> str:
    return f"[{', '.join(chr(39) + t + chr(39) for t in texts)}][CAST({key} // {step} % {len(texts)} AS INT) + 1]"


def any_sql(column: str, words: list[str]) -> str:
    return "(" + (" OR ".join(f"contains({column}, '{w}')" for w in words) or "false") + ")"


def in_sql(column: str, words: list[str]) -> str:
    return f"{column} IN ({', '.join(chr(39) + w + chr(39) for w in words)})" if words else "false"


#: One row for each order: merchant, purpose, role, target and address as texts.
_ROWS = f"""o AS (SELECT o_orderkey AS k, {dealt_sql(MERCHANTS, 'o_orderkey')} AS merchant, {dealt_sql(PURPOSES, 'o_orderkey', 3)} AS purpose, {dealt_sql(ROLES, 'o_orderkey', 5)} AS role,
    {dealt_sql(TARGETS, 'o_orderkey', 7)} AS target, {dealt_sql(ADDRESSES, 'o_orderkey', 2)} AS address, {dealt_sql(INSTITUTIONS, 'o_orderkey', 11)} AS institution, {dealt_sql(TITLES, 'o_orderkey', 13)} AS title,
    CAST(o_totalprice AS BIGINT) % 300000 AS amount FROM orders)"""


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("k"), dealt(MERCHANTS, "o_orderkey").alias("merchant"), dealt(PURPOSES, "o_orderkey", 3).alias("purpose"), dealt(ROLES, "o_orderkey", 5).alias("role"),
        dealt(TARGETS, "o_orderkey", 7).alias("target"), dealt(ADDRESSES, "o_orderkey", 2).alias("address"), dealt(INSTITUTIONS, "o_orderkey", 11).alias("institution"), dealt(TITLES, "o_orderkey", 13).alias("title"),
        (F.bround("o_totalprice").cast("bigint") % 300000).alias("amount"),
    )


_WORD = "[^0-9A-Za-z_가-힣]"
_CLEAN = "trim(regexp_replace(merchant, '\\s+', ' ', 'g'))"
_JOINED = f"CASE WHEN len(string_split({_CLEAN}, ' ')) >= 3 AND len(list_filter(string_split({_CLEAN}, ' '), lambda x: regexp_full_match(x, '[가-힣]'))) / len(string_split({_CLEAN}, ' '))::DOUBLE >= 0.7 THEN replace({_CLEAN}, ' ', '') ELSE {_CLEAN} END"
_PLAUSIBLE = f"""p AS (SELECT *, {_JOINED} AS s, regexp_replace({_JOINED}, '[\\s,./·ㆍ()]+', '', 'g') AS c FROM o),
    q AS (SELECT *, {' + '.join(f"contains(c, '{w}')::INT" for w in R.ATTENDEES)} AS hits FROM p),
    m AS (SELECT *, NOT (s = '' OR {in_sql('s', R.NO_NAME)} OR {' OR '.join(f"regexp_matches(s, '{p}')" for p in R.NOT_MERCHANT)}
      OR (regexp_matches(c, '[0-9]+명|명[0-9]+') AND hits > 0) OR (contains(c, '명') AND hits >= 2) OR {any_sql('c', R.PURPOSE_MARKS)}
      OR (length(c) >= 16 AND (ends_with(c, '식비') OR ends_with(c, '다과비'))) OR (length(s) > 40 AND {any_sql('s', R.LONG_MARKS)})) AS plausible FROM q)"""


@query(f"""WITH {_ROWS}, {_PLAUSIBLE} SELECT k, s AS name, plausible, plausible AND NOT {in_sql('s', R.COUNCIL_AMBIGUOUS)} AND NOT {any_sql('s', R.COUNCIL_NON_DINING)} AND NOT {any_sql('purpose || s', R.COUNCIL_EXCLUDE)} AS meal FROM m""")
def council_meal_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows of councils are meals, by name first."""
    m = F.col("merchant")
    return _rows(spark, sf_dir).select("k", rejoin_spaced(m).alias("name"), R.plausible_merchant(m).alias("plausible"), R.council_meal(m, F.col("purpose")).alias("meal"))


_STRIPPED = "trim(trim(regexp_replace(trim(merchant), '^(주식회사|\\(주\\)|㈜)\\s*', '')), ' ,')"
_NUMBERLESS = f"trim(regexp_replace(regexp_replace({_STRIPPED}, '\\s*\\(\\s*[☎☏]?\\s*[0-9]{{2,3}}-[0-9]{{3,4}}-[0-9]{{4}}\\s*\\)\\s*$', ''), '\\s*\\(\\s*[0-9]{{3}}-[0-9]{{2}}-[0-9]{{5}}\\s*\\)\\s*$', ''), ' ,')"
_KEY = "regexp_replace(regexp_replace(lower(trim(merchant)), '^(주식회사|유한회사|\\(주\\)|㈜)\\s*', ''), '[^0-9a-z가-힣]', '', 'g')"
_JW = "CASE " + " ".join(f"WHEN regexp_matches(role, '{p}') THEN {w}::DOUBLE" for p, w in R.JUSTICE_WEIGHTS) + " ELSE 0.5::DOUBLE END"


def _meal_sql(cohort: str) -> str:
    r = R.MEAL_RULES[cohort]
    n = "number_free" if cohort == "enterprise" else "stripped"
    whole = f"({n} || ' ' || purpose)" if cohort != "x" else n
    senior = f"{_JW} >= 0.85" if cohort == "justice" else in_sql("role", r.roles) if r.whole_role else any_sql("role", r.roles)
    odd = f" AND NOT regexp_full_match({n}, '[0-9,.:\\-\\s]+')" if cohort in ("enterprise", "justice") else ""
    odd += f" AND NOT (venue = '' OR {in_sql('venue', R.NON_VENUES)})" if cohort == "enterprise" else ""
    return f"{n} <> '' AND NOT {in_sql(n, r.generic)} AND NOT {any_sql(n, r.non_dining)}{odd} AND NOT {any_sql(whole, r.exclude)} AND ({any_sql('purpose', r.meal)} OR {senior})"


@query(f"""WITH {_ROWS}, n AS (SELECT *, {_STRIPPED} AS stripped, {_NUMBERLESS} AS number_free, {_KEY} AS venue FROM o) SELECT k, {', '.join(f'{_meal_sql(c)} AS {c}' for c in R.MEAL_RULES)} FROM n""")
def cohort_meal_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows each cohort's rule table takes for meals."""
    return _rows(spark, sf_dir).select("k", *(R.cohort_meal(c, F.col("merchant"), F.col("purpose"), F.col("role")).alias(c) for c in R.MEAL_RULES))


@query(f"WITH {_ROWS} SELECT k, {_KEY} AS venue, {_KEY} = '' OR {in_sql(_KEY, R.NON_VENUES)} AS blocked FROM o")
def venue_blocklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("merchant")
    return _rows(spark, sf_dir).select("k", R.venue_key(m).alias("venue"), R.is_non_venue(m).alias("blocked"))


_REASON = f"""CASE WHEN trim(merchant) = '' THEN 'blank_merchant' WHEN amount <= 0 THEN 'non_positive_amount' WHEN {any_sql("lower(purpose || ' ' || merchant)", R.LEGISLATOR_EXCLUDE)} THEN 'row_non_dining'
    WHEN NOT {any_sql('lower(purpose)', R.LEGISLATOR_MEAL)} THEN 'no_explicit_meal_intent' END"""


@query(f"WITH {_ROWS} SELECT coalesce({_REASON}, 'KEPT') AS reason, count(*) AS n FROM o GROUP BY 1")
def legislator_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of legislators by the first rule that rejects them."""
    c, p = F.lower(F.concat_ws(" ", "purpose", "merchant")), F.lower("purpose")
    rules = [("blank_merchant", F.trim("merchant") == ""), ("non_positive_amount", F.col("amount") <= 0), ("row_non_dining", R.has_any(c, R.LEGISLATOR_EXCLUDE)), ("no_explicit_meal_intent", ~R.has_any(p, R.LEGISLATOR_MEAL))]
    return reason_counts(with_reason(_rows(spark, sf_dir), rules))


_SQUEEZED = "regexp_replace(role, '\\s+', '', 'g')"
_LEAD = lambda c: f"CASE WHEN regexp_matches({c}, '(^|[^가-힣])1\\s*부의장|\\(1부의장\\)') THEN '1부의장' WHEN regexp_matches({c}, '(^|[^가-힣])2\\s*부의장|\\(2부의장\\)') THEN '2부의장' WHEN contains({c}, '부의장') THEN '부의장' WHEN regexp_matches({c}, '[가-힣A-Za-z0-9·]+위원장') THEN regexp_extract({c}, '([가-힣A-Za-z0-9·]+위원장)', 1) WHEN contains({c}, '의장') THEN '의장' ELSE '' END"
_TIER = lambda first, second: f"CASE WHEN contains(role, '국무총리') OR role = '총리' THEN 'prime_minister' WHEN contains(role, '부총리') THEN 'deputy_prime_minister' WHEN contains(role, '{first[0]}') THEN '{first[1]}' WHEN contains(role, '{second[0]}') THEN '{second[1]}' WHEN regexp_matches(role, '처장|청장|본부장') THEN 'agency_head' WHEN contains(role, '실장') THEN 'senior_official' WHEN contains(role, '국장') THEN 'director_general' ELSE 'other' END"
_MINISTER, _VICE = ("장관", "minister"), ("차관", "vice_minister")


@query(f"""WITH {_ROWS} SELECT k, CASE WHEN regexp_matches({_SQUEEZED}, '^의장(\\(|$)') THEN '의장' WHEN regexp_matches({_SQUEEZED}, '^[12]?부의장(\\(|$)') THEN '부의장' ELSE nullif(regexp_extract({_SQUEEZED}, '^(.+위원장)(\\(|$)', 1), '') END AS bucket,
    {_TIER(_MINISTER, _VICE)} AS tier, {_TIER(_VICE, _MINISTER)} AS published_tier,
    CASE WHEN contains(role, '장관') AND NOT contains(role, '차관') THEN 1.0 WHEN contains(role, '차관') THEN 0.9 WHEN regexp_matches(role, '처장|청장|본부장') THEN 0.85 WHEN contains(role, '실장') THEN 0.75 WHEN contains(role, '국장') THEN 0.65 ELSE 0.5 END::DOUBLE AS senior,
    CASE WHEN contains(role, '시장') AND NOT contains(role, '부시장') THEN 1.0 WHEN contains(role, '부시장') THEN 0.9 WHEN regexp_matches(role, '실장|국장|과장') THEN 0.65 ELSE 0.5 END::DOUBLE AS mayor,
    {_JW} AS justice, CASE WHEN justice >= 0.98 THEN 'constitutional_judicial_prosecution_head' WHEN justice >= 0.93 THEN 'cabinet_or_investigative_head' WHEN justice >= 0.88 THEN 'court_or_prosecution_agency_head' WHEN justice >= 0.84 THEN 'deputy_head' WHEN justice >= 0.75 THEN 'senior_legal_official' WHEN justice >= 0.6 THEN 'director_level' ELSE 'other' END AS justice_tier FROM o""")
def role_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, tiers and weights of roles in every cohort."""
    r = F.col("role")
    return _rows(spark, sf_dir).select(
        "k", R.role_bucket(r, True).alias("bucket"), R.central_tier(r).alias("tier"), R.central_tier(r, True).alias("published_tier"), R.senior_weight(r).alias("senior"),
        R.mayor_weight(r).alias("mayor"), R.justice_weight(r).alias("justice"), R.justice_tier(r).alias("justice_tier"),
    )


@query(f"""WITH {_ROWS}, b AS (SELECT *, CASE WHEN regexp_matches(purpose, '[(\\[]\\s*1\\s*부의장\\s*[)\\]]') THEN '1부의장' WHEN regexp_matches(purpose, '[(\\[]\\s*2\\s*부의장\\s*[)\\]]') THEN '2부의장' WHEN regexp_matches(purpose, '[(\\[]\\s*부의장\\s*[)\\]]') THEN '부의장' WHEN regexp_matches(purpose, '[(\\[]\\s*의장\\s*[)\\]]') THEN '의장' ELSE '' END AS bracketed,
    {_LEAD('role')} AS own, {_LEAD('title')} AS titled FROM o) SELECT k, coalesce(nullif(own, ''), nullif(bracketed, ''), nullif(titled, ''), nullif(role, ''), title) AS resolved FROM b""")
def role_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles from the cell, the purpose's brackets, the title, or the cell as it is."""
    return _rows(spark, sf_dir).select("k", R.resolved_role(F.col("role"), F.lit(None).cast("string"), F.col("title"), F.col("purpose")).alias("resolved"))


_FITS = "contains(title, '업무추진비') AND NOT regexp_matches(title, '부서별|직원|과장|팀장')"


@query(f"""WITH {_ROWS} SELECT k, CASE WHEN NOT ({_FITS}) THEN NULL WHEN contains(title, '부교육감') THEN 'education_deputy' WHEN contains(title, '교육감') THEN 'education_head' WHEN regexp_matches(title, '교육지원청장|교육장') THEN 'education_branch_head'
      WHEN regexp_matches(title, '실장|국장|본부장|정책기획조정관') THEN 'director_general' END AS education,
    CASE WHEN NOT ({_FITS}) THEN NULL WHEN regexp_matches(title, '경찰청장|경찰청 청장') THEN 'police_head' WHEN regexp_matches(title, '경찰청차장|경찰청 차장') THEN 'police_deputy' WHEN contains(title, '경찰서장') THEN 'police_branch_head'
      WHEN regexp_matches(title, '본부장|실장|국장|기획관|대변인') THEN 'police_bureau_head' END AS police,
    CASE police WHEN 'police_deputy' THEN '경찰청 차장' WHEN 'police_branch_head' THEN '경찰서장' WHEN 'police_bureau_head' THEN regexp_extract(title, '(국가수사본부장|대변인)', 1) END AS police_role FROM o""")
def leadership_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaders that posting titles name, deputies before heads."""
    e, p = R.leadership_title(F.col("title"), R.EDUCATION_TITLES), R.leadership_title(F.col("title"), R.POLICE_TITLES)
    return _rows(spark, sf_dir).select("k", e["tier"].alias("education"), p["tier"].alias("police"), p["role"].alias("police_role"))


@query(f"""WITH {_ROWS}, s AS (SELECT k, regexp_replace(role, '\\s', '', 'g') AS r, regexp_replace(target, '\\s', '', 'g') AS t FROM o),
    c AS (SELECT k, r, t, list_transform(string_split(t, r), lambda x: x)[2:] AS behind FROM s)
    SELECT k, r <> '' AND t <> '' AND len(list_filter(behind, lambda x: NOT (starts_with(x, '실') OR starts_with(x, '비서실') OR starts_with(x, '직원') OR starts_with(x, '업무담당')))) > 0 AS present FROM c""")
def actors_in_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the target of an expense names the role itself, not its office."""
    return _rows(spark, sf_dir).select("k", R.actor_in_target(F.col("role"), F.col("target")).alias("present"))


@query(f"""WITH {_ROWS} SELECT k, CASE WHEN starts_with(institution, '국회의원') THEN '국회의원 정치자금' WHEN institution IN ('서울시청', '경기도청', '인천시청') OR contains(institution, '광역 집행부') THEN '광역 집행부' WHEN starts_with(institution, '중앙정부') THEN '중앙정부'
    WHEN contains(institution, '공기업') OR contains(institution, '공공기관') THEN '공기업·공공기관' WHEN regexp_matches(institution, '법조|법률행정|법무행정') THEN '법조·법률행정' WHEN regexp_matches(institution, '교육청|경찰청|경찰') THEN '교육·치안'
    WHEN regexp_matches(institution, '의회|구,|구·|시의회') OR ends_with(institution, '구') THEN '수도권 지방의회' ELSE '기타 공식 출처' END AS origin_group,
    CASE WHEN institution IN ('법무부', '법제처') THEN 'legal_administration' WHEN contains(institution, '검찰') THEN 'prosecution' WHEN contains(institution, '헌법재판소') THEN 'constitutional_court' WHEN contains(institution, '공직자범죄수사처') THEN 'cio' WHEN contains(institution, '법원') THEN 'judiciary' ELSE 'justice_other' END AS domain FROM o""")
def institution_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).select("k", R.origin_group(F.col("institution")).alias("origin_group"), R.justice_domain(F.col("institution"), F.lit("")).alias("domain"))


_AFTER = {0: ("서울 중구 세종대로 110", "중구"), 1: ("서울 종로구 사직로 8길 4-1 2층", "종로구"), 2: ("서울 강남구 테헤란로 131-0@", "강남구"), 8: ("서울 마포구 월드컵로 3 (성산동) 102호", "마포구"), 10: ("서울 용산구 한강대로 2", "용산구")}
_CITY = [_AFTER.get(i, (a, ""))[0] for i, a in enumerate(ADDRESSES)]
_DISTRICT = [_AFTER.get(i, (a, ""))[1] for i, a in enumerate(ADDRESSES)]


@query(f"""WITH a AS (SELECT o_orderkey AS k, {dealt_sql(_CITY, 'o_orderkey', 2)} AS address, {dealt_sql(_DISTRICT, 'o_orderkey', 2)} AS district FROM orders)
    SELECT *, CASE WHEN address = '' THEN 'unknown' WHEN district = '중구' THEN 'city_hall_home' WHEN {in_sql('district', R.ADJACENT)} THEN 'central_adjacent' WHEN district <> '' THEN 'seoul_cross_district'
      WHEN regexp_matches(address, '^(경기|경기도|인천|인천광역시) ') THEN 'capital_region_destination' WHEN regexp_matches(address, '^(부산광역시|제주|강원특별자치도) ') THEN 'national_destination' ELSE 'unknown' END AS bucket,
    CASE bucket WHEN 'central_adjacent' THEN 0.2 WHEN 'seoul_cross_district' THEN 0.65 WHEN 'capital_region_destination' THEN 0.85 WHEN 'national_destination' THEN 1.0 ELSE 0.0 END::DOUBLE AS weight FROM a""")
def location_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far from city hall addresses are."""
    a, b = F.col("address"), R.location_bucket(F.col("address"))
    return _rows(spark, sf_dir).select("k", R.city_address(a).alias("address"), R.city_district(a).alias("district"), b["bucket"].alias("bucket"), b["weight"].alias("weight"))


_MERCHANT = "merchant"


@query(f"WITH {_ROWS} SELECT k, CASE {' '.join(f'WHEN {any_sql(_MERCHANT, words)} THEN {chr(39)}{label}{R.CATEGORY_GUESSED}{chr(39)}' for words, label in R.CATEGORIES)} ELSE '{R.CATEGORY_OPEN}' END AS category FROM o")
def kitchen_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of kitchen by the sixteen ordered rules."""
    return _rows(spark, sf_dir).select("k", R.category_of(F.col("merchant")).alias("category"))


@query(f"""WITH {_ROWS} SELECT k, regexp_replace(lower(regexp_replace(regexp_replace(trim(merchant), '^(주식회사|유한회사|\\(주\\)|㈜)\\s*', ''), '\\([^()]*(시|군|구)[^()]*\\s*소재\\)', '')), '[^0-9a-z가-힣]', '', 'g') AS family,
    CASE WHEN contains(merchant, '소재)') THEN '연수구' ELSE '' END AS place FROM o""")
def regional_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families and places of names that carry their place in brackets."""
    return _rows(spark, sf_dir).select("k", R.regional_family(F.col("merchant")).alias("family"), R.regional_place(F.col("merchant")).alias("place"))


_FLAT = lambda c: f"lower(regexp_replace({c}, '[\\s()（）\\[\\]{{}}·ㆍ._,/\\\\-]+', '', 'g'))"
_LEGAL = "trim(trim(regexp_replace(trim(merchant), '^(주식회사|\\(주\\)|㈜|유한회사)\\s*', '')), ' ,')"


@query(f"""WITH {_ROWS}, n AS (SELECT k, trim(replace(replace(address, '서울특별시', '서울'), '서울시', '서울'), ' ,') AS a, {_LEGAL} AS n, regexp_extract(merchant, '([0-9]{{2,3}}-[0-9]{{3,4}}-[0-9]{{4}})', 1) AS phone, {_NUMBERLESS} AS enterprise FROM o)
    SELECT k, CASE WHEN a <> '' THEN coalesce(nullif({_FLAT("regexp_replace(n, '[-_ ]', '', 'g')")}, ''), {_FLAT('n')}) || '||' || {_FLAT('a')} ELSE 'exact||' || {_FLAT('n')} END AS key, phone, enterprise FROM n WHERE n <> '-' OR a = '' OR a <> ''""")
def legislator_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group keys of legislators' rows, and names and telephones of enterprises' rows."""
    m = F.col("merchant")
    return _rows(spark, sf_dir).select("k", R.legislator_key(m, F.col("address")).alias("key"), R.phone_in(m).alias("phone"), R.enterprise_name(m).alias("enterprise"))


_DISPLAYS = ["가나식당, 110, 세종대로, 중구, 서울특별시, 04524, 대한민국", "세종대로, 중구, 서울특별시", "낙원, 대한민국", "카페, 7-2, 효원로307번길, 팔달구, 수원시, 경기도, 대한민국", ""]
_STREETS = ["서울특별시 중구 세종대로 110", "서울특별시 중구 세종대로", "", "경기도 수원시 팔달구 효원로307번길 7-2", ""]


@query(f"SELECT o_orderkey AS k, {dealt_sql(_STREETS, 'o_orderkey')} AS street, {dealt_sql(['서울특별시,서울', '종로구', '서울시,강남구,서울', '수원시,팔달구,경기', '연수구,인천', '부산광역시,해운대구', '', '', '마포구', '제주시,제주', '용산구,서울', '강원특별자치도,춘천시,강원'], 'o_orderkey', 2)} AS tokens FROM orders")
def street_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Street addresses from geocoders' names, and the administrative names of addresses."""
    return _rows(spark, sf_dir).select("k", R.street_of_display(dealt(_DISPLAYS, "k")).alias("street"), F.array_join(R.address_tokens(F.col("address")), ",").alias("tokens"))


_ALIASES = {"싞안촌": "신안촌", "금호동해물찜": "금호해물찜", "초밥나라": "스시나라"}


@query(f"WITH {_ROWS} SELECT k, CASE merchant {' '.join(f'WHEN {chr(39)}{a}{chr(39)} THEN {chr(39)}{b}{chr(39)}' for a, b in _ALIASES.items())} ELSE trim(merchant) END AS name FROM o")
def alias_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names after the look-up of known aliases."""
    aliases = spark.createDataFrame(list(_ALIASES.items()), "alias string, name string")
    return canonical_name(_rows(spark, sf_dir), "merchant", aliases, "name").select("k", "name")


@query("""WITH p AS (SELECT p_partkey AS k, p_size, replace(p_name, ' ', '') AS family, p_brand FROM part)
    SELECT k, CASE WHEN p_size % 3 = 0 THEN family || '||경기수원시효원로' || p_size WHEN p_size % 3 = 1 AND length(family) >= 4 THEN family || '||locality:수원시' ELSE 'single||' || family || '||' || lower(replace(p_brand, '#', '')) END AS key FROM p""")
def entity_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of records with an address, with a place only, and with neither."""
    size, name = F.col("p_size"), F.col("p_name")
    address = F.when(size % 3 == 0, F.concat(F.lit("경기도 수원시 효원로 "), size)).otherwise("")
    place = locality(F.when(size % 3 == 1, F.lit("경기도 수원시")), F.lit(None).cast("string"), F.lit(None).cast("string"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), entity_key(name, address, place, F.col("p_brand")).alias("key"))


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN replace('가나다라식당', ' ', '') WHEN o_orderkey % 4 = 1 THEN '가 나 다라마' WHEN o_orderkey % 4 = 2 THEN '가나 식당' ELSE '한강횟집' END AS name FROM orders")
def spaced_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names whose syllables stand apart."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), rejoin_spaced(dealt(["가 나 다 라 식당", "가 나 다라마", "가나 식당", "한 강 횟 집"], "o_orderkey")).alias("name"))


@query("""SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE lpad((o_orderkey % 24)::VARCHAR, 2, '0') || ':' || CASE WHEN o_orderkey % 3 = 1 THEN lpad((o_orderkey % 60)::VARCHAR, 2, '0') ELSE '00' END END AS time FROM orders WHERE year(o_orderdate) >= 2000
    UNION ALL SELECT o_orderkey, '', '' FROM orders WHERE year(o_orderdate) < 2000""")
def date_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and times from texts in three layouts; years before 2000 are no such texts."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    shown = F.when(k % 3 == 0, F.date_format(d, "yyyy년 M월 d일")).when(k % 3 == 1, F.concat(F.date_format(d, "yyyy.M.d "), k % 24, F.lit(":"), k % 60)).otherwise(F.concat(F.date_format(d, "yyyy-MM-dd "), k % 24, F.lit("시")))
    return table(spark, sf_dir, "orders").select(k.alias("k"), moment(shown).alias("m")).select("k", "m.*")


@query("""WITH o AS (SELECT o_orderkey AS k, year(o_orderdate) AS y, month(o_orderdate) AS m, quarter(o_orderdate) AS q, CAST(o_orderkey % 27 - 13 AS INT) AS d FROM orders)
    SELECT k, CAST(year(make_date(y, m, 1) + to_months(d)) * 100 + month(make_date(y, m, 1) + to_months(d)) AS INT) AS shifted, y || '년 ' || m || '월|' || y || '년' || m || '월|' || y || '.' || lpad(m::VARCHAR, 2, '0') || '|' || y || '-' || lpad(m::VARCHAR, 2, '0') || '|' || y || '/' || lpad(m::VARCHAR, 2, '0')
    || '|' || y || '년 ' || q || '분기|' || y || '년' || q || '분기|' || right(y::VARCHAR, 2) || '년 ' || q || '분기|' || right(y::VARCHAR, 2) || '년' || q || '분기' AS marks,
    NOT (k % 2 = 0 AND y * 100 + m < 199706) AND NOT (k % 3 = 0 AND y * 100 + m > 199909) AS active FROM o""")
def month_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shifted months, the ways to write a month, and whether a source was active in it."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    y, m = F.year(d), F.month(d)
    active = active_in(F.date_format(d, "yyyy-MM"), F.when(k % 2 == 0, "1997-06-15"), F.when(k % 3 == 0, "1999-09"))
    return table(spark, sf_dir, "orders").select(k.alias("k"), shifted_month(y, m, (k % 27 - 13).cast("int")).alias("shifted"), F.array_join(month_marks(y, m), "|").alias("marks"), active.alias("active"))


@query("SELECT c_nationkey, max(strftime(o_orderdate, '%Y-%m-%d')) FILTER (o_orderkey % 5 <> 0) AS latest FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey")
def latest_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest valid day of each nation; every fifth text is none or lies ahead."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    shown = F.when(F.col("o_orderkey") % 10 == 0, "9999-12-31").when(F.col("o_orderkey") % 5 == 0, "2024-13-01").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.groupBy("c_nationkey").agg(latest_day(shown).alias("latest"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber % 5 WHEN 0 THEN l_partkey % 40 + 1 WHEN 1 THEN l_partkey % 40 WHEN 2 THEN l_partkey % 40 WHEN 3 THEN NULL ELSE l_partkey % 40 END AS people,
    CASE l_linenumber % 3 WHEN 0 THEN 1000 WHEN 1 THEN 10000 ELSE 1 END AS scale, CASE WHEN l_linenumber % 2 = 0 THEN 1000 * (l_partkey % 900 + 1) END AS trailing FROM lineitem""")
def head_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People from phrases, with totals before parts and nothing for several numbers; units of headers; amounts behind purposes."""
    n, k = (F.col("l_partkey") % 40).cast("string"), F.col("l_linenumber")
    said = F.when(k % 5 == 0, F.concat(F.lit("부장 외 "), n, F.lit("명"))).when(k % 5 == 1, F.concat(F.lit("직원 3명, 위원 4명 총 "), n, F.lit("명"))).when(k % 5 == 2, F.concat(F.lit("등 "), n, F.lit("인"))).when(k % 5 == 3, F.concat(F.lit("직원 2명, 위원 "), n, F.lit("9명"))).otherwise(F.concat(n, F.lit("명")))
    header = F.when(k % 3 == 0, "집행금액(천원)").when(k % 3 == 1, "금액 (단위: 만원)").otherwise("금액(원)")
    purpose = F.when(k % 2 == 0, F.concat(F.lit("간담회 식비 "), F.format_number(F.lit(1000) * (F.col("l_partkey") % 900 + 1), 0), F.lit("원"))).otherwise("간담회 3명")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(k % 5 == 0, head_count(said)).otherwise(head_total(said)).cast("long").alias("people"), scale_word(header).alias("scale"), currency_in_text(purpose).alias("trailing"))
