"""Text, number, date and URL functions, and grids, applied to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.numbers import date_quality, head_count, period_bounds, period_overlaps, repair_date, serial_date, title_period, to_amount, to_date
from ledgerlake.functions.similarity import compatibility_form
from ledgerlake.functions.text import canonical_address, family_name, first_label, html_safe, ladder, locality, split_place, text
from ledgerlake.functions.web import attachment_url, host, trusted
from ledgerlake.operators.filters import plausible, reason_counts, with_reason
from ledgerlake.operators.grids import control_totals, find_headers, scaled_by_median, unpivot_positive
from ledgerlake.plans.registry import TX, query, table, transactions

_BRAND = "CAST(substr(p_brand, 7) AS INT)"


@query(f"""WITH a AS (SELECT p_partkey, '경기도 수원시  ' || p_type || '로 ' || {_BRAND} || CASE WHEN p_size % 2 = 0 THEN '-' || p_size ELSE '' END || ' (' || p_name || ') ' || p_size || '층' AS raw FROM part)
    SELECT p_partkey, regexp_replace(lower('경기 수원시 ' || p_type || '로 ' || {_BRAND} || CASE WHEN p_size % 2 = 0 THEN '-' || p_size ELSE '' END), '[^0-9a-z가-힣]', '', 'g') AS building, '수원시' AS place FROM a JOIN part USING (p_partkey)""")
def address_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Building keys and localities of addresses made from parts."""
    p = table(spark, sf_dir, "part")
    raw = F.concat(F.lit("경기도 수원시  "), "p_type", F.lit("로 "), F.substring("p_brand", 7, 9), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("-"), "p_size")).otherwise(""), F.lit(" ("), "p_name", F.lit(") "), "p_size", F.lit("층"))
    return p.select("p_partkey", canonical_address(raw).alias("building"), locality(F.lit(None), raw, F.lit(None)).alias("place"))


@query("""SELECT p_partkey, replace(lower(p_name), ' ', '') AS family, replace(lower(p_name), ' ', '') || CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN '3호점' ELSE '마포점' END AS bare
    FROM part""", name="family_name")
def family_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Family names of merchants with company prefixes and branch endings, and names with the endings kept."""
    p, k = table(spark, sf_dir, "part"), F.col("p_size") % 3
    ending = F.when(k == 0, "").when(k == 1, "3호점").otherwise("마포점")
    raw = F.concat(F.when(F.col("p_size") % 2 == 0, "주식회사 ").otherwise("(주)"), F.upper("p_name"), F.when(k == 0, "(본점)").otherwise(ending))
    return p.select("p_partkey", family_name(raw).alias("family"), family_name(F.concat("p_name", ending), []).alias("bare"))


@query(r"""SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '%URGENT%' THEN 'top' WHEN o_orderpriority LIKE '%HIGH%' THEN 'high' WHEN o_orderpriority LIKE '%MEDIUM%' THEN 'middle' ELSE 'other' END AS tier,
    CASE WHEN o_orderpriority LIKE '%E%' THEN 'has_e' WHEN o_orderpriority LIKE '%URGENT%' THEN 'top' ELSE 'other' END AS other_order FROM orders""")
def tier_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ladders whose rules overlap, tested in different orders."""
    p = F.col("o_orderpriority")
    has = lambda w: F.contains(p, F.lit(w))
    return table(spark, sf_dir, "orders").select("o_orderkey", ladder([(has("URGENT"), "top"), (has("HIGH"), "high"), (has("MEDIUM"), "middle")], "other").alias("tier"), ladder([(has("E"), "has_e"), (has("URGENT"), "top")], "other").alias("other_order"))


_CATEGORY = [(["ring", "bolt"], "metal"), (["widget", "gear", "gadget"], "machine"), (["red", "blue"], "coloured"), (["small", "large"], "sized")]
_CATEGORY_SQL = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(p_name, '{w}')" for w in words) + f" THEN '{label}'" for words, label in _CATEGORY) + " ELSE 'unknown' END"


@query(f"SELECT p_partkey, {_CATEGORY_SQL} AS category FROM part")
def category_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", first_label(F.col("p_name"), _CATEGORY, "unknown").alias("category"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(round_even(l_extendedprice, 0) AS BIGINT) AS amount, NULL::BIGINT AS none FROM lineitem")
def amount_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts from texts with thousands separators and a currency sign, and from a text without a number."""
    shown = F.concat(F.lit("₩ "), F.format_number("l_extendedprice", 2), F.lit(" 원"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", to_amount(shown).alias("amount"), to_amount(F.lit("미정")).alias("none"))


@query("""WITH a AS (SELECT s_suppkey, s_nationkey, CAST(round_even(abs(s_acctbal), 0) AS BIGINT) AS amount FROM supplier), m AS (SELECT s_nationkey, median(amount) AS m, count(*) AS n FROM a GROUP BY 1)
    SELECT s_suppkey, s_nationkey, amount * CASE WHEN m < 5000 AND n >= 3 THEN 1000 ELSE 1 END AS amount, CASE WHEN m < 5000 AND n >= 3 THEN 1000 ELSE 1 END AS scale FROM a JOIN m USING (s_nationkey)""")
def unit_scale_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", F.bround(F.abs("s_acctbal")).cast("bigint").alias("amount"))
    return scaled_by_median(s, ["s_nationkey"], "amount")


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_size + 1 WHEN p_size % 3 = 1 THEN p_size END AS people FROM part")
def headcount_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, n = table(spark, sf_dir, "part"), F.col("p_size").cast("string")
    said = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("부장 외 "), n, F.lit("명"))).when(F.col("p_size") % 3 == 1, F.concat(F.lit("직원 등 "), n, F.lit("인"))).otherwise("관계자")
    return p.select("p_partkey", head_count(said).alias("people"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 6 THEN NULL ELSE strftime(o_orderdate + INTERVAL 10 YEAR, '%Y-%m-%d') END AS day FROM orders")
def date_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates, ten years on, in six layouts and one that is none."""
    o = table(spark, sf_dir, "orders")
    d, k = F.add_months("o_orderdate", 120), F.col("o_orderkey") % 7
    shown = ladder([(k == i, F.date_format(d, f)) for i, f in enumerate(["yyyy-MM-dd", "yyyyMMdd", "yyyy-MMdd", "yyyyMM-dd", "yyyy.M.d.", "yy/MM/dd HH:mm"])], "2000-13-40")
    return o.select("o_orderkey", F.date_format(to_date(shown), "yyyy-MM-dd").alias("day"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%d') AS repaired FROM orders")
def excel_serial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates from serial numbers, and from texts without year completed by their period."""
    d = F.col("o_orderdate").cast("date")
    n = F.date_diff(d, F.lit("1899-12-30").cast("date"))
    shown = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.month(d), F.lit("월 "), F.dayofmonth(d), F.lit("일"))).otherwise(F.concat(F.dayofmonth(d), F.lit("일")))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(serial_date(n), "yyyy-MM-dd").alias("day"), F.date_format(repair_date(shown, F.year(d), F.month(d)), "yyyy-MM-dd").alias("repaired"))


@query(f"""WITH {TX}, q AS (SELECT orderkey, line, partkey, suppkey, used_date, date_trunc('quarter', order_date::DATE)::DATE AS lo FROM tx)
    SELECT orderkey, line, partkey, suppkey, CASE WHEN used_date::DATE BETWEEN lo AND (lo + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE THEN 'in_period' ELSE 'valid_outside_period' END AS date_quality FROM q""")
def period_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of use against the quarter of the order."""
    tx = transactions(spark, sf_dir)
    d = to_date_column("order_date")
    return tx.select("orderkey", "line", "partkey", "suppkey", date_quality(to_date_column("used_date"), period_bounds(F.year(d), F.lit(None).cast("int"), F.quarter(d))).alias("date_quality"))


def to_date_column(name: str) -> F.Column:
    return F.col(name).cast("date")


@query("""WITH p AS (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, quarter(o_orderdate) AS q FROM orders)
    SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN m END AS m, CASE WHEN o_orderkey % 2 = 1 THEN q END AS q,
    NOT (CASE WHEN o_orderkey % 2 = 0 THEN y * 100 + m ELSE y * 100 + q * 3 END < 199703 OR CASE WHEN o_orderkey % 2 = 0 THEN y * 100 + m ELSE y * 100 + q * 3 - 2 END > 199908) AS overlaps FROM p""", name="period_overlap")
def overlapping_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months and quarters against March 1997 to August 1999."""
    d, even = F.col("o_orderdate"), F.col("o_orderkey") % 2 == 0
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.year(d).alias("y"), F.when(even, F.month(d)).alias("m"), F.when(~even, F.quarter(d)).alias("q"))
    return o.select("o_orderkey", "m", "q", period_overlaps(F.col("y"), F.col("m"), F.col("q"), 199703, 199908).alias("overlaps"))


@query("SELECT o_orderkey, year(o_orderdate) + 10 AS y, CASE WHEN o_orderkey % 2 = 0 THEN month(o_orderdate) END AS m, CASE WHEN o_orderkey % 2 = 1 THEN quarter(o_orderdate) END AS q FROM orders", name="title_period")
def title_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods from posting titles, ten years on, in six layouts; one has a year of two digits."""
    d, k = F.add_months("o_orderdate", 120), F.col("o_orderkey") % 8
    y, m, q = F.year(d), F.month(d), F.quarter(d)
    j = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    title = ladder([(k == 0, j(y, "년 ", m, "월 업무추진비")), (k.isin(2, 4), j(y, ".", m, "월 내역")), (k == 1, j(y, "년 의회 내역(", q, "/4분기)")), (k == 3, j(F.right(y.cast("string"), F.lit(2)), "년 ", q, "분기")), (k == 5, j(y, "년도 ", q, "분기 공개"))], F.when(k == 6, j("공개 ", y, "-", m, "월")).otherwise(j(y, " ", q, "/4분기")))
    return table(spark, sf_dir, "orders").select("o_orderkey", title_period(title).alias("p")).select("o_orderkey", "p.*")


@query("SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN '서울 ' || c_nationkey ELSE '' END AS address FROM customer")
def place_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with an address in brackets."""
    c = table(spark, sf_dir, "customer")
    raw = F.when(F.col("c_custkey") % 2 == 0, F.concat("c_name", F.lit(" (서울 "), "c_nationkey", F.lit(")"))).otherwise(F.col("c_name"))
    return c.select("c_custkey", split_place(raw).alias("p")).select("c_custkey", "p.*")


@query(r"""WITH u AS (SELECT page_id, url, regexp_extract(url, '^([^?#]*)', 1) AS base, regexp_extract(url, '\?([^#]*)', 1) AS q FROM pages)
    SELECT page_id, base || CASE WHEN regexp_matches(q, '=.') THEN '?' || array_to_string(list_sort(list_filter(string_split(q, '&'), lambda x: regexp_matches(x, '=.'))), '&') ELSE '' END AS canonical FROM u""")
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses with sorted queries and no fragment."""
    return table(spark, sf_dir, "pages").select("page_id", attachment_url(F.col("url"), any_path=True).alias("canonical"))


@query(r"""WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS host FROM pages)
    SELECT page_id, host, host = 'example.com' OR host LIKE '%.example.com' OR host = 'example.net' OR host LIKE '%.example.net' AS trusted FROM h""")
def host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", host(F.col("url")).alias("host"), trusted(F.col("url"), ["example.com", "example.net"]).alias("trusted"))


@query("""SELECT event_type, sum((props->>'$.k')::BIGINT)::BIGINT AS total, max((props->>'$.k')::BIGINT) AS largest, count(*) AS n FROM events GROUP BY event_type""")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.from_json("props", "k long")["k"]
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(k).alias("total"), F.max(k).alias("largest"), F.count("*").alias("n"))


@query("SELECT page_id, replace(replace(replace(url, '&', chr(92) || 'u0026'), '<', chr(92) || 'u003c'), '>', chr(92) || 'u003e') AS safe FROM pages")
def inline_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses as they can stand inside a script element."""
    return table(spark, sf_dir, "pages").select("page_id", html_safe(F.col("url")).alias("safe"))


@query(r"""SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages""")
def page_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of all anchors of the pages, once for each anchor."""
    return table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))).alias("href"))


@query("SELECT doc_id, length(trim(regexp_replace(coalesce(text, ''), '[\\s\\x{0B}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', ' ', 'g'))) AS n FROM documents")
def whitespace_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of cleaned texts, whose blanks were made wide ones before."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.length(text(F.replace("text", F.lit(" "), F.lit("\u3000")))).cast("long").alias("n"))


@query("SELECT p_partkey, actor, n FROM (UNPIVOT (SELECT p_partkey, p_size % 4 AS chair, p_size % 3 AS deputy, p_size % 2 AS member FROM part) ON chair, deputy, member INTO NAME actor VALUE n) WHERE n > 0")
def unpivot_actors(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("p_size")
    return unpivot_positive(table(spark, sf_dir, "part").select("p_partkey", (s % 4).alias("chair"), (s % 3).alias("deputy"), (s % 2).alias("member")), ["p_partkey"], ["chair", "deputy", "member"], "actor", "n")


@query("""SELECT s_nationkey AS sheet, CASE WHEN s_nationkey % 3 = 2 THEN 1 ELSE s_nationkey % 3 END::INT AS idx, CASE WHEN s_nationkey % 3 = 2 THEN 2 ELSE 1 END AS span, CASE WHEN s_nationkey % 3 = 2 THEN 9 ELSE 10 END AS score FROM (SELECT DISTINCT s_nationkey FROM supplier)""", name="header_score")
def detected_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers found in one sheet for each nation: in the first line, the second, or split over the second and third."""
    one = [["제목 없음"], ["연번", "사용일자", "집행목적", "집행장소", "대상인원", "집행금액"], ["1", "2024-01-05", "간담회", "가나식당", "3", "45,000"]]
    split_ = [["제목 없음"], ["사", "집", "사", "금"], ["용일자", "행목적", "용처", "액"], ["2024-01-05", "간담회", "가나식당", "45,000"]]
    grid = lambda g: F.array(*(F.array(*map(F.lit, line)) for line in g))
    k = F.col("s_nationkey") % 3
    sheets = table(spark, sf_dir, "supplier").select("s_nationkey").distinct().select(F.col("s_nationkey").alias("sheet"), F.posexplode(F.when(k == 0, grid(one[1:])).when(k == 1, grid(one)).otherwise(grid(split_))).alias("idx", "cells"))
    return find_headers(sheets, ["sheet"]).select("sheet", "idx", "span", "score")


@query("""WITH l AS (SELECT l_orderkey, count(*) AS n, sum(CAST(round_even(l_extendedprice, 0) AS BIGINT))::BIGINT AS total FROM lineitem GROUP BY 1),
    o AS (SELECT o_orderkey, 4 AS printed_n, CAST(round_even(o_totalprice, 0) AS BIGINT) AS printed_total FROM orders)
    SELECT coalesce(l_orderkey, o_orderkey) AS o_orderkey, n, total, printed_n, printed_total, coalesce(n = printed_n AND total = printed_total, false) AS ok FROM l FULL JOIN o ON l_orderkey = o_orderkey""", name="control_totals")
def order_control_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.bround("l_extendedprice").cast("bigint").alias("amount"))
    totals = table(spark, sf_dir, "orders").select("o_orderkey", F.lit(4).alias("printed_n"), F.bround("o_totalprice").cast("bigint").alias("printed_total"))
    return control_totals(rows, totals, ["o_orderkey"], "amount")


_REASONS = "CASE WHEN amount <= 0 THEN 'no_amount' WHEN amount > 0 AND people >= 2 AND amount::DOUBLE / people < 1000 THEN 'implausible' WHEN contains(merchant, 'ring') THEN 'blocked_word' WHEN tier = 5 THEN 'low_role' WHEN used_date < '1996' THEN 'too_old' END"


@query(f"WITH {TX} SELECT coalesce({_REASONS}, 'KEPT') AS reason, count(*) AS n FROM tx GROUP BY 1")
def reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows each first failing rule rejects, and how many are kept."""
    rules = [("no_amount", F.col("amount") <= 0), ("implausible", ~plausible(F.col("amount"), F.col("people"))), ("blocked_word", F.contains("merchant", F.lit("ring"))), ("low_role", F.col("tier") == 5), ("too_old", F.col("used_date") < "1996")]
    return reason_counts(with_reason(transactions(spark, sf_dir), rules))


@query(f"WITH {TX} SELECT orderkey, line, partkey, suppkey, NOT (amount > 0 AND people >= 2 AND amount::DOUBLE / people < 1000) AS plausible FROM tx", name="plausibility")
def plausible_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).select("orderkey", "line", "partkey", "suppkey", plausible(F.col("amount"), F.col("people")).alias("plausible"))


@query()
def compatibility_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in lower-cased Unicode compatibility form; SQL has no such function."""
    return table(spark, sf_dir, "customer").select("c_custkey", compatibility_form(F.translate("c_name", "0123456789", "０１２３４５６７８９")).alias("name"))


@query("""WITH u AS (SELECT page_id, 'https://' || split_part(split_part(url, '://', 2), '/', 1) AS site, CASE page_id % 6 WHEN 0 THEN '/a.PDF' WHEN 1 THEN '/bbs/fileDown.do' WHEN 2 THEN '/page' WHEN 3 THEN '/x/attach' WHEN 4 THEN '/bbsAttachDownload.do' ELSE '/s/download/list.js' END AS path, page_id % 4 AS q FROM pages)
    SELECT page_id, CASE WHEN path IN ('/a.PDF', '/bbs/fileDown.do') OR (path = '/bbsAttachDownload.do' AND q <> 3) THEN site || path || CASE WHEN q = 3 THEN '' ELSE '?a=1&b=' || q END END AS canonical FROM u""")
def attachment_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of files on the pages' hosts, by endings and words of downloads; pages, scripts and bare routes are none."""
    i = F.col("page_id")
    site = F.concat(F.lit("https://"), F.substring_index(F.substring_index("url", "://", -1), "/", 1))
    path = F.when(i % 6 == 0, "/a.PDF").when(i % 6 == 1, "/bbs/fileDown.do").when(i % 6 == 2, "/page").when(i % 6 == 3, "/x/attach").when(i % 6 == 4, "/bbsAttachDownload.do").otherwise("/s/download/list.js")
    asked = F.when(i % 4 == 3, "?x#top").otherwise(F.concat(F.lit("?b="), (i % 4).cast("string"), F.lit("&amp;a=1&c=#top")))
    return table(spark, sf_dir, "pages").select("page_id", attachment_url(F.concat(site, path, asked)).alias("canonical"))
