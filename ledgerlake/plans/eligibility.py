"""Registered queries of cohorts' thresholds, valid transactions, candidates with counters, priorities and release checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.numbers import score, score_sql, share
from ledgerlake.operators import eligibility as E
from ledgerlake.operators.rollups import candidates
from ledgerlake.operators.ranking import top_k
from ledgerlake.plans.registry import MEASURES, TX, query, table, transactions

_SCORED = ["central", "gyeonggi", "incheon", "justice", "enterprise", "legislator"]
_USED = {"weight": "senior_weight", "senior": "high_share", "high": "high_share", "departments": "departments", "members": "members"}
_WEIGHT = "CASE tier WHEN 1 THEN 1.0 WHEN 2 THEN 0.9 WHEN 3 THEN 0.65 ELSE 0.3 END"


@query(f"""WITH {TX}, c AS (
        SELECT merchant, origin, {MEASURES}, count(DISTINCT institution) AS departments, count(DISTINCT suppkey % 7) AS members, count(*) FILTER (tier <= 2) AS high_visits, count(*) FILTER (tier = 1) AS head_visits,
            max({_WEIGHT})::DOUBLE AS top_weight, min({_WEIGHT})::DOUBLE AS senior_weight, count(*) FILTER (tier <= 2)::DOUBLE / count(*) AS high_share, count(*) FILTER (cohort = 'BUILDING')::DOUBLE / count(*) AS place FROM tx GROUP BY merchant, origin),
    s AS (SELECT *, {', '.join(f'{score_sql(n, _USED)} AS score_{n}' for n in _SCORED)} FROM c)
    SELECT merchant, origin, {', '.join(f'{rule} AS {n}' for n, rule in E.ELIGIBLE.items())} FROM s""")
def cohort_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which cohorts' published thresholds the merchants of a region reach."""
    few = lambda c: F.size(F.collect_set(c)).cast("long")
    weight, tier = F.expr(_WEIGHT).cast("double"), F.col("tier")
    c = candidates(
        transactions(spark, sf_dir), ["merchant", "origin"], departments=few("institution"), members=few(F.col("suppkey") % 7), high_visits=F.count_if(tier <= 2), head_visits=F.count_if(tier == 1),
        top_weight=F.max(weight), senior_weight=F.min(weight), high_share=share(F.count_if(tier <= 2), F.count("*")), place=share(F.count_if(F.col("cohort") == "BUILDING"), F.count("*")),
    )
    c = c.select("*", *(score(n, _USED).alias(f"score_{n}") for n in _SCORED))
    return c.select("merchant", "origin", *(E.eligible(n).alias(n) for n in E.ELIGIBLE))


_HOST = "CASE page_id % 5 WHEN 0 THEN 'https://a.go.kr/x' WHEN 1 THEN 'http://www.go.kr:80/' WHEN 2 THEN 'https://ago.kr/y' WHEN 3 THEN NULL ELSE url END"


@query(f"""WITH r AS (SELECT page_id, {_HOST} AS link, CASE page_id % 7 WHEN 0 THEN '1999-12-31' WHEN 1 THEN '2026-02-30' WHEN 2 THEN '2300-01-01' ELSE '2024-0' || (page_id % 9 + 1) || '-15' END AS day, page_id % 11 - 1 AS amount,
        CASE page_id % 13 WHEN 0 THEN '카드' WHEN 1 THEN ' ' WHEN 2 THEN NULL ELSE url END AS merchant, CASE page_id % 3 WHEN 0 THEN 'guess' ELSE 'posting_title' END AS source FROM pages)
    SELECT page_id, coalesce(try_cast(day AS DATE) BETWEEN DATE '2000-01-01' AND DATE '2026-12-31' AND amount > 0 AND link IN ('https://a.go.kr/x', 'http://www.go.kr:80/') AND trim(merchant) NOT IN ('', '카드') AND source = 'posting_title', false) AS valid,
        regexp_matches(day, '^2024-0[3-5]') AS in_months FROM r""")
def valid_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as transactions: date, amount, merchant, host and role's source in one predicate, and a range of months."""
    i, url = F.col("page_id"), F.col("url")
    link = F.when(i % 5 == 0, "https://a.go.kr/x").when(i % 5 == 1, "http://www.go.kr:80/").when(i % 5 == 2, "https://ago.kr/y").when(i % 5 == 4, url)
    day = F.when(i % 7 == 0, "1999-12-31").when(i % 7 == 1, "2026-02-30").when(i % 7 == 2, "2300-01-01").otherwise(F.concat(F.lit("2024-0"), (i % 9 + 1).cast("string"), F.lit("-15")))
    merchant = F.when(i % 13 == 0, "카드").when(i % 13 == 1, " ").when(i % 13 != 2, url)
    valid = E.valid_transaction(day, i % 11 - 1, link, merchant, F.lit("의장"), F.when(i % 3 == 0, "guess").otherwise("posting_title"), ["go.kr"], F.lit("2026-06-01").cast("date"))
    return table(spark, sf_dir, "pages").select("page_id", valid.alias("valid"), E.in_months(day, (2024, 3), (2024, 5)).alias("in_months"))


def _top(column: str, k: int) -> str:
    return f"""t_{column} AS (SELECT family, origin, string_agg(v || ':' || n, ',' ORDER BY n DESC, v) AS top_{column} FROM (SELECT family, origin, {column} AS v, count(*) AS n FROM w GROUP BY family, origin, {column} QUALIFY row_number() OVER (PARTITION BY family, origin ORDER BY count(*) DESC, {column}) <= {k}) GROUP BY family, origin)"""


@query(f"""WITH {TX}, w AS (SELECT *, CASE WHEN suppkey % 3 = 0 THEN '02-' || suppkey ELSE '' END AS phone FROM tx), {_top('role', 3)}, {_top('institution', 8)},
    m AS (SELECT family, origin, address AS address_mode FROM w GROUP BY family, origin, address QUALIFY row_number() OVER (PARTITION BY family, origin ORDER BY count(*) DESC, address) = 1),
    c AS (SELECT family, origin, count(*) AS visits, count(DISTINCT institution) AS departments, sum(amount)::BIGINT AS spend, min_by(phone, (used_date, orderkey, line, suppkey)) FILTER (phone <> '') AS first_phone FROM w GROUP BY ALL)
    SELECT family, origin, visits, departments, spend, first_phone, address_mode, top_role, top_institution FROM c JOIN m USING (family, origin) JOIN t_role USING (family, origin) JOIN t_institution USING (family, origin)""", name="counted_candidates")
def candidates_with_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families by region: measures, the most frequent address, the first telephone, roles and institutions by frequency."""
    tx = transactions(spark, sf_dir).withColumn("phone", F.when(F.col("suppkey") % 3 == 0, F.concat(F.lit("02-"), F.col("suppkey").cast("string"))).otherwise(""))
    measures = [F.count("*").alias("visits"), F.size(F.collect_set("institution")).cast("long").alias("departments"), F.sum("amount").alias("spend")]
    c = E.counted_candidates(tx, ["family", "origin"], measures, "address", {"role": 3, "institution": 8}, ("phone", ["used_date", "orderkey", "line", "suppkey"]))
    joined = lambda name: F.array_join(F.transform(name, lambda r: F.concat_ws(":", r["value"], r["n"].cast("string"))), ",").alias(name)
    return c.select("family", "origin", "visits", "departments", "spend", "first_phone", "address_mode", joined("top_role"), joined("top_institution"))


_M = """m AS (SELECT merchant, origin, count(*) AS v, count(DISTINCT institution) AS inst, count(DISTINCT cohort) AS orig, count(DISTINCT substr(used_date, 1, 7)) AS mon, sum(amount)::BIGINT AS spend,
    bool_or(address = 'ECONOMY') AS addr, bool_or(suppkey % 5 = 0) AS ev, bool_or(suppkey % 7 = 0) AS links, bool_or(suppkey % 11 = 0) AS basis, count(DISTINCT role) AS roles, count(*) FILTER (evening) AS evening FROM tx GROUP BY ALL)"""


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    few = lambda c: F.size(F.collect_set(c)).cast("long")
    some = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    s = F.col("suppkey")
    return transactions(spark, sf_dir).groupBy("merchant", "origin").agg(
        F.count("*").alias("v"), few("institution").alias("inst"), few("cohort").alias("orig"), few(F.substring("used_date", 1, 7)).alias("mon"), F.sum("amount").alias("spend"), some(F.col("address") == "ECONOMY").alias("addr"),
        some(s % 5 == 0).alias("ev"), some(s % 7 == 0).alias("links"), some(s % 11 == 0).alias("basis"), few("role").alias("roles"), F.count_if("evening").alias("evening"),
    )


_P = "round_even(22::DOUBLE * ln(1::DOUBLE + v) + 14 * least(5, inst - 1) + 18 * least(4, orig - 1) + 3 * least(12, mon) + 2::DOUBLE * ln(1::DOUBLE + spend / 100000::DOUBLE) + CASE WHEN addr THEN 18 ELSE 0 END + CASE WHEN ev THEN 5 ELSE 0 END + CASE WHEN links THEN 5 ELSE 0 END, 2)"
_STATUS = f"CASE WHEN addr AND ev AND basis THEN '{E.GAP_STATUS[0]}' WHEN addr THEN '{E.GAP_STATUS[1]}' WHEN links THEN '{E.GAP_STATUS[2]}' ELSE '{E.GAP_STATUS[3]}' END"


@query(f"""WITH {TX}, {_M}, s AS (SELECT merchant, origin, {_P} AS priority, {_STATUS} AS status, orig, v FROM m), q AS (SELECT * FROM s ORDER BY priority DESC, orig DESC, v DESC, merchant, origin LIMIT 200)
    SELECT 'queue' AS part, row_number() OVER (ORDER BY priority DESC, orig DESC, v DESC, merchant, origin)::BIGINT AS n, merchant, origin, priority, status FROM q
    UNION ALL SELECT 'reasons', count(*), NULL, NULL, NULL, status FROM s GROUP BY status""")
def map_gap_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 200 merchants of a region whose place is to be found first, with what stands against them, and all reasons' counts."""
    c = F.col
    s = _gaps(spark, sf_dir).select("merchant", "origin", E.gap_priority(c("v"), c("inst"), c("orig"), c("mon"), c("spend"), c("addr"), c("ev"), c("links")).alias("priority"), E.gap_status(c("addr"), c("ev"), c("links"), c("basis")).alias("status"), "orig", "v")
    queue = top_k(s, [F.desc("priority"), F.desc("orig"), F.desc("v"), c("merchant"), c("origin")], 200, "n").select(F.lit("queue").alias("part"), c("n").cast("long").alias("n"), "merchant", "origin", "priority", "status")
    none = F.lit(None)
    return queue.unionByName(s.groupBy("status").agg(F.count("*").alias("n")).select(F.lit("reasons").alias("part"), "n", none.cast("string").alias("merchant"), none.cast("string").alias("origin"), none.cast("double").alias("priority"), "status"))


_SIGNAL = {"visits": "v", "months": "mon", "roles": "roles", "evening": "evening", "spend": "spend"}


@query(f"""WITH {TX}, {_M}, s AS (SELECT *, {score_sql('council', _SIGNAL)} AS signal FROM m)
    SELECT merchant, origin, round_even((CASE WHEN NOT addr THEN 40 ELSE 0 END + CASE WHEN NOT ev THEN 10 ELSE 0 END + CASE WHEN NOT links THEN 5 ELSE 0 END + CASE WHEN NOT basis THEN 4 ELSE 0 END) + signal * 0.65::DOUBLE + least(v, 50) * 1.5::DOUBLE + least(inst, 5) * 9, 6) AS priority FROM s""")
def enrichment_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the records of merchants by region lack, weighed with their score and use; engines round halves of binary fractions
    differently, so six digits are kept."""
    c = F.col
    lacks = {"address": ~c("addr"), "category": ~c("ev"), "phone": ~c("links"), "url": ~c("basis")}
    return _gaps(spark, sf_dir).select("merchant", "origin", E.enrichment_priority(lacks, score("council", _SIGNAL), c("v"), c("inst"), digits=6).alias("priority"))


@query("""SELECT p_partkey AS id, p_name AS name, p_brand AS origin FROM part WHERE p_size % 4 <> 0 AND p_brand NOT IN (SELECT p_brand FROM part WHERE p_partkey < 3)
    AND (p_name, p_brand) NOT IN (SELECT p_name, p_brand FROM part WHERE p_size % 4 = 0) QUALIFY row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_partkey) = 1""")
def unblocked_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of a brand that are neither published nor blocked, the first of each."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("origin"), "p_size")
    brands = p.where("id < 3").select("origin").distinct()
    new = p.where("p_size % 4 <> 0").select("id", "name", "origin")
    blocked = new.join(brands, "origin", "left_semi").select("name", F.concat(F.lit(" "), "origin").alias("origin"))
    return E.without_known(new, p.where("p_size % 4 = 0"), blocked, ["name", "origin"], ["id"])


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def merge_without_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping halves of the orders merged; a key with other content would end the job."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return E.merged_or_raised(o.where("o_orderkey % 3 <> 0"), o.where("o_orderkey % 3 <> 1"), "o_orderkey")


@query("""WITH o AS (SELECT c_custkey - c_custkey % 2 AS entity, c_custkey AS k, CASE WHEN c_custkey % 6 < 2 THEN '' ELSE c_mktsegment END AS address FROM customer), n AS (SELECT c_custkey - c_custkey % 6 AS entity, c_custkey AS k FROM customer),
    a AS (SELECT entity, first(address ORDER BY k) AS address FROM o GROUP BY entity), j AS (SELECT DISTINCT n.entity, o.entity AS old, nullif(a.address, '') AS address FROM o JOIN n USING (k) JOIN a ON a.entity = o.entity)
    SELECT entity, count(DISTINCT old) AS previous, count(DISTINCT address) AS addresses FROM j GROUP BY entity HAVING previous > 1 AND addresses > 1""", name="unsafe_merges")
def merges_at_other_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers joined by six where they were pairs; groups whose pairs had different addresses are unsafe."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k.alias("source_key"), F.when(k % 6 < 2, "").otherwise(F.col("c_mktsegment")).alias("address"))
    pair, six = F.col("source_key") - F.col("source_key") % 2, F.col("source_key") - F.col("source_key") % 6
    known = rows.groupBy(pair.alias("entity")).agg(F.min_by("address", "source_key").alias("address"))
    old = rows.select(pair.alias("entity"), "source_key").join(known, "entity")
    return E.unsafe_merges(old, rows.select(six.alias("entity"), "source_key"), F.col("address"))


@query("""WITH a AS (SELECT l_orderkey, l_partkey FROM lineitem), b AS (SELECT l_orderkey, CASE WHEN l_linenumber = 7 THEN -1 ELSE l_partkey END AS l_partkey FROM lineitem)
    SELECT 'same' AS pair, 0::BIGINT AS only_first, 0::BIGINT AS only_second, true AS equal UNION ALL
    SELECT 'changed', (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)), (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)), (SELECT count(*) FROM lineitem WHERE l_linenumber = 7) = 0""")
def snapshot_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines against themselves, and against a copy with other parts in the seventh lines."""
    a = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    b = a.withColumn("l_partkey", F.when(F.col("l_linenumber") == 7, -1).otherwise(F.col("l_partkey")))
    two = lambda x, y, name: E.snapshots_equal(x.drop("l_linenumber"), y.drop("l_linenumber")).select(F.lit(name).alias("pair"), "only_first", "only_second", "equal")
    return two(a, a, "same").unionByName(two(a, b, "changed"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'a,b' WHEN c_custkey % 3 = 1 THEN c_mktsegment ELSE '' END AS origins, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_name END AS name,
    CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_nationkey END::BIGINT AS visits, CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE c_acctbal END AS score FROM customer""")
def compact_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as records of a report, with missing lists, texts and numbers filled."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        k, F.when(k % 3 == 0, F.array(F.lit("a"), F.lit("b"))).when(k % 3 == 1, F.array().cast("array<string>")).alias("origins"), F.when(k % 3 == 1, F.col("c_mktsegment")).otherwise(" ").alias("origin"),
        F.when(k % 4 != 0, F.concat(F.lit(" "), "c_name")).alias("name"), F.when(k % 5 != 0, F.col("c_nationkey")).alias("visits"), F.when(k % 7 != 0, F.col("c_acctbal")).alias("score"),
    )
    return rows.select("c_custkey", *E.compact_record({"origins": "origin"}, ["name"], ["visits"], ["score"])).withColumn("origins", F.array_join("origins", ","))


@query("""SELECT s_suppkey, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey)::INT AS rank FROM supplier WHERE s_acctbal > 0 QUALIFY rank <= 80""")
def approved_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 80 suppliers with the highest balance above nothing; fewer than five would be no release."""
    return E.approved(table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"), F.col("s_acctbal") > 0, [F.desc("s_acctbal"), F.col("s_suppkey")], least=5).select("s_suppkey", "rank")
