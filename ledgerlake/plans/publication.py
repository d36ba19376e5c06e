"""The path from candidates to publication, and the guards over snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.numbers import score, score_sql
from ledgerlake.functions.rules import TIER_ORDER
from ledgerlake.functions.web import attachment_url
from ledgerlake.operators.filters import plausible
from ledgerlake.operators.publication import (
    approved_in_order, by_origin, chosen_rows, corroborated, enriched_addresses, first_attachments, incremental_verdict, integrity, key_sets, merged_profiles, merged_signals,
    named_best, regional_gate, review_queue, union_of_tops, upsert_fields,
)
from ledgerlake.operators.rollups import candidates
from ledgerlake.plans.registry import MEASURES, PLAUSIBLE, TX, query, table, transactions, written
from ledgerlake.storage import materialize

_C = f"c AS (SELECT merchant, {MEASURES} FROM tx WHERE {PLAUSIBLE} GROUP BY merchant), s AS (SELECT *, {score_sql('council')} AS score FROM c)"


def _scored(tx: DataFrame, by: list[str]) -> DataFrame:
    return candidates(tx.where(plausible(F.col("amount"), F.col("people"))), by).withColumn("score", score("council"))


@query(f"""WITH {TX}, {_C}, top AS (SELECT merchant FROM s WHERE visits >= 3 AND months >= 2 AND score >= 50 QUALIFY row_number() OVER (ORDER BY score DESC, visits DESC, merchant) <= 80)
    SELECT merchant, count(*) AS rows, sum(amount)::BIGINT AS spend, count(*) FILTER (evening) AS evening FROM tx WHERE merchant IN (SELECT merchant FROM top) AND tier <= 3 AND {PLAUSIBLE} GROUP BY merchant""")
@written
def rows_of_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of the 80 best candidates, of leaders only."""
    tx = materialize(transactions(spark, sf_dir), "tx")
    top = _scored(tx, ["merchant"]).where("visits >= 3 AND months >= 2 AND score >= 50").orderBy(F.desc("score"), F.desc("visits"), "merchant").limit(80)
    rows = chosen_rows(tx, top, "merchant", (F.col("tier") <= 3) & plausible(F.col("amount"), F.col("people")))
    return rows.groupBy("merchant").agg(F.count("*").alias("rows"), F.sum("amount").alias("spend"), F.count_if("evening").alias("evening"))


_OTHER = f"x AS (SELECT cohort AS source, institution AS region, origin, family, {MEASURES} FROM tx WHERE {PLAUSIBLE} GROUP BY ALL), y AS (SELECT *, {score_sql('council')} AS score FROM x)"
_SPEC = "CASE source WHEN 'BUILDING' THEN 4 WHEN 'MACHINERY' THEN 6 ELSE 5 END"


@query(f"""WITH {TX}, {_OTHER}, r AS (SELECT institution AS region, origin AS place, family, count(*) AS visits, count(DISTINCT substr(used_date, 1, 7)) AS months, count(*) FILTER (tier = 1) AS heads, min(CASE WHEN address LIKE 'ECONOMY%' THEN address END) AS address FROM tx GROUP BY ALL),
    f AS (SELECT region, origin AS place, family, count(DISTINCT source) AS confirmed FROM y WHERE visits >= {_SPEC} AND months >= 2 AND score >= 40 AND length(family) >= 4 GROUP BY ALL)
    SELECT region, place, family, visits, coalesce(confirmed, 0) AS confirmed, (visits >= 3 AND months >= 2 AND (coalesce(address, '') <> '' OR (region < 'K' AND heads >= 3))) OR (region < 'K' AND visits >= 2 AND months >= 2 AND heads >= 2 AND coalesce(confirmed, 0) > 0) AS passes FROM r LEFT JOIN f USING (region, place, family)""")
@written
def corroborated_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regional records that pass by themselves or because other sources confirm them."""
    tx = materialize(transactions(spark, sf_dir), "tx")
    others = _scored(tx.withColumn("source", F.col("cohort")).withColumn("region", F.col("institution")), ["source", "region", "origin", "family"])
    specs = tx.select(F.col("cohort").alias("source")).distinct().select("source", F.when(F.col("source") == "BUILDING", 4).when(F.col("source") == "MACHINERY", 6).otherwise(5).alias("min_visits"), F.lit(2).alias("min_months"), F.lit(40.0).alias("min_score"))
    r = tx.groupBy(F.col("institution").alias("region"), F.col("origin").alias("place"), "family").agg(
        F.count("*").alias("visits"), F.count_distinct(F.substring("used_date", 1, 7)).alias("months"), F.count_if(F.col("tier") == 1).alias("heads"), F.min(F.when(F.startswith("address", F.lit("ECONOMY")), F.col("address"))).alias("address")
    )
    out = corroborated(r, others.select("source", "region", "origin", "family", "visits", "months", "score"), specs)
    return out.select("region", "place", "family", "visits", "confirmed", regional_gate(F.col("confirmed"), F.col("visits"), F.col("months"), F.lit(60.0), F.col("heads"), F.col("address"), F.col("region") < "K").alias("passes"))


@query(f"""WITH {TX}, c AS (SELECT merchant, address, count(*) AS visits, count(DISTINCT substr(used_date, 1, 7)) AS months, count(DISTINCT institution) AS departments FROM tx GROUP BY ALL) SELECT * FROM c WHERE address <> '' AND visits >= 5 AND months >= 3 AND departments >= 3""")
def city_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The city's candidates: an address, five visits, three months, three departments."""
    few = lambda c: F.size(F.collect_set(c)).cast("long")
    c = transactions(spark, sf_dir).groupBy("merchant", "address").agg(F.count("*").alias("visits"), few(F.substring("used_date", 1, 7)).alias("months"), few("institution").alias("departments"))
    return c.where("address <> '' AND visits >= 5 AND months >= 3 AND departments >= 3")


_ELIGIBLE = {
    "central": "visits >= 2 AND months >= 2 AND score_central >= 35", "gyeonggi": "visits >= 3 AND departments >= 2 AND months >= 2 AND score_gyeonggi >= 35", "incheon": "visits >= 3 AND months >= 2 AND score_incheon >= 45",
    "justice": "visits >= 2 AND months >= 1 AND score_justice >= 40", "enterprise": "visits >= 1 AND score_enterprise >= 35", "legislator": "visits >= 3 AND members >= 2 AND months >= 2 AND score_legislator >= 35", "seoul_executive": "visits >= 3 AND months >= 2 AND departments >= 2 AND score_seoul_executive >= 30",
}
_USED = {"departments": "institutions", "members": "institutions", "weight": "high", "senior": "high"}


@query(f"""WITH {TX}, c AS (SELECT merchant, {MEASURES}, count(*) FILTER (tier <= 2)::DOUBLE / count(*) AS high FROM tx GROUP BY merchant),
    s AS (SELECT *, institutions AS departments, institutions AS members, {', '.join(f'{score_sql(n, _USED)} AS score_{n}' for n in _ELIGIBLE)} FROM c) SELECT merchant, {', '.join(f'{rule} AS {n}' for n, rule in _ELIGIBLE.items())} FROM s""")
def cohort_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which cohorts' thresholds merchants reach; the thresholds are stand-ins of the same shape."""
    from ledgerlake.functions.numbers import share

    c = candidates(transactions(spark, sf_dir), ["merchant"], high=share(F.count_if(F.col("tier") <= 2), F.count("*"))).withColumn("departments", F.col("institutions")).withColumn("members", F.col("institutions"))
    for n in _ELIGIBLE:
        c = c.withColumn(f"score_{n}", score(n, _USED))
    return c.select("merchant", *(F.expr(rule).alias(n) for n, rule in _ELIGIBLE.items()))


_ROW = "orderkey || ':' || line || ':' || partkey || ':' || suppkey"


@query(f"""WITH {TX}, t AS (SELECT *, {_ROW} AS row, cohort || ' ' || address AS purpose FROM tx), b AS (SELECT family, count(*) AS visits, sum(amount)::BIGINT AS spend, sum(people)::BIGINT AS people, min(used_date) AS date_min, max(used_date) AS date_max, count(DISTINCT row) AS source_rows FROM t GROUP BY family),
    r AS (SELECT family, role, count(*) AS v, sum(amount)::BIGINT AS s FROM t GROUP BY ALL), rr AS (SELECT family, string_agg(role || ':' || v || ':' || s, ',' ORDER BY v DESC, s DESC, role) AS roles FROM r GROUP BY family),
    pn AS (SELECT family, purpose, count(*) AS n FROM t GROUP BY ALL), p AS (SELECT * FROM pn QUALIFY row_number() OVER (PARTITION BY family ORDER BY n DESC, purpose) <= 8), pp AS (SELECT family, string_agg(purpose || ':' || n, ',' ORDER BY n DESC, purpose) AS purposes FROM p GROUP BY family),
    l AS (SELECT family, used_date, role, amount, row, hour FROM t QUALIFY row_number() OVER (PARTITION BY family ORDER BY used_date DESC, hour DESC, row DESC) <= 16), ll AS (SELECT family, string_agg(used_date || ':' || role || ':' || amount, ',' ORDER BY used_date DESC, hour DESC, row DESC) AS recent FROM l GROUP BY family)
    SELECT *, CAST(round_even(spend / people::DOUBLE, 0) AS BIGINT) AS per_head FROM b JOIN rr USING (family) JOIN pp USING (family) JOIN ll USING (family)""")
@written
def evidence_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full evidence of families: roles, purposes, the latest sixteen events, source rows."""
    tx = transactions(spark, sf_dir).withColumn("row", F.concat_ws(":", "orderkey", "line", "partkey", "suppkey")).withColumn("purpose", F.concat_ws(" ", "cohort", "address"))
    out = merged_profiles(materialize(tx, "tx"), ["family"], "family", [F.desc("used_date"), F.desc("hour"), F.desc("row")])
    flat = lambda c, *f: F.array_join(F.transform(c, lambda s: F.concat_ws(":", *(s[x] for x in f))), ",")
    return out.withColumn("roles", flat("roles", "role", "visits", "spend")).withColumn("purposes", flat("purposes", "text", "count")).withColumn("recent", flat("recent", "used_date", "role", "amount"))


_TIERS = "[" + ", ".join(f"'{t}'" for t in TIER_ORDER) + "]"


@query(f"""WITH {TX}, r AS (SELECT family, origin, {_TIERS}[CAST(8 - min(tier) AS INT)] AS tier_name, count(*) AS visits, count(*) FILTER (tier = 1) AS top_official_visits, count(*) + sum(people)::BIGINT AS score FROM tx GROUP BY family, origin)
    SELECT family, max(score) AS score, arg_min(origin, (-score, origin)) AS origin, arg_max(tier_name, list_position({_TIERS}, tier_name)) AS top_tier, sum(visits)::BIGINT AS visits, sum(top_official_visits)::BIGINT AS top_official_visits FROM r GROUP BY family""")
def strongest_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best signal of each family with summed counters and the strongest tier of any."""
    tiers = F.array(*map(F.lit, TIER_ORDER))
    r = transactions(spark, sf_dir).groupBy("family", "origin").agg(F.element_at(tiers, 8 - F.min("tier")).alias("tier_name"), F.count("*").alias("visits"), F.count_if(F.col("tier") == 1).alias("top_official_visits"), (F.count("*") + F.sum("people")).alias("score"))
    return merged_signals(r, ["family"], ["visits", "top_official_visits"], ["origin"])


@query(f"WITH {TX}, r AS (SELECT family, origin, branch, count(*) AS v, sum(amount)::BIGINT AS s FROM tx GROUP BY ALL), o AS (SELECT family, origin, sum(v)::BIGINT AS v, sum(s)::BIGINT AS s, count(*) AS n FROM r GROUP BY ALL) SELECT family, string_agg(origin || ':' || v || ':' || s || ':' || n, ',' ORDER BY origin) AS origins FROM o GROUP BY family", name="by_origin")
def family_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = transactions(spark, sf_dir).groupBy("family", "origin", "branch").agg(F.count("*").alias("visits"), F.sum("amount").alias("spend"))
    return by_origin(r, "family").select("family", F.array_join(F.transform("by_origin", lambda s: F.concat_ws(":", s["origin"], s["visits"], s["spend"], s["records"])), ",").alias("origins"))


@query("""WITH k AS (SELECT p_name AS name, p_type || ' 1' AS address, p_partkey AS id FROM part WHERE p_size > 20), kn AS (SELECT name, address, count(*) AS n, min(id) AS id FROM k GROUP BY ALL), u AS (SELECT name, address FROM kn QUALIFY row_number() OVER (PARTITION BY name ORDER BY n DESC, id, address) = 1)
    SELECT p_partkey, coalesce(CASE WHEN p_size % 3 = 0 THEN p_type END, u.address, '') AS address, p_size % 3 <> 0 AND u.address IS NOT NULL AS enriched FROM part LEFT JOIN u ON p_name = u.name""")
def address_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without address get their name's most common one."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", F.col("p_name").alias("name"), "p_type")
    known = p.where("p_size > 20").select("name", F.concat("p_type", F.lit(" 1")).alias("address"), F.col("p_partkey").alias("id"))
    return enriched_addresses(p.select("p_partkey", "name", F.when(F.col("p_size") % 3 == 0, F.col("p_type")).otherwise("").alias("address")), known, "name", "address", "id").select("p_partkey", "address", "enriched")


@query("WITH a AS (SELECT doc_id, min(doc_id % 1000) AS place FROM labels WHERE quality = 1 GROUP BY doc_id) SELECT doc_id, place, lang FROM documents JOIN a USING (doc_id)")
def approved_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    approved = table(spark, sf_dir, "labels").where("quality = 1").withColumn("place", F.col("doc_id") % 1000)
    return approved_in_order(table(spark, sf_dir, "documents").select("doc_id", "lang"), approved, "doc_id", "place").select("doc_id", "place", "lang")


@query(f"WITH {TX}, w AS (SELECT merchant, count(DISTINCT origin) AS sources, count(*) AS records FROM tx GROUP BY merchant HAVING count(DISTINCT origin) >= 2) SELECT * FROM w WHERE merchant NOT IN (SELECT merchant FROM tx WHERE people >= 49)")
def unmerged_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of several regions that no merge covers."""
    tx = transactions(spark, sf_dir)
    return review_queue(tx, tx.where("people >= 49"), "merchant", "origin")


@query(f"""WITH {TX}, n AS (SELECT family, address, branch, count(*) AS n, count(*) FILTER (tier <= 3) AS a FROM tx GROUP BY ALL)
    SELECT family, address, arg_max(branch, (n, length(branch), branch)) AS branch, sum(a)::DOUBLE / sum(n) AS address_coverage, count(*) AS variants, sum(n)::BIGINT AS visits FROM n GROUP BY family, address""")
def representative_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name that stands for each family at an address, by count and length."""
    tx = transactions(spark, sf_dir).withColumn("place", F.col("address")).withColumn("address", F.when(F.col("tier") <= 3, F.col("address")).otherwise(""))
    return named_best(tx, ["family", "place"], "branch").withColumnRenamed("place", "address")


@query(f"""WITH {TX}, c AS (SELECT merchant, address, count(*) AS visits, sum(amount)::BIGINT AS spend FROM tx GROUP BY ALL),
    t AS ((SELECT * FROM c ORDER BY visits DESC, spend DESC, merchant, address LIMIT 60) UNION (SELECT * FROM c ORDER BY spend DESC, merchant, address LIMIT 60))
    SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY merchant ORDER BY spend DESC, visits DESC, address) = 1""")
def union_top_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaders by visits and by spend, each name once."""
    c = transactions(spark, sf_dir).groupBy("merchant", "address").agg(F.count("*").alias("visits"), F.sum("amount").alias("spend"))
    tail = [F.col("merchant"), F.col("address")]
    return union_of_tops(c, [([F.desc("visits"), F.desc("spend"), *tail], 60), ([F.desc("spend"), *tail], 60)], ["merchant"], [F.desc("spend"), F.desc("visits"), F.col("address")])


_O, _N = "c_custkey % 7 <> 0", "c_custkey % 5 <> 0"


@query(f"""WITH o AS (SELECT DISTINCT c_custkey AS k, 1 AS o FROM customer WHERE {_O}), n AS (SELECT DISTINCT c_custkey AS k, 1 AS n FROM customer WHERE {_N}), j AS (SELECT * FROM o FULL JOIN n USING (k))
    SELECT count(*) FILTER (o IS NOT NULL AND n IS NOT NULL) AS both, count(*) FILTER (n IS NULL) AS lost, count(*) FILTER (o IS NULL) AS added, lost = 0 AS superset, lost = 0 AND added = 0 AS equal FROM j""", name="key_sets")
def customer_key_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intersection and differences of two snapshots' keys, and whether one holds the other."""
    c = table(spark, sf_dir, "customer")
    return key_sets(c.where(_O), c.where(_N), ["c_custkey"])


@query(r"""WITH a AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || unnest(regexp_extract_all(html, 'href="(/[^" ]+)"', 1)) AS href FROM pages),
    n AS (SELECT page_id, regexp_extract(href, '^([^?#]*)', 1) AS base, regexp_extract(href, '\?([^#]*)', 1) AS q FROM a),
    c AS (SELECT page_id, base || CASE WHEN regexp_matches(q, '=.') THEN '?' || array_to_string(list_sort(list_filter(string_split(q, '&'), lambda x: regexp_matches(x, '=.'))), '&') ELSE '' END AS canonical FROM n) SELECT canonical, min(page_id) AS page_id FROM c GROUP BY canonical""")
def first_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each canonical address of all pages' own anchors once, with the first page that has it."""
    anchors = F.explode(F.regexp_extract_all("html", F.lit('href="(/[^" ]+)"'), F.lit(1)))
    a = table(spark, sf_dir, "pages").select("page_id", "url", anchors.alias("path")).withColumn("href", F.concat(F.regexp_extract("url", "^([a-z]+://[^/?#]*)", 1), "path"))
    return first_attachments(a, ["page_id"], attachment_url(F.col("href"), any_path=True))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'AUDITED' ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_custkey % 4 = 0 AND c_custkey % 8 <> 0 THEN round(c_acctbal) ELSE c_acctbal END AS c_acctbal, c_name, c_custkey % 4 = 0 AS changed FROM customer""", name="upsert_fields")
def customer_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fields replaced where an audit has the key; null changes keep the old value."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    audit = c.where("c_custkey % 4 = 0").select("c_custkey", F.lit("AUDITED").alias("c_mktsegment"), F.when(F.col("c_custkey") % 8 != 0, F.round("c_acctbal")).alias("c_acctbal"))
    return upsert_fields(c, audit, ["c_custkey"], ["c_mktsegment", "c_acctbal"])


_SNAP = "CASE WHEN c_custkey % 11 = 0 AND c_nationkey % 3 = 0 THEN 'FORMER' ELSE c_mktsegment END"
_OLD_WHERE, _NEW_WHERE = "c_nationkey <> 24 AND (c_nationkey % 4 <> 1 OR c_custkey % 6 <> 0)", "c_nationkey <> 7 AND (c_nationkey % 5 <> 2 OR c_custkey % 9 <> 0)"


@query(f"""WITH o AS (SELECT c_nationkey AS s, c_custkey AS k, {_SNAP} AS v FROM customer WHERE {_OLD_WHERE}), n AS (SELECT c_nationkey AS s, c_custkey AS k, c_mktsegment AS v FROM customer WHERE {_NEW_WHERE}), j AS (SELECT s, k, o.v AS a, n.v AS b FROM o FULL JOIN n USING (s, k)),
    g AS (SELECT s AS c_nationkey, count(a) AS old_rows, count(b) AS current_rows, count(*) FILTER (b IS NULL) AS lost, count(*) FILTER (a <> b) AS changed, count(*) FILTER (a IS NULL) AS added FROM j GROUP BY s)
    SELECT *, array_to_string(list_sort(list_filter([CASE WHEN lost > 0 THEN 'historical_rows_removed' END, CASE WHEN changed > 0 THEN 'historical_rows_modified' END, CASE WHEN current_rows = 0 THEN 'missing_ingested_official_rows_or_files' END], lambda x: x IS NOT NULL)), ',') AS failures, CASE WHEN failures = '' THEN 'PASS' ELSE 'HOLD' END AS status FROM g""")
def history_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which nations' published rows were kept as they were."""
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_mktsegment")
    return integrity(c.where(_OLD_WHERE).withColumn("c_mktsegment", F.expr(_SNAP)), c.where(_NEW_WHERE), ["c_nationkey"], ["c_custkey"], ["c_mktsegment"])


@query(f"""WITH o AS (SELECT c_nationkey AS s, c_custkey AS k, {_SNAP} AS v FROM customer WHERE {_OLD_WHERE}), n AS (SELECT c_nationkey AS s, c_custkey AS k, c_mktsegment AS v, c_acctbal FROM customer WHERE {_NEW_WHERE}),
    x AS (SELECT n.s, n.c_acctbal, o.v IS DISTINCT FROM n.v AS c FROM n LEFT JOIN o USING (s, k)), l AS (SELECT s, count(*) AS lost FROM o ANTI JOIN n USING (s, k) GROUP BY s), g AS (SELECT s, count(*) FILTER (c) AS changed, count(*) FILTER (c AND c_acctbal > 0) AS verified FROM x GROUP BY s)
    SELECT s AS c_nationkey, changed, verified, coalesce(lost, 0) AS lost, CASE WHEN changed = 0 AND coalesce(lost, 0) = 0 THEN 'NO_CHANGE' WHEN coalesce(lost, 0) > 0 OR verified < changed THEN 'HOLD' ELSE 'PUBLISH_READY' END AS status FROM g LEFT JOIN l USING (s)""", name="incremental_verdict")
def nation_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether nations' new and changed rows pass the strict test; unchanged ones are not tested again."""
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_mktsegment", "c_acctbal")
    old = c.where(_OLD_WHERE).withColumn("c_mktsegment", F.expr(_SNAP))
    new, key = c.where(_NEW_WHERE), ["c_nationkey", "c_custkey"]
    marked = new.join(old.select(*key, F.col("c_mktsegment").alias("_v")), key, "left").withColumn("is_changed", ~F.col("_v").eqNullSafe(F.col("c_mktsegment")))
    lost = old.join(new, key, "left_anti").groupBy("c_nationkey").agg(F.count("*").alias("lost"))
    return incremental_verdict(marked, ["c_nationkey"], F.col("c_acctbal") > 0, lost)
